"""Hard-negative mining (13): one-dimensional distance keys.

Vectors get one more component, the root of what their squared length lacks to the longest one's, anchors a zero, so that
larger inner products are smaller distances. Each vector has its nearest pivot and the distance to it as a key; the vectors are
written in the order of (pivot, distance) and cut into blocks. An anchor at distance d from a pivot is at least |d - r| and
at most d + r from a vector of key r: searches read the blocks of growing key intervals around d, less those that are too
near for the wanted scores, until the best found so far show that no further block can hold a better one. Blocks of
anchors meet blocks of vectors; scores are exact inner products of whole numbers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.llm.common import table

PIVOTS, SAMPLE = 32, 2048  # pivots are fitted to a sample; they change the work, not the result
ANCHORS, VECTORS = 256, 8192  # rows of a block
SHARES = (1 / 64, 1 / 8)  # of all keys, that the first intervals hold; the last one holds what is left
LARGEST = 1 << 25  # of a whole component; scores of up to 8,192 components fit 63 bits
FAR = 1 << 62

_FOUND = "ablock long, arow long, band int, score long, id long, row long"


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    offsets, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat[offsets[0] : offsets[-1]]
    return out


def _distances(v: np.ndarray, more: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each row, with the component `more` after its own, to each pivot."""
    return np.stack([np.sqrt(((v - p[:-1]) ** 2).sum(1) + (more - p[-1]) ** 2) for p in pivots], axis=1)


def fit_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Means of up to n groups: rows far from those chosen before, then five rounds of moving to the mean."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    pivots = sample[chosen]
    for _ in range(5):
        near = _distances(sample[:, :-1], sample[:, -1], pivots).argmin(1)
        pivots = np.stack([sample[near == k].mean(0) if (near == k).any() else p for k, p in enumerate(pivots)])
    return pivots


def _best(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of each row's k best wanted scores; ties by column."""
    some = np.flatnonzero(wanted.any(1))
    rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in some:
        at = np.flatnonzero(wanted[i])
        s = scores[i, at]
        if len(at) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            above, equal = at[s > least], at[s == least]
            at = np.concatenate([above, equal[: k - len(above)]])
        rows.append(np.full(len(at), i))
        columns.append(at)
    return np.concatenate(rows), np.concatenate(columns)


class _Index:
    """Blocks of vectors by key, and blocks of anchors with their distances from each pivot."""

    def __init__(self, vectors: DataFrame, anchor: Column):
        """vectors: id long, label, v array<long>, is_anchor boolean; written, with a number for each row."""
        rows = table(vectors.withColumn("n", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
        self.rows = rows
        self.longest, self.dims = rows.agg(F.max("n"), F.max(F.size("v"))).first()
        if self.longest is None:
            return
        sample = rows.orderBy(F.xxhash64("v"), "id", "row").limit(SAMPLE).select("v", "n").toArrow().combine_chunks()
        v = _matrix(pa.concat_arrays(sample.column("v").chunks), self.dims)
        more = np.sqrt(self.longest - sample.column("n").to_numpy().astype(float))
        self.pivots = fit_pivots(np.column_stack([v, more]), PIVOTS)
        key = _distances(v, more, self.pivots)
        own = key.argmin(1)
        probe = _distances(v[:256], np.zeros(min(256, len(v))), self.pivots)
        gaps = np.abs(probe[:, own] - key[np.arange(len(v)), own])
        self.widths = [*(float(np.quantile(gaps, q)) for q in SHARES), math.inf]
        self.blocks = table(self._pack(rows, anchors=False), "negatives-blocks")
        self.anchors = table(self._pack(rows.where(anchor), anchors=True), "negatives-anchors")

    def _pack(self, rows: DataFrame, anchors: bool) -> DataFrame:
        pivots, dims, longest, size = self.pivots, self.dims, self.longest, ANCHORS if anchors else VECTORS

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v, n = _matrix(b.column("v"), dims), b.column("n").to_numpy().astype(float)
                d = _distances(v, np.zeros(len(n)) if anchors else np.sqrt(longest - n), pivots)
                near = d.argmin(1)
                every = pa.ListArray.from_arrays(np.arange(0, len(n) * len(pivots) + 1, len(pivots), dtype=np.int32) if anchors else np.zeros(len(n) + 1, np.int32), d.reshape(-1) if anchors else np.zeros(0))
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(n)), near]), every, *(b.column(c) for c in ("row", "id", "label", "n")), pa.array([x.tobytes() for x in v.astype(np.int32)], pa.binary())], ["pivot", "dist", "every", "row", "id", "label", "n", "v"])

        kind = dict(rows.dtypes)["label"]
        made = rows.mapInArrow(keyed, f"pivot int, dist double, every array<double>, row long, id long, label {kind}, n long, v binary")
        laid = made.repartitionByRange("pivot", "dist", "row").sortWithinPartitions("pivot", "dist", "row")

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            held = None
            for b in batches:
                held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
                while held.num_rows >= 2 * size:
                    part, held = cut(held)
                    yield block(part, number)
                    number += 1
            while held is not None and held.num_rows:
                part, held = cut(held)
                yield block(part, number)
                number += 1

        def cut(t: pa.Table) -> tuple[pa.Table, pa.Table]:
            """The first rows; of vectors only those of one pivot."""
            n = min(size, t.num_rows)
            if not anchors:
                own = t.column("pivot").slice(0, n).to_numpy()
                n = int((own == own[0]).sum())
            return t.slice(0, n), t.slice(n)

        def block(t: pa.Table, number: int) -> pa.RecordBatch:
            t = t.combine_chunks()
            if anchors:
                every = np.array(t.column("every").to_pylist())
                low, high, which = every.min(0), every.max(0), list(range(len(pivots)))
            else:
                d = t.column("dist").to_numpy()
                low, high, which = d[:1], d[-1:], [t.column("pivot")[0].as_py()]
                order = np.lexsort((t.column("row").to_numpy(), t.column("id").to_numpy()))  # ties by id, then row
                t = t.take(pa.array(order))
            lists = [pa.array([t.column(c).to_pylist()], pa.list_(k)) for c, k in (("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([which], pa.list_(pa.int32())), pa.array([low], pa.list_(pa.float64())), pa.array([high], pa.list_(pa.float64())), *lists,
                 pa.array([t.column("label").to_pylist()], pa.list_(t.schema.field("label").type)), pa.array([b"".join(t.column("v").to_pylist())], pa.binary())],
                ["block", "pivots", "low", "high", "rows", "ids", "ns", "labels", "vs"],
            )

        return laid.mapInArrow(packed, f"block long, pivots array<int>, low array<double>, high array<double>, rows array<long>, ids array<long>, ns array<long>, labels array<{kind}>, vs binary")

    def search(self, bands: DataFrame, k: int, same: bool) -> DataFrame:
        """bands: (arow, band int, lo long, hi long). For each the k best rows of the anchor's own label (without
        itself), or of others, with scores from lo to hi: (ablock, arow, band, score, id, row)."""
        spark, longest, dims = bands.sparkSession, self.longest, self.dims
        members = self.anchors.select(F.col("block").alias("ablock"), F.explode(F.arrays_zip("rows", "ns")).alias("m")).select("ablock", F.col("m.rows").alias("arow"), F.col("m.ns").alias("n"))
        probes = table(members.join(bands, "arow"), "negatives-probes")

        def radius(score: str) -> Column:
            d = F.sqrt(F.greatest(F.lit(0.0), F.col("n").cast("double") + F.lit(float(longest)) - 2.0 * F.col(score).cast("double")))
            return d * (1 + 1e-9) + 1e-6

        asked = probes.groupBy("ablock").agg(
            F.min(radius("hi") * (1 - 3e-9) - 3e-6).alias("inner"), F.collect_list(F.struct("arow", "band", "lo", "hi")).alias("bands")  # of one block's anchors
        )
        sides = self.anchors.select(F.col("block").alias("ablock"), F.posexplode("low").alias("pivot", "alow"), "high").withColumn("ahigh", F.get("high", F.col("pivot"))).drop("high")
        blocks = self.blocks.select("block", F.col("pivots")[0].alias("pivot"), F.col("low")[0].alias("low"), F.col("high")[0].alias("high"))
        all_pairs = sides.join(blocks, "pivot").select("ablock", "block", F.greatest(F.lit(0.0), F.col("low") - F.col("ahigh"), F.col("alow") - F.col("high")).alias("gap"), (F.col("ahigh") + F.col("high")).alias("reach"))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    one = {c: b.column(c)[r] for c in b.schema.names}
                    vs, avs = (np.frombuffer(one[c].as_py(), np.int32).reshape(-1, max(dims, 1)) if dims else np.zeros((len(one[m].values), 0), np.int32) for c, m in (("vs", "rows"), ("avs", "arows")))
                    rows, ids, arows = (one[c].values.to_numpy() for c in ("rows", "ids", "arows"))
                    labels, alabels = (np.array(one[c].as_py()) for c in ("labels", "alabels"))
                    exact = float(np.abs(vs).max(initial=0)) * float(np.abs(avs).max(initial=0)) * max(dims, 1) < 2**53
                    scores = (avs.astype(float) @ vs.astype(float).T).astype(np.int64) if exact else avs.astype(np.int64) @ vs.astype(np.int64).T
                    match = alabels[:, None] == labels[None, :]
                    match = match & (arows[:, None] != rows[None, :]) if same else ~match
                    place = {int(a): k for k, a in enumerate(arows)}
                    asked = one["bands"].values
                    who = np.array([place[int(a)] for a in asked.field("arow").to_numpy()])
                    band, lo, hi = (asked.field(c).to_numpy() for c in ("band", "lo", "hi"))
                    for at in range(0, len(who), ANCHORS):
                        part = slice(at, at + ANCHORS)
                        s = scores[who[part]]
                        i, j = _best(s, match[who[part]] & (s >= lo[part, None]) & (s <= hi[part, None]), k)
                        if len(i):
                            made = [np.full(len(i), one["ablock"].as_py()), arows[who[part]][i], band[part][i], s[i, j], ids[j], rows[j]]
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["ablock", "arow", "band", "score", "id", "row"])

        found, before, needed = None, -1.0, None
        for number, width in enumerate(self.widths):
            pairs = all_pairs.where((F.col("gap") > before) & (F.col("gap") <= width)).join(asked.select("ablock", "inner"), "ablock").where(F.col("reach") >= F.col("inner"))
            if needed is not None:
                pairs = pairs.join(needed, "ablock").where(F.col("gap") <= F.col("needed"))
            pairs = table(pairs.select("ablock", "block"), "negatives-pairs")
            before = width
            if pairs.isEmpty():
                continue
            both = (
                pairs.join(self.anchors.select(F.col("block").alias("ablock"), F.col("rows").alias("arows"), F.col("labels").alias("alabels"), F.col("vs").alias("avs")), "ablock")
                .join(asked.select("ablock", "bands"), "ablock").join(self.blocks.select("block", "rows", "ids", "labels", "vs"), "block")
            )
            new = both.mapInArrow(scan, _FOUND)
            new = new if found is None else new.unionByName(found)
            order = Window.partitionBy("arow", "band").orderBy(F.desc("score"), "id", "row")
            found = table(new.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"), "negatives-found")
            if number + 1 < len(self.widths):
                full = found.groupBy("arow", "band").agg(F.count("*").alias("m"), F.min("score").alias("kth")).where(F.col("m") == k)
                needed = table(probes.join(full, ["arow", "band"], "left").groupBy("ablock").agg(F.max(F.when(F.col("kth").isNotNull(), radius("kth")).otherwise(radius("lo"))).alias("needed")), "negatives-needed")
        return found if found is not None else spark.createDataFrame([], _FOUND)


def hard_negatives(
    vectors: DataFrame, anchor: Column | str, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", n_positives: int = 5, n_negatives: int = 10,
    least: tuple[int, int] = (30, 100), most: tuple[int, int] = (90, 100), scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row that fulfils `anchor` and each
    of its `n_positives` best other rows of the same label, the `n_negatives` best rows of other labels whose score is
    between the shares `least` and `most` of the positive's. Components become floor(scale * x); a score is an inner
    product of those, ties go to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Repeated rows are rows of their
    own, as anchors, positives and negatives. Of vectors of different lengths the shorter count as filled up with
    zeros; whole components are held within 2**25 to both sides. An anchor without another row of its label, or
    a positive without a negative in its band (as any of a score below zero), gives no row. Other columns are ignored; an
    empty table gives an empty one."""
    x = F.col(vector_col).cast("array<double>")
    taken = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.coalesce(F.expr(anchor) if isinstance(anchor, str) else anchor, F.lit(False)).alias("is_anchor"), x.alias("x")
    ).where("id is not null and label is not null and x is not null and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), c * scale))).cast("long"))
    index = _Index(taken.select("id", "label", "is_anchor", whole.alias("v")), F.col("is_anchor"))
    spark, kind = vectors.sparkSession, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index.longest is None:
        return spark.createDataFrame([], kind)
    every = index.rows.where("is_anchor").select(F.col("row").alias("arow"), F.lit(0).alias("band"), F.lit(-FAR).cast("long").alias("lo"), F.lit(FAR).cast("long").alias("hi"))
    positives = index.search(every, n_positives, same=True).where("score >= 0")
    number = F.row_number().over(Window.partitionBy("arow").orderBy(F.desc("score"), "id", "row"))
    positives = table(positives.select("arow", number.cast("int").alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    lo, hi = F.expr(f"(positive_score * {least[0]} + {least[1] - 1}) div {least[1]}"), F.expr(f"positive_score * {most[0]} div {most[1]}")
    found = index.search(positives.select("arow", "band", lo.alias("lo"), hi.alias("hi")), n_negatives, same=False)
    rank = F.row_number().over(Window.partitionBy("arow", "band").orderBy(F.desc("score"), "id", "row"))
    names = index.rows.where("is_anchor").select(F.col("row").alias("arow"), F.col("id").alias("anchor_id"))
    ranked = found.select("arow", "band", rank.cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return ranked.join(positives, ["arow", "band"]).join(names, "arow").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
