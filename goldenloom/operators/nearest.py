"""Nearest neighbours by cosine over cells (an inverted file), exact or by the nearest cells alone.

Items go to the cell of the centroid with the smallest angle, and are laid out by cell and angle in blocks. The angle between
a query and an item is at least the difference of their angles to the item's centroid (angles are a metric), so a block whose
angles are too far from the query's can't hold a nearer item than those found: the cells nearest to each query are searched
first, then only those blocks that may still change a result. Blocks of queries meet blocks of items as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.sources import files

CELLS, SAMPLE = 64, 4096  # centroids are fitted to a sample of the items; they change the work, not the exact result
QUERIES, ITEMS = 256, 4096  # rows of a block
SLACK = 1e-6

_FOUND = "q long, i long, score double"


def unit_rows(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of length one; rows of zeros stay."""
    v = np.array([x if len(x) == dims else [*x, *[0.0] * (dims - len(x))] for x in column.to_pylist()], np.float64).reshape(len(column), dims)
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def fit_centroids(sample: np.ndarray, n: int) -> np.ndarray:
    """Directions of up to n groups: even picks from the sample, moved to their groups' mean directions five times."""
    chosen = sample[:: max(1, len(sample) // n)][:n]
    for _ in range(5):
        near = (sample @ chosen.T).argmax(1)
        means = np.stack([sample[near == k].sum(0) if (near == k).any() else c for k, c in enumerate(chosen)])
        norm = np.sqrt((means * means).sum(1, keepdims=True))
        chosen = np.where(norm > 0, means / np.where(norm > 0, norm, 1), chosen)
    return chosen


def _angles(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(v @ centroids.T, -1, 1))


def _clean(df: DataFrame, id_col: str, vector: str, block: str | None) -> DataFrame:
    """(id, block, v) of rows with an id and a finite vector that is not all zeros."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), (F.coalesce(F.col(block).cast("string"), F.lit("")) if block else F.lit("")).alias("block"), v.alias("v"))
    return rows.where("id is not null and v is not null and exists(v, x -> x <> 0) and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def _laid(rows: DataFrame, centroids: np.ndarray, dims: int, size: int, whole: bool) -> DataFrame:
    """Blocks of rows in the order of (cell, angle): (at, cell, low, high, ids, blocks, vs); whole: a block may hold several
    cells, and low and high have an entry for each centroid."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = unit_rows(b.column(2), dims)
            angle = _angles(v, centroids)
            cell = angle.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(angle[np.arange(len(v)), cell]), b.column(0), b.column(1), pa.array([x.tobytes() for x in v], pa.binary())], ["cell", "angle", "id", "block", "v"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, None

        def block(t: pa.Table) -> pa.RecordBatch:
            vs = b"".join(t.column("v").to_pylist())
            if whole:
                angle = _angles(np.frombuffer(vs).reshape(-1, dims), centroids)
                low, high = angle.min(0), angle.max(0)
            else:
                low, high = (t.column("angle")[k].as_py() for k in (0, -1))
                low, high = np.array([low]), np.array([high])
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([t.column("cell")[0].as_py()], pa.int32()), pa.array([low], pa.list_(pa.float64())), pa.array([high], pa.list_(pa.float64())),
                pa.array([t.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([t.column("block").to_pylist()], pa.list_(pa.string())), pa.array([vs], pa.binary())], ["at", "cell", "low", "high", "ids", "blocks", "vs"])

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            while held is not None and held.num_rows and (last or held.num_rows >= 2 * size):
                n = min(size, held.num_rows)
                if not whole:
                    n = int((held.column("cell").slice(0, n).to_numpy() == held.column("cell")[0].as_py()).sum())
                yield block(held.slice(0, n))
                held, number = held.slice(n), number + 1

        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            yield from ready(False)
        yield from ready(True)

    made = rows.mapInArrow(keyed, "cell int, angle double, id long, block string, v binary")
    order = ("cell", "angle", "id")
    return files.stored(made.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, "at long, cell int, low array<double>, high array<double>, ids array<long>, blocks array<string>, vs binary"))


def nearest(queries: DataFrame, items: DataFrame, k: int = 1, query_id: str = "q", query_vector: str = "v", item_id: str = "i", item_vector: str = "w", block: str | None = None, probe: int = 2, exact: bool = True, cells: int = CELLS) -> DataFrame:
    """(q, i, score): for each query the k items of other ids with the highest cosine, of its own block if a block column is
    named; ties (to nine digits) by id. exact: whatever the cells; else only the `probe` nearest cells of each query's block
    of queries are searched. Rows with a null id, or a vector that is null, all zeros or not finite, take no part; vectors of
    different lengths count as filled up with zeros. Query ids are unique."""
    spark = items.sparkSession
    rows, asked = files.stored(_clean(items, item_id, item_vector, block)), files.stored(_clean(queries, query_id, query_vector, block))
    dims = max((d.agg(F.max(F.size("v"))).first()[0] or 0) for d in (rows, asked))
    sample = rows.orderBy(F.xxhash64("v"), "id").limit(SAMPLE).select("v").toArrow().column("v").to_pylist()
    if not sample or not dims:
        return spark.createDataFrame([], _FOUND)
    centroids = fit_centroids(unit_rows(pa.array(sample, pa.list_(pa.float64())), dims), cells)
    held, asking = _laid(rows, centroids, dims, ITEMS, False), _laid(asked, centroids, dims, QUERIES, True)
    sides = asking.select(F.col("at").alias("of"), F.posexplode("low").alias("cell", "qlow"), "high").withColumn("qhigh", F.get("high", F.col("cell"))).drop("high")
    near = sides.withColumn("n", F.row_number().over(Window.partitionBy("of").orderBy("qlow", "cell")))
    blocks = held.select("at", "cell", F.col("low")[0].alias("low"), F.col("high")[0].alias("high"))
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("qhigh"), F.col("qlow") - F.col("high"))
    pairs = files.stored(near.join(blocks, "cell").select("of", "at", "n", gap.alias("gap")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                one = {c: b.column(c)[r] for c in b.schema.names}
                a, v = (np.frombuffer(one[c].as_py()).reshape(-1, dims) for c in ("qvs", "vs"))
                qs, ids = (one[c].values.to_numpy() for c in ("qs", "ids"))
                order = np.argsort(ids, kind="stable")
                score = np.round(a @ v[order].T, 9)
                own = np.array(one["qblocks"].as_py())[:, None] == np.array(one["blocks"].as_py())[order][None, :]
                score = np.where(own & (qs[:, None] != ids[order][None, :]), score, -np.inf)
                most = min(k, score.shape[1])
                top = np.argsort(-score, axis=1, kind="stable")[:, :most]  # ties by id, as columns stand by it
                best = np.take_along_axis(score, top, 1)
                good = best > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qs, most)[good.ravel()]), pa.array(ids[order][top][good]), pa.array(best[good])], ["q", "i", "score"])

    def search(some: DataFrame) -> DataFrame:
        both = some.select("of", "at").join(asking.select(F.col("at").alias("of"), F.col("ids").alias("qs"), F.col("blocks").alias("qblocks"), F.col("vs").alias("qvs")), "of").join(held.select("at", "ids", "blocks", "vs"), "at")
        return both.mapInArrow(scan, _FOUND)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("q").orderBy(F.desc("score"), "i")
        return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")

    found = best(search(pairs.where(F.col("n") <= probe)))
    if not exact:
        return found
    found = files.stored(found)
    full = found.groupBy("q").agg(F.count("*").alias("m"), F.min("score").alias("kth")).where(F.col("m") == k)
    members = asking.select(F.col("at").alias("of"), F.explode("ids").alias("q"))
    reach = F.when(F.col("kth").isNotNull(), F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("kth") - SLACK)))).otherwise(F.lit(4.0))
    needed = members.join(full, "q", "left").groupBy("of").agg(F.max(reach).alias("needed"))
    rest = pairs.where(F.col("n") > probe).join(needed, "of").where(F.col("gap") <= F.col("needed") + SLACK)
    return best(search(rest).unionByName(found))
