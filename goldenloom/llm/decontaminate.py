"""Benchmark decontamination (8): winnowing (Schleimer et al., 2003).

Texts become word sequences, words become 64-bit hashes, and of every `WINDOW - GRAM + 1` consecutive
k-grams the one with the least hash is kept. Any span of WINDOW words that training and test share
therefore shares a kept k-gram. Kept k-grams of both sides are joined, and each hit is extended in both
directions over the words themselves, so the result is exact."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenloom.llm.common import fresh, table

WINDOW = 13
GRAM = 5
#: Test fingerprints up to this number (8 MB) are sent to the scan to skip hopeless k-grams there; beyond
#: it the scan keeps all and the join alone decides.
SEMI_JOIN_ROWS = 1_000_000

_RNG = np.random.default_rng(8)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = _RNG.integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if _WORD[b] else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, all at once: polynomial over the word's bytes, then mixed."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_FOLD), np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = b != 32
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.flatnonzero(inside[1:-1])
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    offset = np.arange(len(at)) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _STEP))
    return _mix(np.add.reduceat(_BYTE[b[at]] * power[offset], first))


def fingerprints(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the k-grams kept so that every span of `length` words keeps one of its own;
    the hash also depends on `length`, so that classes don't mix."""
    k = min(GRAM, length)
    n = len(hashes) - k + 1
    if len(hashes) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.full(n, length, np.uint64)
    for j in range(k):
        grams += hashes[j : j + n] * _ODD[j]
    grams = _mix(grams)
    span = length - k + 1
    kept = np.unique(np.lib.stride_tricks.sliding_window_view(grams, span).argmin(1) + np.arange(n - span + 1))
    return grams[kept].view(np.int64), kept


def test_fingerprints(items: DataFrame) -> DataFrame:
    """items(item, item_id, text) to rows (h, item, ipos, length): length is the item's window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hashes = word_hashes(text)
                length = min(WINDOW, len(hashes))
                h, at = fingerprints(hashes, length) if length else ([], [])
                for o, v in zip(out, (h, [item] * len(h), at, [length] * len(h))):
                    o.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["h", "item", "ipos", "length"])

    return items.select("item", "text").mapInArrow(run, "h long, item long, ipos long, length long")


def _extended(doc: np.ndarray, item: np.ndarray, seeds: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """Spans of doc equal to a span of item, of at least the item's window, on the diagonals of the seeds: each seed is a
    k-gram's places in doc and in item. A diagonal is compared in both directions at once, and once only, however
    many seeds it has; so repeated words cost the sum of both lengths times the item's, and no list of pairs."""
    least, near = min(WINDOW, len(item)), np.zeros(len(doc) + len(item), bool)
    for places, others in seeds:
        at, to = (places, others) if len(places) >= len(others) else (others, places)
        at = np.array(at)
        for x in to:
            near[(at - x if to is others else x - at) + len(item)] = True
    spans = []
    for d in (np.flatnonzero(near) - len(item)).tolist():
        low, high = max(0, d), min(len(doc), len(item) + d)
        edge = np.diff(np.concatenate([[0], (doc[low:high] == item[low - d : high - d]).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= least
        spans += zip((starts[long] + low).tolist(), (ends[long] + low).tolist())
    return spans


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, text_hash (XXH64 of the text), n_words, n_hit, n_items, items_sha256,
    contaminated.

    A null or wordless text has zeros and is clean, as are all documents if the benchmark is empty; a
    null or wordless item has no window; items of fewer than 13 words are one window of their own
    length; a null item id marks words but is not listed; repeated documents and ids give a row each;
    repeated item ids count once. Other columns are ignored. Hot items cost each document its own hits
    only: no two documents ever meet."""
    spark = docs.sparkSession
    items = table(
        benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
        .where("text is not null").distinct().select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")
    tests = table(test_fingerprints(items), "test-fingerprints")
    lengths = sorted(r[0] for r in tests.select("length").distinct().collect())  # 13 numbers at most
    known = None
    if tests.count() <= SEMI_JOIN_ROWS:
        found = [r[0] for r in tests.select("h").distinct().collect()]
        known = spark.sparkContext.broadcast(np.sort(np.array(found, np.int64)))
    id_type = docs.schema[id_col].dataType
    seeds = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("pos", T.ArrayType(T.LongType()))]))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("text", T.StringType()), T.StructField("seeds", seeds)])
    kind = pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.list_(pa.int64()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            counts, texts, found = [], [], []
            for t in b.column(2):
                text = t.as_py()
                hashes = word_hashes(text)
                kept = defaultdict(list)
                for length in lengths:
                    h, at = fingerprints(hashes, length)
                    if known is not None and len(h):
                        hit = np.searchsorted(known.value, h)
                        hit = known.value[np.minimum(hit, len(known.value) - 1)] == h
                        h, at = h[hit], at[hit]
                    for x, y in zip(h.tolist(), at.tolist()):
                        kept[x].append(y)
                counts.append(len(hashes))
                texts.append(text if kept else None)
                found.append([{"h": x, "pos": y} for x, y in kept.items()])
            rows = pa.array(range(row, row + len(counts)), pa.int64())
            row += len(counts)
            yield pa.RecordBatch.from_arrays([rows, b.column(0), b.column(1), pa.array(counts, pa.int64()), pa.array(texts, pa.string()), pa.array(found, kind)], ["row", "id", "text_hash", "n_words", "text", "seeds"])

    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    scanned = table(narrow.mapInArrow(scan, schema), "scanned")
    # A k-gram's places in an item are one row, and those in a document too: no two lists are multiplied by the join.
    places = tests.groupBy("h", "item").agg(F.collect_list("ipos").alias("ipos"))
    hits = (
        scanned.select("row", F.explode("seeds").alias("seed")).select("row", "seed.h", "seed.pos").join(places, "h")
        .groupBy("row", "item").agg(F.collect_list(F.struct("pos", "ipos")).alias("at"))
        .join(items, "item").groupBy("row").agg(F.collect_list(F.struct("item_id", F.col("text").alias("item_text"), "at")).alias("hits"))
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_hit, n_items, digests = [], [], []
            for t, hits in zip(b.column(3), b.column(4)):
                doc, names, number = words(t.as_py()), set(), {}
                codes = np.array([number.setdefault(w, len(number)) for w in doc], np.int64)
                mark = np.zeros(len(doc), bool)
                together = defaultdict(list)
                for hit in hits.as_py() or []:
                    together[hit["item_id"], hit["item_text"]] += [(x["pos"], x["ipos"]) for x in hit["at"]]
                for (name, item_text), at in together.items():
                    item = np.array([number.get(w, -1) for w in words(item_text)], np.int64)
                    for a, z in _extended(codes, item, at):
                        mark[a:z] = True
                        names.add(name)
                names.discard(None)
                n_hit.append(int(mark.sum()))
                n_items.append(len(names))
                digests.append(hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string())], ["id", "text_hash", "n_words", "n_hit", "n_items", "items_sha256"])

    out = T.StructType([*(schema[c] for c in ("id", "text_hash", "n_words")), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType())])
    hit_rows = scanned.where("text is not null").join(hits, "row").select("id", "text_hash", "n_words", "text", "hits").mapInArrow(verify, out)
    none = hashlib.sha256(b"").hexdigest()
    clean = scanned.join(hits.select("row"), "row", "left_anti").select("id", "text_hash", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.lit(none).alias("items_sha256"))
    return hit_rows.union(clean).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words")).withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The docs that are not contaminated, with their columns, of any names. Null and wordless texts stay; repeated
    rows are judged alike; an empty table gives an empty one."""
    bad = table(overlaps(docs, benchmark, id_col, text_col).where("contaminated").select(id_col, "text_hash").distinct(), "contaminated")
    names = fresh(docs, "other_id", "other_hash")
    on = F.col(id_col).eqNullSafe(F.col(names[0])) & F.xxhash64(text_col).eqNullSafe(F.col(names[1]))
    return docs.join(bad.toDF(*names), on, "left_anti")
