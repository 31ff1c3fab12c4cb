"""Near-dedup by SimHash, made exact: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Texts whose SimHash fingerprints differ in two bits at most (simhash.py) are candidates first. Fingerprints only estimate
similarity, so the pairs that they miss are found by prefix filtering, which misses none: with the
shingles of every set in one order, two sets of n and m shingles that are so similar share one among their first
n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1. Shingles that are frequent in a sample come last in the order, which keeps
buckets small; the sample changes the work, not the result. At a pair's first shared shingle the smaller set has no more
than a ninth of its shingles before it, as too few would be left otherwise; so only such members of a bucket, the leaders, look
for partners, and a shingle that is common but late in its sets brings no pairs. Candidates are verified on whole sets. Buckets over
`pair_limit` first link to their least and greatest member; then only pairs of different components are left."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenloom.llm.common import table
from goldenloom.llm.graph import components
from goldenloom.llm import simhash
from goldenloom.llm.simhash import one_of_each

WIDTH = 5
LEAST = (4, 5)  # 0.8 in whole numbers
SAMPLE, FREQUENT, MOST_FREQUENT = 16, 4, 200_000
HELD = 2_000_000  # shingles of the last pairs that a worker keeps


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes (XXH64, seed 42, as signed) of the ASCII-lower-cased text's word shingles; a shorter text is one."""
    return _shingles((text or "").encode("utf-8", "surrogatepass").lower().split(), width)


def _shingles(words: list[bytes], width: int) -> np.ndarray:
    if not words:
        return np.zeros(0, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    stops = [e - 1 for e in ends[width - 1 :]] or [len(joined)]
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip([0, *ends], stops)], dtype=np.uint64).view(np.int64))


def _frequent(docs: DataFrame, text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample of the texts, sorted, and their counts; at most MOST_FREQUENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_py(), width))], ["s"])

    sample = docs.where(F.pmod(F.xxhash64(text), F.lit(SAMPLE)) == 0).select(F.col(text).cast("string").alias("t"))
    counted = sample.mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    found = counted.orderBy(F.desc("n"), "s").limit(MOST_FREQUENT).toArrow()
    keys, n = found.column("s").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _prefixes(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, text_hash, node, n, fp, prefix): node stands for the set, n is its size, fp its SimHash; one row per input row."""
    keys, counts = _frequent(docs, text_col, width)
    num, den = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, sizes, prints, prefixes = [], [], [], []
            for t in b.column(2):
                s = shingles(t.as_py(), width)
                nodes.append(xxhash.xxh64_intdigest(s.tobytes(), 42))
                sizes.append(len(s))
                prints.append(simhash.majority(s.view("<u8")))
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    s = s[np.argsort(np.where(keys[at] == s, counts[at], 0), kind="stable")]
                prefixes.append(s[: len(s) - -(-num * len(s) // den) + 1])
            made = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], ["id", "text_hash", "node", "n", "fp", "prefix"])

    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    kind = [narrow.schema["id"], narrow.schema["text_hash"], T.StructField("node", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("fp", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType()))]
    return narrow.mapInArrow(run, T.StructType(kind))


def _possible(a: str, b: str) -> Column:
    """Whether sizes, and what is left after a shared shingle's places, allow the similarity; true at a pair's first shared one."""
    num, den = LEAST
    left = f"least({a}.n - {a}.pos, {b}.n - {b}.pos)"
    return F.expr(f"{den} * least({a}.n, {b}.n) >= {num} * greatest({a}.n, {b}.n) and {num + den} * {left} >= {num} * ({a}.n + {b}.n)")


def _leads(side: str) -> Column:
    """Whether the member can be the smaller of a similar pair that first meets here."""
    num, den = LEAST
    return F.expr(f"{num + den} * {side}.pos <= {den - num} * {side}.n")


def _led(leaders: DataFrame, others: DataFrame, more: str = "true") -> DataFrame:
    """(a, b) of the pairs of a bucket that may be similar: a leader, and a larger set or one of equal size and greater node."""
    larger = "(a.n < b.n or a.n = b.n and a.node < b.node)"
    met = leaders.alias("a").where(_leads("a")).join(others.alias("b"), F.expr(f"a.s = b.s and {larger} and {more}") & _possible("a", "b"))
    return met.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))


def _similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar."""
    num, den = LEAST
    pairs = table(pairs.distinct(), "similar-candidates")
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "text_hash"), "node").select("text_hash").distinct()
    # Copies of a text go before it moves, and by the same shuffle it meets those that are used.
    texts = docs.select(F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text")).dropDuplicates(["text_hash"]).join(used, "text_hash", "left_semi").select("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            nodes, packed = [], []
            for t in b.column(0):
                words = (t.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                nodes.append(xxhash.xxh64_intdigest(_shingles(words, width).tobytes(), 42))
                packed.append(squeeze(b" ".join(words)))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(packed, pa.binary())], ["node", "words"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, size = zstandard.ZstdDecompressor().decompress, {}, 0

        def shingles_of(node: int, words: pa.Scalar) -> np.ndarray:
            """A pair's set; those of the last pairs are kept, as pairs of a set follow each other."""
            nonlocal size
            found = held.get(node)
            if found is None:
                found = _shingles(unpack(words.as_py()).split(), width)
                if size > HELD:
                    held.clear()
                    size = 0
                held[node], size = found, size + len(found)
            return found

        for b in batches:
            good = []
            for left, right, x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                one, other = shingles_of(left, x), shingles_of(right, y)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                good.append(den * shared >= num * (len(one) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Packed words are a fifth of their shingles' hashes, and each pair moves a text.
    packed = table(texts.mapInArrow(pack, "node long, words binary"), "similar-texts")
    both = pairs.join(packed.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a").join(packed.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b")
    return table(both.select("a", "b", "wa", "wb").mapInArrow(verify, "a long, b long"), "similar-pairs")


def _close(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes(node, fp) with close fingerprints: those of one fingerprint with its least node, and the least nodes of
    linked fingerprints."""
    first = table(nodes.groupBy("fp").agg(F.min("node").alias("first")), "similar-fingerprints")
    same = nodes.join(first, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    of = lambda n: first.select(F.col("fp").alias(n), F.col("first").alias(f"node_{n}"))
    near = simhash.links(first.select("fp")).join(of("a"), "a").join(of("b"), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return same.union(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links(rows: DataFrame, docs: DataFrame, text_col: str = "text", width: int = WIDTH, pair_limit: int = 64) -> DataFrame:
    """rows(row, node, n, fp, prefix, text_hash) of docs, row differing. Returns links (a, b) of nodes whose components are those
    of all similar pairs."""
    # Of equal sets one row stands for all.
    first = rows.groupBy("node").agg(F.min("row").alias("first"), F.count("*").alias("m")).where("m > 1").select("node", "first")
    copies = table(rows.select("row", "node").join(first, "node").where("row <> first").select("row"), "similar-copies")
    nodes = table(rows.select("row", "node", "text_hash", "fp").join(copies, "row", "left_anti"), "similar-nodes")
    # Most shingles of a prefix stand in one set: counted first, with nothing beside them, few need their sets. Rows' numbers,
    # which follow each other, and half of a shingle's hash take the least room where all prefixes move; a bucket
    # may so hold two shingles, which brings candidates, no results. Copies count too, and go from what is left.
    keyed = rows.select("row", "n", F.posexplode("prefix").alias("pos", "whole")).select("row", "n", "pos", F.shiftright("whole", 32).cast("int").alias("s"))
    several = lambda df: df.groupBy("s").agg(F.count("*").alias("m")).where("m > 1")
    met = keyed.join(several(keyed.select("s")).select("s"), "s")
    met = table(met.join(nodes.select("row", "node"), "row").drop("row"), "similar-met")
    members = table(met.join(several(met), "s"), "similar-buckets")
    small, large = members.where(F.col("m") <= pair_limit), members.where(F.col("m") > pair_limit)
    pairs = _led(small, small)
    ends = large.groupBy("s").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    stars = large.join(ends, "s").select(F.col("node").alias("u"), F.explode(F.array("lo", "hi")).alias("v")).where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
    found = _similar(_close(nodes).union(pairs).union(stars), nodes, docs, text_col, width)
    if large.isEmpty():
        return found
    named = large.join(components(found).withColumnRenamed("node", "u"), F.col("node") == F.col("u"), "left").withColumn("c", F.coalesce("component", "node")).select("s", "node", "n", "pos", "c")
    split = named.groupBy("s").agg(F.mode("c").alias("most"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("s", "most")
    open_ = table(named.join(split, "s"), "similar-open")
    apart, most = open_.where("c <> most"), open_.where("c = most")
    rest = _led(apart, open_, "a.c <> b.c").union(_led(most, apart))
    return found.union(_similar(rest, nodes, docs, text_col, width))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, pair_limit: int = 64) -> DataFrame:
    """docs less all but one row of each group that links of similar texts hold together: that with the smallest
    id (null last), then text hash. Wordless texts and null are alike. Equal sets are similar. Rows equal in id and
    text are copies, of which one stays; a null id is as any other; extra columns stay as they are; an empty table
    gives an empty one."""
    rows = table(_prefixes(docs, id_col, text_col, width).withColumn("row", F.monotonically_increasing_id()), "similar-prefixes")
    found = components(links(rows, docs, text_col, width, pair_limit))
    grouped = rows.select("id", "text_hash", "node").join(found, "node", "left").select("id", "text_hash", F.coalesce("component", "node").alias("component"))
    return one_of_each(docs, grouped, id_col, text_col)
