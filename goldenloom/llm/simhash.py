"""SimHash near-dedup (6): fuzzy hashing with the binary Golay code (23, 12, 7).

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Two fingerprints that differ in at most
two bits agree on one segment at least (pigeonhole), and on the segment after it they differ in at most
two. A segment's Golay keys are the codewords within distance 4: one, or six where the nearest is at
distance 3; two words within distance 2 always share one. A bucket is an agreed segment with one such
key. Members of a bucket are verified against each other; buckets over `pair_limit` are not paired but
resolved through midpoints (two fingerprints differ in at most two bits exactly if flipping at most one
bit of each gives a common value), which is linear and as exact."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.llm.common import fresh, join_heavy, table
from goldenloom.llm.graph import components

SEGMENTS = ((0, 23), (23, 23), (46, 18))
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned SimHash of the ASCII-lower-cased text's word shingles (XXH64, seed 42), repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes both are ASCII only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, 42)
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, [e - 1 for e in ends[width - 1:]])], dtype="<u8")
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of unsigned hashes: a bit is 1 if set in over half of them."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long): one row per input row."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py()) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["id", "fp"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, fp long")


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    x = x.copy()
    for bit in range(22, 10, -1):
        x = np.where((x >> bit) & 1, x ^ (GENERATOR << (bit - 11)), x)
    return x


def golay_patterns() -> np.ndarray:
    """By syndrome, the error patterns of weight at most 4, padded with the first: 2048 x 6."""
    by: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        errors = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(23), weight)], dtype=np.int64)
        for s, e in zip(_syndrome(errors), errors):
            by[s].append(int(e))
    return np.array([(p * 6)[:6] if len(p) == 1 else p for p in by], dtype=np.int64)


def golay_keys(segment: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """n x 6 indices (12 bits) of codewords within distance 4; repeated where there is only one."""
    return (segment[:, None] ^ patterns[_syndrome(segment)]) >> 11


def bucket_keys(fps: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, fp) of all fingerprints: which segment agrees, its bits, and a key of the next one."""
    u = fps.view(np.uint64)
    cut = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    buckets, owners = [], []
    for i in range(3):
        keys = golay_keys(cut[(i + 1) % 3], patterns)
        full = ((i << 35) | (cut[i] << 12))[:, None] | keys
        new = np.ones(keys.shape, bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :1]
        buckets.append(full[new])
        owners.append(np.broadcast_to(fps[:, None], keys.shape)[new])
    return np.concatenate(buckets), np.concatenate(owners)


def links(fps: DataFrame, pair_limit: int = 64) -> DataFrame:
    """fps: distinct column fp. Returns links (a, b), a < b, whose components are those of all pairs of
    fingerprints within two bits: every close pair of a bucket up to `pair_limit`, and for larger buckets
    each member's link to the least fingerprint at each shared midpoint."""
    patterns = golay_patterns()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, fp = bucket_keys(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), patterns)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(fp)], ["bucket", "fp"])

    keyed = table(fps.select("fp").mapInArrow(keys, "bucket long, fp long"), "golay-keys")
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = table(keyed.join(shared, "bucket"), "golay-buckets")
    small = members.where(F.col("n") <= pair_limit)
    pairs = (
        small.select("bucket", F.col("fp").alias("a")).join(small.select("bucket", F.col("fp").alias("b")), "bucket")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    )

    def midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
        for b in batches:
            u = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            mid = (u[:, None] ^ flips).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(mid), pa.array(np.repeat(u, 65).view(np.int64))], ["mid", "fp"])

    large = members.where(F.col("n") > pair_limit).select("fp").distinct().mapInArrow(midpoints, "mid long, fp long")
    least = large.groupBy("mid").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1").select("mid", "least")
    stars = large.join(least, "mid").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_limit: int = 64) -> DataFrame:
    """(id, fingerprint, component_id): fingerprint as 16 hex digits; component_id the smallest id reachable
    over links of at most two differing bits, itself included.

    One row per input row, repeated rows too. A null or wordless text has fingerprint zero and links as
    any other. A null id takes part in the links but is never a component_id unless all ids of its
    component are null. Other columns are ignored. An empty table gives an empty one."""
    prints = table(fingerprints(docs, id_col, text_col), "fingerprints")
    # Rows meet their fingerprint's component, and only fingerprints their component's least id.
    each = table(prints.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n")), "distinct-fingerprints")
    found = components(links(each.select("fp"), pair_limit))
    grouped = table(each.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "fingerprint-components")
    least = table(grouped.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("n")), "component-ids")
    known = join_heavy(grouped.select("component", "fp", F.col("n").alias("rows")), least, "component")
    return join_heavy(prints, table(known.select("fp", F.col("rows").alias("n"), "component_id"), "fingerprint-ids"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, grouped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """grouped: (id, text_hash, component) of each row of docs, text_hash as xxhash64 gives it. Of each component one
    row of docs stays, with its columns: that with the smallest id (null last), then text hash."""
    order = F.struct(F.col("id").isNull(), "id", "text_hash")
    own_id, own_hash = fresh(docs, "kept_id", "kept_hash")
    first = grouped.groupBy("component").agg(F.min_by(F.struct("id", "text_hash"), order).alias("r"), F.count("*").alias("n"))
    keep = table(first.select(F.col("r.id").alias(own_id), F.col("r.text_hash").alias(own_hash)), "survivors")
    on = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(text_col) == F.col(own_hash))
    found = docs.join(keep.hint("merge"), on, "left_semi")  # by shuffle at every size, as the survivors grow with the texts
    again = grouped.groupBy("id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return found
    return found.withColumn(own_hash, F.xxhash64(text_col)).dropDuplicates([id_col, own_hash]).drop(own_hash)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs less all but one row of each component of near_duplicates(); see one_of_each()."""
    narrow = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")).alias("row"), F.col(text_col).alias("text"))
    prints = table(fingerprints(narrow, "row", "text"), "fingerprints")
    found = components(links(prints.select("fp").distinct()))
    grouped = prints.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left")
    return one_of_each(docs, grouped.select("id.*", F.coalesce("component", "fp").alias("component")), id_col, text_col)
