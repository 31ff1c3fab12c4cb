"""Line dedup (4): winnowing over line hashes.

A document is a sequence of line hashes. A *span* is the fewest consecutive lines from some line on (or up
to it) with `min_words` words; every run of that many words is covered by spans inside it, whatever
stands around it. Of each span the line with the least hash is its fingerprint, so equal runs are sure to
share fingerprints and most lines post nothing. Fingerprints seen once are dropped; the others' positions
are joined with the spans that they stand for, equal spans are joined with their earliest place, and
touching spans grow into the maximal repeated run, which goes from every later place: a run's lines all stand in
spans inside it, so this is the match extended both ways. Spans are equal if two 64-bit hashes of all their lines are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenloom.llm.common import fresh, join_heavy, named, table

MIN_WORDS = 50
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def spans(text: str | None, min_words: int = MIN_WORDS) -> dict[int, set[tuple[int, int, int, int]]]:
    """By fingerprint, the spans (hash, other hash, first line, last line) that selected it."""
    lines = (text or "").split("\n")
    hashes, others, counts = [], [], []
    for line in lines:
        words = line.split()
        counts.append(len(words))
        plain = " ".join(words).encode("utf-8", "surrogatepass")
        hashes.append(xxhash.xxh64_intdigest(plain, 4))
        others.append(xxhash.xxh64_intdigest(plain, 5))
    total = np.concatenate([[0], np.cumsum(counts)])
    n = len(lines)
    at = np.arange(n)
    last = np.searchsorted(total, total[:-1] + min_words) - 1  # the first line where enough words have come
    first = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    worded = np.array(counts) > 0
    found = {(int(a), int(z)) for a, z in zip(at[worded & (last < n)], last[worded & (last < n)])}
    enough = worded & (total[1:] >= min_words)
    found |= {(int(a), int(z)) for a, z in zip(first[enough], at[enough])}
    power, first_of, other_of = [1], [0], [0]
    for h, o in zip(hashes, others):
        first_of.append((first_of[-1] * _MULTIPLIER + h) & _MASK)
        other_of.append((other_of[-1] * _MULTIPLIER + o) & _MASK)
        power.append(power[-1] * _MULTIPLIER & _MASK)
    out: dict[int, set[tuple[int, int, int, int]]] = {}
    for a, z in found:
        whole, other = ((of[z + 1] - of[a] * power[z + 1 - a] + (z - a) * 0xD6E8FEB86659FD93) & _MASK for of in (first_of, other_of))
        out.setdefault(min(hashes[a : z + 1]), set()).add((whole, other, a, z))
    return out


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_hash, runs): the first and last lines (from 0) of the runs to delete, for documents that
    have any. Places are ordered by id (null last), text hash and line."""
    id_type = docs.schema[id_col].dataType
    span = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("o", T.LongType()), T.StructField("a", T.LongType()), T.StructField("z", T.LongType())]))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("print", T.LongType()), T.StructField("spans", span)])
    kind = pa.list_(pa.struct([("h", pa.int64()), ("o", pa.int64()), ("a", pa.int64()), ("z", pa.int64())]))
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, prints, lists = [], [], []
            for k, t in enumerate(b.column(2)):
                for h, found in spans(t.as_py(), min_words).items():
                    of.append(k)
                    prints.append(signed(h))
                    lists.append([{"h": signed(w), "o": signed(o), "a": a, "z": z} for w, o, a, z in sorted(found)])
            take = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(prints, pa.int64()), pa.array(lists, kind)], ["id", "text_hash", "print", "spans"])

    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    posted = table(narrow.mapInArrow(post, schema), "line-fingerprints")
    # A run may also repeat inside one document: then one fingerprint stands for equal spans.
    inside = F.max(F.expr("size(spans) - size(array_distinct(spans.h))"))
    often = posted.groupBy("print").agg(F.count("*").alias("n"), inside.alias("again")).where("n > 1 or again > 0").select("print", "n")
    placed = table(
        join_heavy(posted, table(often, "line-repeated-fingerprints"), "print").select("id", "text_hash", F.explode("spans").alias("s")).select("id", "text_hash", "s.h", "s.o", "s.a", "s.z"), "line-spans")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_hash"), F.col("a"), F.col("o"))
    earliest = placed.groupBy("h").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    later = join_heavy(placed, table(earliest, "line-earliest-places"), "h").where((place > F.col("earliest")) & (F.col("o") == F.col("earliest.o")))
    return later.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("a", "z"))).alias("runs"))


def without(text: str, runs: list[dict]) -> tuple[str, int]:
    """The text less the lines of the runs (sorted by first line), and how many went."""
    lines, keep, at = text.split("\n"), [], 0
    for run in runs:
        keep += lines[at : max(at, run["a"])]
        at = max(at, run["z"] + 1)
    keep += lines[at:]
    return "\n".join(keep), len(lines) - len(keep)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, count_col: str = "n_deleted_lines") -> DataFrame:
    """The docs, their columns unchanged but for the text, without later repeated runs of lines that have
    `min_words` words or more, and count_col (long), the number of lines that went, which replaces a column of
    that name. Columns of any other name stay. An empty table gives an empty one.

    Lines are equal if their words are (white space aside). The first place of a run, by id (null last)
    and then by text, keeps it; later ones lose it, also within a document. Rows equal in id and text
    are one document: all keep or lose the same lines. Null and wordless texts stay as they are."""
    runs = table(repeated_runs(docs, id_col, text_col, min_words), "line-runs")
    columns = [c for c in docs.columns if c != count_col]
    names = fresh(docs, "other_id", "other_hash", "runs")
    right = runs.toDF(*names)
    on = F.col(id_col).eqNullSafe(F.col(names[0])) & F.xxhash64(text_col).eqNullSafe(F.col(names[1]))
    # Always by shuffle, as the runs grow with the texts.
    marked = docs.select(*named(*columns)).join(right.hint("merge"), on, "left").select(*named(*columns), names[2])
    at = columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, gone = [], []
            for t, r in zip(b.column(at), b.column(len(columns))):
                text, n = (t.as_py(), 0) if not r.is_valid else without(t.as_py(), r.as_py())
                texts.append(text)
                gone.append(n)
            arrays = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(gone, pa.int64())], inner)

    # Spark's Python operators take plain names only.
    inner = [f"c{k}" for k in range(len(columns) + 1)]
    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for n, c in zip(inner, columns)), T.StructField(inner[-1], T.LongType())])
    return marked.toDF(*inner).mapInArrow(cut, schema).toDF(*columns, count_col)
