"""Periodic runs of words (11), by the runs theorem.

A run is a maximal stretch whose words repeat with a smallest period. Each run's Lyndon roots are longest Lyndon words at
their starts under one of two opposite orders of the words, and the longest Lyndon word at a place ends where the next
smaller suffix starts: the next smaller value of the inverse suffix array. Each such word is extended to both sides by
longest common extensions, read off the LCP array by a sparse table of minima. A text's string ends in a symbol of its
own, so no suffix is another's prefix, and the suffix array under the opposite order is the same one reversed.

Before that texts are cut where no wanted run can be: a run of `times` periods holds each of its word pairs at least
`times - 1` times, so two neighbours whose pair is rarer in the text (by hashed counts, which are never too low) are in no
run together. What is left, stretch by stretch with a symbol of its own after each, is one string for many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of texts handled as one string; a longer text is one alone.
WORDS_AT_ONCE = 1 << 18


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of whole numbers whose last is unique: ranks by doubled prefixes, of which only
    those that are still equal are sorted again."""
    n, at = len(s), 1
    sa = np.argsort(s, kind="stable")
    first = np.concatenate([[True], s[sa[1:]] != s[sa[:-1]]])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    last = np.concatenate([first[1:], [True]])
    open_ = np.flatnonzero(~(first & last))
    while len(open_):
        key = rank[sa[open_]] * n + rank[sa[open_] + at]
        order = np.argsort(key, kind="stable")
        sa[open_], key = sa[open_][order], key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[sa[open_]] = np.maximum.accumulate(np.where(first, open_, 0))
        last = np.concatenate([first[1:], [True]])
        open_ = open_[~(first & last)]
        at *= 2
    return sa, rank


def common_prefixes(s: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of each suffix and the one before it in order; 0 for the first."""
    text, order, place = s.tolist(), sa.tolist(), rank.tolist()
    out, h = [0] * len(text), 0
    for i, r in enumerate(place):
        if r:
            j = order[r - 1]
            while text[i + h] == text[j + h]:
                h += 1
            out[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return np.array(out, np.int32)


class Extensions:
    """Longest common extensions to the right of any two places."""

    def __init__(self, s: np.ndarray):
        sa, self.rank = suffix_array(s)
        self.minima = [common_prefixes(s, sa, self.rank)]
        width = 1
        while 2 * width <= len(s):
            low = self.minima[-1]
            self.minima.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i <> j."""
        a, b = np.minimum(self.rank[i], self.rank[j]) + 1, np.maximum(self.rank[i], self.rank[j])
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            these = np.flatnonzero(level == k)
            row = self.minima[k]
            out[these] = np.minimum(row[a[these]], row[b[these] - (1 << int(k)) + 1])
        return out


def next_smaller(values: list[int]) -> np.ndarray:
    """For each place the next one with a smaller value, else the length."""
    n = len(values)
    values, found = [*values, -1], [n] * n
    for i in range(n - 2, -1, -1):
        v, j = values[i], i + 1
        while values[j] > v:
            j = found[j]
        found[i] = j
    return np.array(found, np.int64)


def runs(s: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (start, length, period), sorted, of the runs of at least `times` (2 or more) periods and `least` symbols.
    s: whole numbers; its last symbol must be unique."""
    n = len(s)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    right, left = Extensions(s), Extensions(np.concatenate([s[-2::-1], s[-1:]]))  # the last stays: it is unique there too
    found = []
    for rank in (right.rank, n - 1 - right.rank):
        end = next_smaller(rank.tolist())
        i = np.flatnonzero(end < n - 1)
        j = end[i]
        p, ahead, back = j - i, right.of(i, j), np.zeros(len(i), np.int64)
        inner = i > 0
        back[inner] = left.of(n - 2 - (i[inner] - 1), n - 2 - (j[inner] - 1))
        length = p + ahead + back
        good = (length >= times * p) & (length >= least)
        found.append(np.stack([(i - back)[good], length[good], p[good]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def text_runs(texts: list[list[bytes]], least: int = 6, times: int = 4) -> list[np.ndarray]:
    """The runs of each text, given as words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    empty, numbers = np.zeros((0, 3), np.int64), _Numbers()
    out = [empty] * len(texts)
    w = np.fromiter((numbers[x] for t in texts for x in t), np.int64, int(sizes.sum()))
    if len(w) < 2:
        return out
    text = np.repeat(np.arange(len(texts)), sizes)
    bits = max(10, int(len(w)).bit_length() + 2)
    mixed = [x.astype(np.uint64) * np.uint64(m) for x, m in ((w[:-1], 0x9E3779B97F4A7C15), (w[1:], 0xC2B2AE3D27D4EB4F), (text[:-1], 0x165667B19E3779F9))]
    hashed = mixed[0] ^ (mixed[1] >> np.uint64(7)) ^ mixed[1] ^ mixed[2]
    bucket = ((hashed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - bits)).astype(np.int64)
    tied = (text[:-1] == text[1:]) & (np.bincount(bucket, minlength=1 << bits)[bucket] >= times - 1)
    edge = np.diff(np.concatenate([[0], tied.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1  # word numbers, end exclusive
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return out
    s, at, places = [], 0, []
    for k, (a, b) in enumerate(zip(starts, ends)):
        s += [w[a:b], [len(numbers) + k]]
        places.append(at)
        at += b - a + 1
    found = runs(np.concatenate(s), least, times)
    stretch = np.searchsorted(places, found[:, 0], side="right") - 1
    whole = found[:, 0] - np.array(places, np.int64)[stretch] + starts[stretch]
    owner = text[whole]
    found[:, 0] = whole - np.concatenate([[0], np.cumsum(sizes)])[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [found[a:b] if b > a else empty for a, b in zip(cuts, cuts[1:])]


def kept_words(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words less those that stand in a run after its first period."""
    if not len(found):
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, found[:, 0] + found[:, 2], 1)
    np.add.at(inside, found[:, 0] + found[:, 1], -1)
    return [x for x, gone in zip(words, np.cumsum(inside[:-1])) if not gone]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>> by start and period, collapsed): words are divided by
    ASCII white space and numbered from 0; collapsed holds the words that are in no run after its first period, with
    a space between.

    One row per input row, repeated rows too. A null, empty or wordless text has no words, no runs and an empty
    collapsed text; a null id is kept. A text of any length is read whole (by one task, with about 4 bytes times log2(n)
    for each of the n words that are left after the cut). Other columns are ignored; an empty table gives an empty one."""
    if times < 2:
        raise ValueError("a run has two periods at least")
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def made(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = text_runs(texts, least, times)
        flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
        rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(one))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32))
        collapsed = pa.array([b" ".join(kept_words(t, f)) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(offsets, rows), collapsed], ["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, n, first = [], 0, 0
            for k in range(b.num_rows):
                words = (b.column(1)[k].as_py() or "").encode("utf-8").split()
                if held and n + len(words) > WORDS_AT_ONCE:
                    yield made(b.column(0).slice(first, len(held)), held)
                    held, n, first = [], 0, k
                held.append(words)
                n += len(words)
            if held:
                yield made(b.column(0).slice(first, len(held)), held)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = narrow.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
