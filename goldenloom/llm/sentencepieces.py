"""SentencePiece encoding and decoding (3): a relational lattice.

Texts fall into words, and words into units between characters that no piece has side by side, so the best
path of a text is that of its units one after the other. The distinct units' substrings up to the longest piece
are exploded and equi-joined to the piece table; the edges found are grouped by unit, and a higher-order
aggregate folds them to the best path (Viterbi). The paths of frequent units travel to the scan in a table of
bounded size, which packs the texts as places in it with a gap for each other unit; those units' paths are
joined to the texts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenloom.llm.common import setting, table

SPACE = "▁"
#: Units over this length are cut into overlapping blocks of it, and folded with back pointers.
BLOCK = 64
#: Units whose paths are sent to every worker: at most so many, about 45 bytes each. All others are joined.
FREQUENT_UNITS = 500_000
#: A vocabulary up to this size is broadcast; a larger one is joined as Spark sees fit.
BROADCAST_PIECES = 1_000_000
UNKNOWN_PENALTY = 10.0
#: The place that stands for a unit without one; so a table has fewer than 2^24.
GAP = 0xFFFFFF
#: Distinct units that a worker counts before it hands them on.
COUNTED = 200_000
#: Units go to finer partitions up to this number; settings above it stay, as finer ones pack worse on disk.
FINE_PARTITIONS = 48
#: Units that it hands on at once: a batch is whole in the worker's and in the executor's memory.
TOLD = 10_000


@dataclass(frozen=True)
class Pieces:
    """pieces: (piece, id, score). byte_ids: id of each byte's piece. A text gets a leading space mark."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    size: int

    @cached_property
    def longest(self) -> int:
        return max(len(p) for p, *_ in self.pieces)

    @cached_property
    def unknown_score(self) -> float:
        return min(s for *_, s in self.pieces) - UNKNOWN_PENALTY

    @cached_property
    def pairs(self) -> frozenset[str]:
        """Characters that stand side by side in a piece."""
        return frozenset(p[i : i + 2] for p, *_ in self.pieces for i in range(len(p) - 1))


def load_pieces(path: str) -> Pieces:
    """Pieces of a SentencePiece model with byte fallback. Scores are Zipf log-probabilities by the pieces'
    rank in the model, as the scores of merge models are ranks and no probabilities."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(plain))))
    pieces = tuple((sp.id_to_piece(i), i, -math.log(r + 1) - total) for r, i in enumerate(plain))
    bytes_ = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
    return Pieces(pieces, tuple(bytes_[f"<0x{b:02X}>"] for b in range(256)), n)


def _numbers(which: np.ndarray, seed: int) -> np.ndarray:
    """Those of the fixed pseudo-random odd 64-bit numbers of a seed (splitmix64) that have these places."""
    x = (which.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


@dataclass(frozen=True)
class Units:
    """The units of some texts. whole: the marked texts as one string, with a blank for each space mark; starts:
    where units start in it; first, second: two 64-bit hashes of each; edges: the texts' first units, and the end."""

    whole: str
    starts: np.ndarray
    first: np.ndarray
    second: np.ndarray
    edges: list[int]

    def named(self, which: np.ndarray) -> list[str]:
        ends = np.append(self.starts[1:], len(self.whole))
        return [self.whole[a:z].replace(" ", SPACE) for a, z in zip(self.starts[which].tolist(), ends[which].tolist())]


class Cutter:
    """Texts to their units: the parts between characters that no piece has side by side. All texts of a call
    at once, as one array of code points, without an object for each word."""

    SMALL = 0x500

    def __init__(self, pairs: frozenset[str]):
        codes = np.array([[ord(c) for c in p.replace(SPACE, " ")] for p in pairs], np.int64).reshape(-1, 2)
        self.keys = np.sort(codes[:, 0] << 21 | codes[:, 1])
        # Code points under SMALL - 1 by a table, where its last row and column stand for all others, which are searched.
        self.near = np.zeros(self.SMALL * self.SMALL, bool)
        low = codes[(codes < self.SMALL - 1).all(1)]
        self.near[low[:, 0] * self.SMALL + low[:, 1]] = True
        # Likewise the letters' numbers: a table of all would be most of a worker's memory.
        self.of_code = _numbers(np.arange(self.SMALL), 1)
        self.at_first, self.at_second = (_numbers(np.arange(64), seed) for seed in (2, 3))

    def __call__(self, texts: list[str], marked: bool = False) -> Units:
        """Empty and null texts have no units; marked: the texts are units or words that have their space marks."""
        parts = [(t if marked else " " + t) if t else "" for t in texts]
        whole = "".join(parts)
        lengths = np.array([len(p) for p in parts], np.int64)
        if not whole:
            return Units("", *[np.zeros(0, k) for k in (np.int64, np.uint64, np.uint64)], [0] * (len(parts) + 1))
        if SPACE in whole:
            whole = whole.replace(SPACE, " ")
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
        low = np.minimum(code, self.SMALL - 1).astype(np.int32)
        together = self.near[low[:-1] * self.SMALL + low[1:]]
        other = np.flatnonzero(low == self.SMALL - 1)
        if len(other) and len(self.keys):
            at = np.unique(np.concatenate([other - 1, other]))
            at = at[(at >= 0) & (at < len(together))]
            key = code[at].astype(np.int64) << 21 | code[at + 1]
            together[at] = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key
        begins = np.cumsum(lengths) - lengths
        inner = begins[(begins > 0) & (begins < len(code))]
        together[inner - 1] = False
        starts = np.concatenate([[0], np.flatnonzero(~together) + 1])
        sizes = np.diff(starts, append=len(code))
        longest = int(sizes.max())
        if longest > len(self.at_first):
            self.at_first, self.at_second = (_numbers(np.arange(2 * longest), seed) for seed in (2, 3))
        offset = np.arange(len(code), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
        letters = self.of_code[low]
        letters[other] = _numbers(code[other], 1)
        last = np.append(starts[1:], len(code)) - 1
        # Sums of each unit as differences of running sums, which may wrap around: units are too short for reduceat.
        first, second = (np.diff(np.cumsum(letters * at[offset])[last], prepend=np.uint64(0)) for at in (self.at_first, self.at_second))
        return Units(whole, starts, first, second, [*np.searchsorted(starts, begins).tolist(), len(starts)])


def chunks(texts: pa.Array, chars: int = 1 << 18) -> Iterator[list[str | None]]:
    """All texts in runs of about so many characters, so that a worker's arrays stay small."""
    run, size = [], 0
    for t in texts:
        run.append(t.as_py())
        size += len(run[-1] or "")
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def _edges(subs: DataFrame, pieces: DataFrame, unknown: float) -> DataFrame:
    """subs(unit, n, s, e, p): an edge for each substring p that is a piece or one character. Joined by
    hash, as most substrings are no piece, and then compared."""
    met = subs.withColumn("ph", F.xxhash64("p")).join(pieces, F.col("ph") == F.col("h"), "left").where("p = piece or e = s + 1")
    return met.select("unit", "n", F.expr(f"struct(e, s, if(p <=> piece, id, -1 - ascii(p)) as id, if(p <=> piece, score, {unknown}D) as score) as x"))


def _grouped(edges: DataFrame) -> DataFrame:
    # The hash leads where the grouping sorts, so that few long strings are compared.
    return edges.groupBy(F.xxhash64("unit").alias("h"), "unit").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("x")).alias("edges"))


def _short_fold() -> str:
    """SQL: the path by the edges of a short unit. The state has each end's best score and path."""
    better = "named_struct('b', a[x.s].b + x.score, 'p', concat(a[x.s].p, array(x.id)))"
    return (
        "aggregate(edges, array(named_struct('b', 0D, 'p', cast(array() as array<int>))), (a, x) -> "
        f"if(x.e >= size(a), concat(a, array({better})), if(a[x.s].b + x.score > a[x.e].b, concat(slice(a, 1, x.e), array({better})), a)), "
        "a -> element_at(a, -1).p)"
    )


def _long_fold(longest: int) -> str:
    """SQL: as _short_fold(), by blocks, an array of the edges that end in each block of BLOCK places. Spark copies a
    fold's state at every step, so the state over edges has the last ends' scores and one block's back pointers, and
    only the fold over blocks has them all. The path is read backwards in the same way."""
    let = lambda value, name, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    c, back = "a.w[size(a.w) - 1 - a.n + x.s] + x.score", "array(named_struct('s', x.s, 'id', x.id))"
    step = (
        f"case when x.e > a.n then named_struct('n', x.e, 'w', concat(if(size(a.w) < {longest}, a.w, slice(a.w, 2, {longest} - 1)), array({c})), 'now', concat(a.now, {back})) "
        f"when {c} > element_at(a.w, -1) then named_struct('n', a.n, 'w', concat(slice(a.w, 1, size(a.w) - 1), array({c})), 'now', concat(slice(a.now, 1, size(a.now) - 1), {back})) else a end"
    )
    inner = f"aggregate(y.edges, named_struct('n', o.n, 'w', o.w, 'now', cast(array() as array<struct<s:int,id:int>>)), (a, x) -> {step})"
    start = "named_struct('n', 0, 'w', array(0D), 'full', cast(array() as array<array<struct<s:int,id:int>>>))"
    pointers = f"aggregate(blocks, {start}, (o, y) -> {let(inner, 'r', 'named_struct(`n`, r.n, `w`, r.w, `full`, concat(o.full, array(r.now)))'.replace('`', chr(39)))}, o -> o.full)"
    met = f"bp[k][a.at - k * {BLOCK} - 1]"
    walk = f"aggregate(sequence(1, {BLOCK}), named_struct('at', o.at, 'now', cast(array() as array<int>)), (a, i) -> if(a.at <= k * {BLOCK}, a, named_struct('at', {met}.s, 'now', concat(a.now, array({met}.id)))))"
    ends = "named_struct('at', len, 'full', cast(array() as array<array<int>>))"
    path = f"aggregate(sequence(size(bp) - 1, 0, -1), {ends}, (o, k) -> {let(walk, 'r', 'named_struct(`at`, r.at, `full`, concat(o.full, array(r.now)))'.replace('`', chr(39)))}, o -> reverse(flatten(o.full)))"
    return let(pointers, "bp", path)


def lattice(units: DataFrame, model: Pieces) -> DataFrame:
    """units(unit, n, len), distinct and not empty, to (unit, n, path): path holds the ids of the best path, and -1 - c
    for a character with code point c that has no piece. Ties go to the earlier start."""
    longest = model.longest
    # From Arrow: rows from a list would pass Python workers of their own, which stay beside those of the scans.
    names, ids, scores = zip(*model.pieces) if model.pieces else ((), (), ())
    of_model = pa.table({"piece": pa.array(names, pa.string()), "id": pa.array(ids, pa.int32()), "score": pa.array(scores, pa.float64())})
    pieces = units.sparkSession.createDataFrame(of_model).withColumn("h", F.xxhash64("piece"))
    pieces = F.broadcast(pieces) if len(model.pieces) <= BROADCAST_PIECES else pieces
    starts = units.where(F.col("len") <= BLOCK).select("unit", "n", F.explode(F.expr("sequence(0, length(unit) - 1)")).alias("s"))
    subs = starts.select("unit", "n", "s", F.explode(F.expr(f"sequence(1, least({longest}, length(unit) - s))")).alias("l"))
    subs = subs.select("unit", "n", "s", F.expr("s + l as e"), F.expr("substring(unit, s + 1, l) as p"))
    short = _grouped(_edges(subs, pieces, model.unknown_score)).select("unit", "n", F.expr(_short_fold()).alias("path"))

    # Long ones are rare: an array of a block's substrings, so that a substring costs the same anywhere in its unit.
    blocks = units.where(F.col("len") > BLOCK).select("unit", "n", "len", F.explode(F.expr(f"sequence(0, length(unit) - 1, {BLOCK})")).alias("at"))
    blocks = blocks.select("unit", "n", "at", F.expr("len - at as rest"), F.expr(f"substring(unit, at + 1, {BLOCK + longest - 1}) as block"))
    of_start = f"transform(sequence(1, least({longest}, rest - i)), l -> named_struct('s', at + i, 'e', at + i + l, 'p', substring(block, i + 1, l)))"
    subs = blocks.select("unit", "n", F.explode(F.expr(f"flatten(transform(sequence(0, least({BLOCK}, rest) - 1), i -> {of_start}))")).alias("x")).select("unit", "n", "x.s", "x.e", "x.p")
    edges = _edges(subs, pieces, model.unknown_score).withColumn("block", F.expr(f"int((x.e - 1) div {BLOCK})"))
    of_block = edges.groupBy("unit", "block").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("x")).alias("edges"))
    of_unit = of_block.groupBy("unit").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("block", "edges"))).alias("blocks"))
    long = of_unit.select("unit", "n", F.length("unit").alias("len"), "blocks").select("unit", "n", F.expr(_long_fold(longest)).alias("path"))
    return short.union(long)


def frequent_paths(paths: DataFrame, most: int) -> tuple[pa.Table, DataFrame]:
    """(unit, n, path) of the most frequent units, `most` at most: all units over a frequency, which is found
    from a histogram of a few hundred rows; and (unit, path) of the others."""
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(paths.groupBy(step.alias("k")).count().collect(), reverse=True)
    total, least = 0, None
    for k, n in sizes:
        if total + n > most:
            break
        total, least = total + n, k
    often = F.lit(False) if least is None else step >= least
    return paths.where(often).select("unit", "n", "path").toArrow(), paths.where(~often).select("unit", "path")


def _kind(model: Pieces) -> str:
    return "<u2" if model.size <= 0xFFFF else "<u4"


def byte_path(path: list[int], model: Pieces) -> np.ndarray:
    """The path's ids, with byte pieces for characters without a piece."""
    ids: list[int] = []
    for x in path:
        ids.extend([x] if x >= 0 else [model.byte_ids[b] for b in chr(-1 - x).encode("utf-8", "surrogatepass")])
    return np.array(ids, _kind(model))


class Paths:
    """A table of units' paths, by place; the most frequent come first. Units are known by two 64-bit hashes."""

    def __init__(self, found: pa.Table, model: Pieces):
        cutter = Cutter(model.pairs)
        order = np.argsort(-found.column("n").to_numpy(), kind="stable")
        found = found.take(pa.array(order)).combine_chunks()
        lists = found.column("path").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        known = np.minimum.reduceat(flat, begins) >= 0 if len(begins) else np.zeros(0, bool)
        parts, lengths = [], (ends - begins).astype(np.int64)
        # Runs of paths without unknown characters are taken over as they are.
        at = 0
        for k in np.flatnonzero(~known).tolist():
            made = byte_path(flat[begins[k] : ends[k]].tolist(), model)
            parts += [flat[at : begins[k]].astype(_kind(model)), made]
            at, lengths[k] = int(ends[k]), len(made)
        self.ids = np.concatenate([*parts, flat[at:].astype(_kind(model))])
        self.lengths = lengths.astype(np.uint32)
        starts = np.cumsum(lengths) - lengths
        self.starts = starts.astype(np.uint32 if len(self.ids) < 1 << 32 else np.int64)
        hashes = [self._hashes(cutter, found.column("unit").slice(k, 1 << 16).to_pylist()) for k in range(0, found.num_rows, 1 << 16)]
        first, second = (np.concatenate([np.zeros(0, np.uint64), *(h[k] for h in hashes)]) for k in (0, 1))
        by_hash = np.argsort(first, kind="stable")
        self.first, self.second, self.place = first[by_hash], second[by_hash], by_hash.astype(np.uint32)
        number = np.empty(len(first), np.uint32)
        number[by_hash] = np.arange(len(first), dtype=np.uint32)
        # Most lookups end here: by the hash's upper bits, the most frequent unit that has them.
        bits = max(8, len(first).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.slot = np.full(1 << bits, GAP, np.uint32)
        self.slot[(first >> self.shift).astype(np.int64)[::-1]] = number[::-1]

    @staticmethod
    def _hashes(cutter: Cutter, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = cutter(units, marked=True)
        if len(made.first) != len(units):
            raise ValueError("a path is of a string that is no unit")
        return made.first, made.second

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The places of units by their hashes, GAP for those that aren't in the table."""
        out = np.full(len(first), GAP, np.uint32)
        if not len(self.first) or not len(first):
            return out
        number = self.slot[(first >> self.shift).astype(np.int64)]
        safe = np.minimum(number, len(self.first) - 1)
        same = (self.first[safe] == first) & (self.second[safe] == second) & (number != GAP)
        out[same] = self.place[number[same]]
        # The others share a slot with a more frequent unit, or aren't there. Equal first hashes stand side by side.
        open_ = np.flatnonzero(~same & (number != GAP))
        k = np.searchsorted(self.first, first[open_])
        while len(open_):
            inside = k < len(self.first)
            k, open_ = k[inside], open_[inside]
            near = self.first[k] == first[open_]
            k, open_ = k[near], open_[near]
            found = self.second[k] == second[open_]
            out[open_[found]] = self.place[k[found]]
            k, open_ = k[~found] + 1, open_[~found]
        return out

    def __len__(self) -> int:
        return len(self.place)



class Coder:
    """Texts to packed places of Paths, with a gap for each unit that is not in it."""

    def __init__(self, model: Pieces, paths: Paths):
        self.cut, self.paths = Cutter(model.pairs), paths

    def __call__(self, texts: list[str | None]) -> tuple[Units, np.ndarray]:
        """The units and the place of each."""
        units = self.cut(texts)
        return units, self.paths.find(units.first, units.second)


def squeezed(places: np.ndarray, squeeze) -> bytes:
    """Three planes of bytes: frequent units have small places, so the upper planes are nearly empty."""
    return squeeze(places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes())


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chunk: int = 1 << 17) -> np.ndarray:
    """flat[start : start + length] of all, one after the other."""
    parts = []
    for k in range(0, len(starts), chunk):
        s, n = starts[k : k + chunk], lengths[k : k + chunk].astype(np.int64)
        ends = np.cumsum(n)
        parts.append(flat[np.repeat(s.astype(np.int64) - ends + n, n) + np.arange(ends[-1])])
    return np.concatenate(parts) if parts else flat[:0]


class Filler:
    """Packed places, and the paths of their gaps, to ids."""

    def __init__(self, model: Pieces, paths: Paths):
        self.model, self.paths, self.open = model, paths, zstandard.ZstdDecompressor().decompress

    def __call__(self, packed: bytes, at: np.ndarray, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
        """at: the gaps' numbers in any order; their paths are values[start : start + length]."""
        planes = np.frombuffer(self.open(packed), np.uint8).reshape(3, -1).astype(np.uint32)
        places = planes[0] | planes[1] << 8 | planes[2] << 16
        t, gap = self.paths, places == GAP
        if not gap.any():
            return gathered(t.ids, t.starts[places], t.lengths[places])
        order = np.argsort(at)
        starts, lengths = starts[order], lengths[order]
        filled = gathered(values, starts, lengths)
        if (filled < 0).any():  # characters without a piece become bytes
            parts = [byte_path(values[a : a + n].tolist(), self.model) for a, n in zip(starts, lengths)]
            filled, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
        known = places[~gap]
        size = np.zeros(len(places), np.int64)
        size[gap], size[~gap] = lengths, t.lengths[known]
        of_gap = np.repeat(gap, size)
        out = np.empty(len(of_gap), t.ids.dtype)
        out[of_gap], out[~of_gap] = filled, gathered(t.ids, t.starts[known], t.lengths[known])
        return out


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """All rows in small batches, so that a worker holds few results at a time."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


class Seen:
    """Distinct units and how often they were seen, known by their hashes; each is named once."""

    def __init__(self):
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.n, self.number = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.names: list[pa.Array] = []

    def add(self, units: Units) -> None:
        """Units with one first hash and several second ones may be held more than once."""
        order = np.argsort(units.first)
        first, second = units.first[order], units.second[order]
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        at = np.flatnonzero(new)
        first, second, n = first[at], second[at], np.diff(at, append=len(order))
        k, known = np.searchsorted(self.first, first), np.zeros(len(at), bool)
        if len(self.first):
            safe = np.minimum(k, len(self.first) - 1)
            known = (self.first[safe] == first) & (self.second[safe] == second)
        np.add.at(self.n, k[known], n[known])
        k, made = k[~known], pa.array(units.named(order[at[~known]]), pa.string())
        self.first, self.second = np.insert(self.first, k, first[~known]), np.insert(self.second, k, second[~known])
        self.n, self.number = np.insert(self.n, k, n[~known]), np.insert(self.number, k, np.arange(len(made)) + len(self))
        self.names.append(made)

    def __len__(self) -> int:
        return sum(map(len, self.names))

    def told(self) -> pa.RecordBatch:
        """(unit, n), sorted, as equal beginnings side by side make the shuffle smaller."""
        names, n = pa.concat_arrays([pa.array([], pa.string()), *self.names]), np.empty(len(self), np.int64)
        n[self.number] = self.n
        order = pc.sort_indices(names)
        return pa.RecordBatch.from_arrays([names.take(order), pa.array(n).take(order)], ["unit", "n"])


def unit_counts(texts: DataFrame, model: Pieces) -> DataFrame:
    """texts(text) to distinct (unit, n, len)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = Cutter(model.pairs), Seen()
        for b in batches:
            for run in chunks(b.column(0)):
                seen.add(cut(run))
                if len(seen) > COUNTED:
                    yield from slices([seen.told()], TOLD)
                    seen = Seen()
        yield from slices([seen.told()], TOLD)

    counted = texts.mapInArrow(count, "unit string, n long")
    # The length as an aggregate: a filter on it stays above the shuffle, which lattice() so uses twice.
    return counted.groupBy("unit").agg(F.sum("n").alias("n"), F.max(F.length("unit")).alias("len"))


def unit_partitions(n: int) -> int:
    """Where Spark is set to few partitions, four times as many for units: a small input's texts have nearly as many
    different units as a larger one's, and each is a few dozen edges in the memory of its task."""
    return max(n, min(4 * n, FINE_PARTITIONS))


def _keys(text_col: str) -> list[Column]:
    """A text's key: two hashes. Rows of one text share the paths of its gaps."""
    text = F.col(text_col).cast("string")
    return [F.xxhash64(text).alias("text_hash"), F.xxhash64(text, F.lit(3)).alias("other_hash")]


def _packed(docs: DataFrame, model: Pieces, id_col: str, text_col: str, frequent: int) -> tuple[DataFrame, object]:
    """(id, text_hash, packed, filled): packed places with gaps, and the paths of the gaps' units; and the
    broadcast table of Paths. The texts are scanned twice, for gaps and for the packed texts, so that these
    needn't be written."""
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType
    units = unit_counts(docs.select(F.col(text_col).cast("string").alias("text")), model)
    # A short unit has a few dozen edges: ten thousand groups take less memory than the sort that they spare. Units'
    # partitions aren't joined by their bytes, which the lattice multiplies.
    # Texts are read and handed over in small batches, as they take memory on both sides.
    with setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "500"), setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"), setting(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "10000"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"), setting(spark, "spark.sql.shuffle.partitions", str(unit_partitions(int(spark.conf.get("spark.sql.shuffle.partitions"))))):
        paths = table(lattice(units, model), "unit-paths")
    often, others = frequent_paths(paths, min(frequent, GAP - 1))
    shared = spark.sparkContext.broadcast(Paths(often, model))
    narrow = docs.select(F.col(id_col).alias("id"), *_keys(text_col), F.col(text_col).cast("string").alias("text"))

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model, shared.value)
        for b in slices(batches):
            at = 0
            for run in chunks(b.column(2)):
                units, places = coder(run)
                rare = np.flatnonzero(places == GAP)
                edges = np.searchsorted(rare, units.edges)
                n = np.diff(edges)
                of = pa.array(at + np.repeat(np.arange(len(run)), n))
                place = np.arange(len(rare)) - np.repeat(edges[:-1], n)
                yield pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(1).take(of), pa.array(place.astype(np.int32)), pa.array(units.named(rare), pa.string())], ["text_hash", "other_hash", "place", "unit"])
                at += len(run)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, squeeze = Coder(model, shared.value), zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            packed = []
            for run in chunks(b.column(3)):
                units, places = coder(run)
                packed += [squeezed(places[a:z], squeeze) for a, z in zip(units.edges, units.edges[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(packed, pa.binary())], ["id", "text_hash", "other_hash", "packed"])

    keys = [T.StructField("text_hash", T.LongType()), T.StructField("other_hash", T.LongType())]
    whole = narrow.mapInArrow(pack, T.StructType([T.StructField("id", id_type), *keys, T.StructField("packed", T.BinaryType())]))
    if others.isEmpty():  # then no text has a gap
        return whole.select("id", "text_hash", "packed", F.lit(None).cast("array<struct<place:int,path:array<int>>>").alias("filled")), shared
    rare = narrow.select("text_hash", "other_hash", "text").mapInArrow(gaps, T.StructType([*keys, T.StructField("place", T.IntegerType()), T.StructField("unit", T.StringType())]))
    # Written before they are grouped, so that the shuffles that bring units to their paths are gone when the texts are shuffled.
    of_gaps = table(rare.join(others, "unit").select("text_hash", "other_hash", "place", "path"), "gap-paths")
    filled = of_gaps.groupBy("text_hash", "other_hash").agg(F.collect_set(F.struct("place", "path")).alias("filled"))
    return whole.join(filled, ["text_hash", "other_hash"], "left").select("id", "text_hash", "packed", "filled"), shared


def _ids(filler: Filler, b: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The ids of each row. The batch's gaps are read as arrays, without an object for each."""
    lists = b.column(3)
    paths = lists.values.field("path")
    ends, at = paths.offsets.to_numpy(), lists.values.field("place").to_numpy(zero_copy_only=False)
    values = paths.values.to_numpy(zero_copy_only=False)
    edges, there = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
    for k, packed in enumerate(b.column(2)):
        i, j = (edges[k], edges[k + 1]) if there[k] else (0, 0)
        yield filler(packed.as_py(), at[i:j], ends[i:j].astype(np.int64), np.diff(ends[i : j + 1]).astype(np.int64), values)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)))


def encode(docs: DataFrame, model: Pieces, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT_UNITS) -> DataFrame:
    """(id, text_hash, ids array<int>): one row per input row.

    A null or empty text has no ids. Rows equal in id and text give equal rows; a null id stays null; an
    empty table gives an empty one. Other columns are ignored."""
    whole, shared = _packed(docs, model, id_col, text_col, frequent)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler = Filler(model, shared.value)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(list(_ids(filler, b)))], ["id", "text_hash", "ids"])

    return whole.mapInArrow(fill, T.StructType([whole.schema["id"], whole.schema["text_hash"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def piece_bytes(model: Pieces) -> list[bytes]:
    out = [b""] * model.size
    for p, i, _ in model.pieces:
        out[i] = p.replace(SPACE, " ").encode()
    for b, i in enumerate(model.byte_ids):
        out[i] = bytes([b])
    return out


class Decoder:
    """Ids to the bytes of their text: pieces joined, space marks as spaces, less the leading one."""

    def __init__(self, model: Pieces):
        made = piece_bytes(model)
        self.lengths = np.array([len(x) for x in made], np.uint32)
        self.starts = np.cumsum(self.lengths.astype(np.int64)) - self.lengths
        self.flat = np.frombuffer(b"".join(made), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        return gathered(self.flat, self.starts[ids], self.lengths[ids]).tobytes().removeprefix(b" ")


def decode(encoded: DataFrame, model: Pieces) -> DataFrame:
    """encoded(id, ids) to (id, text), one row per input row. The text is that which was encoded, but for space
    marks in it. No or null ids give an empty text; other columns are ignored; an empty table gives an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for b in slices(batches):
            texts = [decoder(np.array(x.as_py() or [], np.int64)).decode("utf-8", "replace") for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select("id", "ids").mapInArrow(run, T.StructType([encoded.schema["id"], T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, model: Pieces, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT_UNITS, with_ids: bool = False) -> DataFrame:
    """Per document: id, n_pieces, ids_sha256 (of the ids as little-endian int32), restored (whether decoding
    the ids gives the text; null and empty texts give empty ones, which counts as restored); with_ids: and ids.

    Repeated rows give repeated rows; a null id stays null; an empty table gives an empty one; other columns are ignored."""
    whole, shared = _packed(docs, model, id_col, text_col, frequent)
    schema = T.StructType([whole.schema["id"], T.StructField("n_pieces", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("restored", T.BooleanType()), *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    empty = 42  # Spark's hash of null is the seed itself

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler, decoder = Filler(model, shared.value), Decoder(model)
        for b in slices(batches):
            n, digests, same, kept = [], [], [], []
            for h, ids in zip(b.column(1), _ids(filler, b)):
                n.append(len(ids))
                if with_ids:
                    kept.append(ids)
                digests.append(hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest())
                back = decoder(ids)
                same.append(xxhash.xxh64_intdigest(back, 42) == h.as_py() % (1 << 64) or not back and h.as_py() == empty)
            made_ids = [_lists(kept)] if with_ids else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(same, pa.bool_()), *made_ids], schema.names)

    return whole.mapInArrow(run, schema).withColumnRenamed("id", id_col)
