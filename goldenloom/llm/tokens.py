"""Token counts (1): the linear longest-match automaton of Song et al., 2021 ("Fast WordPiece
Tokenization"). A trie of the vocabulary gets failure links; each link carries how many pieces are
complete when it is taken, so a word's greedy piece count comes from one scan of its characters and no
piece is ever built."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = -1


class Automaton:
    """Greedy longest-match piece counts of words over a vocabulary.

    Pieces that start with `continuation` stand only inside a word, others only at its start; with an
    empty `continuation` every piece may stand anywhere. An empty word has no pieces; a word that the
    greedy rule cannot finish counts as one (unknown) piece."""

    def __init__(self, vocabulary: Iterable[str], continuation: str = ""):
        self.next: list[dict[str, int]] = [{}]
        self.inner = 0
        if continuation:
            self.next.append({})
            self.inner = 1
        final = set()
        for piece in vocabulary:
            u = 0
            if continuation and piece.startswith(continuation):
                u, piece = 1, piece[len(continuation):]
            if not piece:
                continue
            for c in piece:
                v = self.next[u].get(c)
                if v is None:
                    v = self.next[u][c] = len(self.next)
                    self.next.append({})
                u = v
            final.add(u)
        n = len(self.next)
        self.link, self.popped = [NONE] * n, [0] * n
        roots = range(self.inner + 1)
        queue = deque(roots)
        while queue:
            v = queue.popleft()
            for c, u in self.next[v].items():
                queue.append(u)
                if u in final:
                    self.link[u], self.popped[u] = self.inner, 1
                    continue
                z, more = self.link[v], 0
                while z != NONE and c not in self.next[z]:
                    more += self.popped[z]
                    z = self.link[z]
                if z != NONE:
                    self.link[u], self.popped[u] = self.next[z][c], self.popped[v] + more

    def count(self, word: str) -> int:
        u, total, step, link, popped, inner = 0, 0, self.next, self.link, self.popped, self.inner
        for c in word:
            while (v := step[u].get(c)) is None:
                if link[u] == NONE:
                    return 1
                total += popped[u]
                u = link[u]
            u = v
        while u != inner and u != 0:
            if link[u] == NONE:
                return 1
            total += popped[u]
            u = link[u]
        return total


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 for itself,
    the rest from U+0100 on."""
    out, more = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + more))
            more += 1
    return out


#: Runs of letters, single digits, runs of other visible characters, and the English clitics.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END = "\n"  # stands for the word end; no byte's stand-in is a line feed


def word_end_vocabulary(path: str, end: str = "</w>") -> list[str]:
    """The pieces of a tokenizers file whose pieces carry a word-end mark; the mark becomes END."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    return [p[: -len(end)] + END if p.endswith(end) else p for p in pieces]


class WordCounter:
    """Counts of white-space chunks, remembered up to `keep` of them."""

    def __init__(self, automaton: Automaton, keep: int = 400_000):
        self.automaton, self.keep, self.known = automaton, keep, {}
        self.letters, self.words = byte_letters(), regex.compile(WORDS)

    def chunk(self, chunk: str) -> int:
        n = 0
        for word in self.words.findall(chunk.lower()):
            n += self.automaton.count("".join([self.letters[b] for b in word.encode()]) + END)
        if len(self.known) >= self.keep:
            self.known.clear()
        self.known[chunk] = n
        return n

    def text(self, text: str | None) -> tuple[int, int, int]:
        """Chunks, tokens, and most tokens of one chunk."""
        chunks = text.split() if text else []
        total, most, get = 0, 0, self.known.get
        for chunk in chunks:
            n = get(chunk)
            if n is None:
                n = self.chunk(chunk)
            total += n
            if n > most:
                most = n
        return len(chunks), total, most


_COUNTERS: dict[int, WordCounter] = {}


def token_counts(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_chunks (white-space chunks), n_tokens (greedy longest-match pieces of
    the lower-cased text), max_chunk_tokens; all long.

    A null or empty text has zeros; a null id stays null; repeated rows give repeated rows; other columns
    are ignored. Each worker builds the automaton once; texts never leave their partition."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = dict(docs.dtypes)[id_col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = shared._jid if hasattr(shared, "_jid") else id(shared.value)
        counter = _COUNTERS.get(key)
        if counter is None:
            _COUNTERS.clear()
            counter = _COUNTERS[key] = WordCounter(Automaton(shared.value))
        for b in batches:
            rows = [counter.text(t.as_py()) for t in b.column(1)]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["id", "n_chunks", "n_tokens", "max_chunk_tokens"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(count, f"id {kind}, n_chunks long, n_tokens long, max_chunk_tokens long").withColumnRenamed("id", id_col)
