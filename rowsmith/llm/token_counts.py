"""Operator 1: token counts by heap-and-linked-list byte-pair merging.

The number of tokens of a word is its number of initial symbols minus the number
of merges that apply. The symbols of a word form a doubly linked list; a heap
holds the adjacent pairs by (merge rank, place); the lowest is popped, checked
for being still current, merged, and the two new neighbours are pushed. No token
id is ever looked up or emitted: the merge table alone decides the count.
A word of n bytes costs O(n log n), so a text that is one long word is no danger.

Everything before the merges follows the vocabulary file: special strings inside
a text are one token each, Unicode NFC, white space collapsed, lower case by
character, split into contractions, runs of letters, single digits and runs of
anything else, then bytes. Runs seen before are answered from a bounded table
(``wordtable``), texts with ``<|`` go the plain way.

Defined results: a null text counts as empty (0 bytes, 0 tokens); rows are
independent, so repeated rows repeat; an empty table gives an empty result;
input columns other than the key and text are not looked at, whatever their
names; a null key stays null.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .tokens import byte_symbols, text_bytes, vocabulary_path
from .wordtable import SLICE_BYTES, WordTable, marked, parts, runs, slices

#: Documents of more tokens than this are reported as over the limit.
TOKEN_LIMIT = 2048

# White space and the split pattern of the vocabulary file.
WHITE = r"\t-\r \x85\xa0  -     　"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"


class MergeCounter:
    """Token counts of texts from a vocabulary file's merge list."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {p: (r, p[0] + p[1]) for r, p in enumerate(pairs)}
        self.symbols = byte_symbols()
        special = "|".join(regex.escape(t["content"]) for t in spec["added_tokens"])
        self.special, self.split = regex.compile(f"({special})"), regex.compile(SPLIT)
        self.words = WordTable(self._resolve)
        self._seen: dict[str, int] = {}

    def merged(self, word: bytes) -> int:
        """Initial symbols of ``word`` minus the merges that apply."""
        sym = [self.symbols[b] for b in word]
        sym[-1] += self.suffix
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank, heap = self.rank, []
        for i in range(n - 1):
            if got := rank.get((sym[i], sym[i + 1])):
                heap.append((got[0], i, got[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            # Stale when either side has been merged away or has grown since.
            if sym[i] is None or j >= n or sym[i] + sym[j] != joined:
                continue
            sym[i], sym[j] = joined, None
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if got := rank.get((joined, sym[k])):
                    heapq.heappush(heap, (got[0], i, got[1]))
            if (h := before[i]) >= 0:
                if got := rank.get((sym[h], joined)):
                    heapq.heappush(heap, (got[0], h, got[1]))
        return n - merges

    def _count_run(self, word: str) -> int:
        got = self._seen.get(word)
        if got is None:
            got = self.merged(word.encode())
            if len(word) <= 64:
                if len(self._seen) > 200_000:
                    self._seen.clear()
                self._seen[word] = got
        return got

    def count(self, text: str) -> int:
        """Tokens of a whole text, special strings included."""
        total = 0
        for i, piece in enumerate(self.special.split(text)):
            if i % 2:
                total += 1
            elif piece:
                piece = normalize("NFC", piece)
                piece = piece.lower() if piece.isascii() else "".join(c.lower() for c in piece)
                total += sum(self._count_run(m) for m in self.split.findall(piece))
        return total

    def _resolve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.ones(len(words), np.int64), np.array([self.count(w.decode()) for w in words], np.uint32)

    def texts(self, column: pa.Array) -> Iterator[int]:
        data, offsets = text_bytes(column)
        for i, j in slices(offsets):
            part, starts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            plain = set(marked(part, starts[:-1]).tolist())
            if j == i + 1 and len(part) > SLICE_BYTES and not plain:
                yield sum(int(self.words.values(p, *runs(p, np.zeros(1, np.int64)))[1].sum()) for p in parts(part))
                continue
            begin, end = runs(part, starts[:-1])
            _, counts = self.words.values(part, begin, end)
            total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[np.searchsorted(begin, starts)]
            for k in range(j - i):
                yield self.count(part[starts[k] : starts[k + 1]].tobytes().decode()) if k in plain else int(total[k + 1] - total[k])


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """One per Python worker, kept from task to task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def token_counts(
    docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_tokens``, ``over_limit``. One narrow stage, no shuffle."""
    slim = docs.select(F.col(key_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = tables.fields(slim.select("doc_id"), "n_bytes long, n_tokens long, over_limit boolean")

    def count(batches):
        own = counter(path)
        for b in batches:
            sizes = np.diff(text_bytes(b.column(1))[1])
            tokens = np.fromiter(own.texts(b.column(1)), np.int64, b.num_rows)
            columns = [b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return slim.mapInArrow(count, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(tables.table(spark, sf_dir, "documents"), vocabulary_path())
