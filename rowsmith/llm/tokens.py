"""Ids of ``word_bpe_49k.json`` as its library gives them, for whole columns of text."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .wordtable import SLICE_BYTES, WordTable, marked, parts, runs, slices

VOCABULARY = "word_bpe_49k.json"
VOCABULARY_SIZE = 49408  # ids 0..49407, special ones included


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in symbols):
        symbols[b] = chr(256 + i)
    return [symbols[b] for b in range(256)]


_SYMBOLS = dict(enumerate(byte_symbols()))
#: Letters of ASCII and Latin-1: composed already, lower-cased one by one, single-script letters all.
_LATIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")


class Encoder:
    """Ids of texts, by the library on the first sight of a run and by the word table after."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordTable(self._resolve)

    def _resolve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs; a run of plain Latin letters can go to the library's merges at once.

        Such a run is one word after lower-casing, so all that the library does
        before its merges is to write its bytes as symbols.
        """
        sizes, ids, rest, model = [], [], [], self.tokenizer.model
        for k, w in enumerate(words):
            text = w.decode()
            if _LATIN.fullmatch(text):
                got = model.tokenize(text.lower().encode().decode("latin-1").translate(_SYMBOLS))
                sizes.append(len(got))
                ids += [t.id for t in got]
            else:
                rest.append((k, text, len(ids)))
                sizes.append(0)
        if rest:
            other = self.tokenizer.encode_batch_fast([text for _, text, _ in rest], add_special_tokens=False)
            parts, done = [], 0
            for (k, _, at), e in zip(rest, other):
                parts += [ids[done:at], e.ids]
                sizes[k], done = len(e.ids), at
            ids = [i for p in [*parts, ids[done:]] for i in p]
        return np.array(sizes, np.int64), np.array(ids, np.uint32)

    def _plain(self, data: np.ndarray) -> np.ndarray:
        return np.array(self.tokenizer.encode(data.tobytes().decode(), add_special_tokens=False).ids, np.uint32)

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        data, offsets = text_bytes(column)
        for i, j in slices(offsets):
            part, starts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            plain = set(marked(part, starts[:-1]).tolist())
            if j == i + 1 and len(part) > SLICE_BYTES:
                whole = [self._plain(part)] if plain else [self.words.values(p, *runs(p, np.zeros(1, np.int64)))[1] for p in parts(part)]
                yield np.concatenate(whole)
                continue
            begin, end = runs(part, starts[:-1])
            size, ids = self.words.values(part, begin, end)
            total = np.concatenate([[0], np.cumsum(size)])
            cut = total[np.searchsorted(begin, starts)]
            for k in range(j - i):
                yield self._plain(part[starts[k] : starts[k + 1]]) if k in plain else ids[cut[k] : cut[k + 1]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def id_arrays(batch_ids: list[np.ndarray], kind: str = "<u4") -> pa.Array:
    """Ids of each row as one binary value of little-endian integers."""
    sizes = np.fromiter((len(x) for x in batch_ids), np.int64, len(batch_ids)) * np.dtype(kind).itemsize
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.concatenate(batch_ids).astype(kind) if batch_ids else np.empty(0, kind)
    large = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch_ids), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
    return large.cast(pa.binary())


def grouped(items: Iterator, weight, most: int) -> Iterator[list]:
    """Consecutive items, together of about ``most`` by ``weight`` (a heavier one comes alone)."""
    held, total = [], 0
    for x in items:
        if held and total + weight(x) > most:
            yield held
            held, total = [], 0
        held.append(x)
        total += weight(x)
    if held:
        yield held
