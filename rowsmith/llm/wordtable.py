"""Vectorised word table for tokenizers that never look across white space.

``word_bpe_49k`` collapses white space, lower-cases, splits the text into runs
of letters, single digits and runs of other characters, and merges inside such a
run only. So the tokens of a text are the tokens of its runs, one after the
other, and a run seen before needs no second look. Texts are cut into runs with
numpy over the raw UTF-8 bytes, and runs are looked up in an open-addressing
table kept by the Python worker.

A cut is made only where the split is certain from ASCII bytes alone: at ASCII
white space, between an ASCII letter and an ASCII non-letter, before and after an
ASCII digit with an ASCII neighbour, and after ASCII punctuation other than the
apostrophe (``'s`` and the like are runs of their own). Bytes above 127 are never
cut from their neighbours, so composed characters, Unicode spaces and quotes stay
with the run and are resolved with it. Upper-case A-Z is lowered first, which the
tokenizer does anyway.

Runs of at most 24 bytes are keyed by their own bytes (three 64-bit words), so
two different runs never meet; longer ones go through a plain dict. The table
holds at most ``limit`` runs and starts afresh beyond that: memory is bounded,
the results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

KEY_BYTES = 24
#: Texts are cut into pieces of about so many bytes (at white space), which bounds the arrays.
SLICE_BYTES = 1 << 21

_SPACE, _LETTER, _DIGIT, _PUNCT, _APOS, _HIGH = range(6)


def _classes() -> np.ndarray:
    cls = np.full(256, _PUNCT, np.uint8)
    cls[128:] = _HIGH
    cls[[9, 10, 11, 12, 13, 32]] = _SPACE
    cls[48:58] = _DIGIT
    cls[65:91] = cls[97:123] = _LETTER
    cls[39] = _APOS
    return cls


def _cuts() -> np.ndarray:
    cut = np.zeros((6, 6), bool)
    cut[_SPACE, :] = True
    cut[_LETTER, [_DIGIT, _PUNCT, _APOS]] = True
    cut[_DIGIT, [_LETTER, _DIGIT, _PUNCT, _APOS]] = True
    cut[_PUNCT, [_LETTER, _DIGIT]] = True
    cut[_APOS, _DIGIT] = True
    cut[:, _SPACE] = False  # a space starts nothing
    return cut.ravel()


_CLASS, _CUT = _classes(), _cuts()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def runs(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs in ``data``; a new text always starts a new run."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cls = _CLASS[data]
    solid = cls != _SPACE
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = _CUT[cls[:-1] * np.uint8(6) + cls[1:]]
    new[doc_starts[doc_starts < n]] = True
    new &= solid
    last = solid.copy()
    last[:-1] &= ~solid[1:] | new[1:]
    return np.flatnonzero(new), np.flatnonzero(last) + 1


class WordTable:
    """Run -> sequence of unsigned 32-bit values, filled by ``resolve`` on first sight.

    ``resolve`` gets runs and returns how many values each has, and all values in order.
    """

    def __init__(self, resolve: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], bits: int = 21, lower: bool = True):
        self.resolve, self.bits, self.lower = resolve, bits, lower
        self.limit = int(0.6 * (1 << bits))
        self._clear()

    def _clear(self) -> None:
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((self.limit, 3), np.uint64)
        self.start = np.zeros(self.limit, np.int64)
        self.size = np.zeros(self.limit, np.int32)
        self.used = 0
        self.pool = np.zeros(1 << 20, np.uint32)
        self.pooled = 0
        self.long: dict[bytes, np.ndarray] = {}

    @staticmethod
    def _hash(k: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = k[:, 0] * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h = (h + k[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            h = (h + k[:, 2]) * np.uint64(0x94D049BB133111EB)
            return h ^ (h >> np.uint64(31))

    def _probe(self, keys: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where it is new."""
        mask = np.uint64((1 << self.bits) - 1)
        entry = self.slots[h & mask]
        todo = np.flatnonzero((entry >= 0) & (self.keys[entry] != keys).any(axis=1))
        step = 0
        while len(todo):
            step += 1
            e = self.slots[(h[todo] + np.uint64(step)) & mask]
            entry[todo] = e
            todo = todo[(e >= 0) & (self.keys[e] != keys[todo]).any(axis=1)]
        return entry

    def _insert(self, keys: np.ndarray, h: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Adds keys that are new and differ from each other; their entries."""
        n, mask = len(keys), np.uint64((1 << self.bits) - 1)
        entry = np.arange(self.used, self.used + n, dtype=np.int32)
        self.keys[entry] = keys
        self._store(entry, sizes, values)
        todo, step = np.arange(n), 0
        while len(todo):
            slot = (h[todo] + np.uint64(step)) & mask
            free = self.slots[slot] < 0
            _, first = np.unique(slot, return_index=True)
            won = np.zeros(len(todo), bool)
            won[first] = True
            won &= free
            self.slots[slot[won]] = entry[todo[won]]
            todo = todo[~won]
            step += 1
        self.used += n
        return entry

    def _store(self, entry: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        while self.pooled + len(values) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.pooled : self.pooled + len(values)] = values
        self.start[entry] = self.pooled + np.cumsum(sizes) - sizes
        self.size[entry] = sizes
        self.pooled += len(values)

    def values(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of values of each run, and all values of all runs in order."""
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.uint32)
        low = np.empty(len(data) + KEY_BYTES, np.uint8)
        low[: len(data)] = _LOWER[data] if self.lower else data
        low[len(data) :] = 0
        length = ends - starts
        words = np.ndarray(len(low) - 7, "<u8", low, strides=(1,))
        keys = np.empty((len(starts), 3), np.uint64)
        for i in range(3):
            keep = _KEEP[np.clip(length - 8 * i, 0, 8)]
            keys[:, i] = (words[np.minimum(starts + 8 * i, len(data))] & keep) | ~keep  # filled up with 255, which no text holds
        short = length <= KEY_BYTES
        h = self._hash(keys)
        entry = self._probe(keys, h)
        entry[~short] = -1
        missing = np.flatnonzero((entry < 0) & short)
        extra: dict[int, np.ndarray] = {}
        if len(missing):
            _, first, back = np.unique(h[missing], return_index=True, return_inverse=True)
            unlike = (keys[missing[first[back]]] != keys[missing]).any(axis=1)
            new = missing[first]
            if self.used + len(new) > self.limit:
                self._clear()
                return self.values_in_parts(data, starts, ends) if len(new) > self.limit else self.values(data, starts, ends)
            raw = low.tobytes()
            got = self.resolve([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            entry[missing] = self._insert(keys[new], h[new], *got)[back]
            for i in missing[unlike].tolist():  # two runs of one hash: next to impossible, and still right
                extra[i] = self.resolve([raw[starts[i] : ends[i]]])[1]
        for i in np.flatnonzero(~short).tolist():
            word = low[starts[i] : ends[i]].tobytes()
            if word not in self.long:
                if len(self.long) >= self.limit // 8:
                    self.long.clear()
                got = self.resolve([word])[1]
                if len(word) > 200:
                    extra[i] = got
                    continue
                self.long[word] = got
            extra[i] = self.long[word]
        entry[list(extra)] = -1
        size = np.where(entry >= 0, self.size[entry], 0).astype(np.int64)
        for i, v in extra.items():
            size[i] = len(v)
        at = np.cumsum(size) - size
        source = np.repeat(np.where(entry >= 0, self.start[entry], 0) - at, size) + np.arange(int(size.sum()))
        out = self.pool[np.minimum(source, len(self.pool) - 1)] if extra else self.pool[source]
        for i, v in extra.items():
            out[at[i] : at[i] + len(v)] = v
        return size, out

    def values_in_parts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = len(starts) // 2
        a, b = self.values(data, starts[:half], ends[:half]), self.values(data, starts[half:], ends[half:])
        return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE_BYTES together; a longer text has a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1)
        yield i, j
        i = j


def parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of about SLICE_BYTES, cut at white space (whole when it has none)."""
    at = 0
    while len(data) - at > SLICE_BYTES:
        tail = data[at + SLICE_BYTES :]
        step = 1 << 16
        for k in range(0, len(tail), step):
            space = np.flatnonzero(_CLASS[tail[k : k + step]] == _SPACE)
            if len(space):
                cut = at + SLICE_BYTES + k + int(space[0])
                yield data[at:cut]
                at = cut
                break
        else:
            break
    yield data[at:]


def marked(data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Texts that hold ``<|``, where a special string may stand; these go the plain way."""
    pos = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) > 1 else np.empty(0, np.int64)
    return np.unique(np.searchsorted(doc_starts, pos, side="right") - 1) if len(pos) else np.empty(0, np.int64)
