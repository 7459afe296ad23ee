"""Operator 12: removal of repeated byte strings by a difference-cover suffix sort in blocks.

Which suffixes of the corpus share their first ``LENGTH`` bytes with another one? Suffixes
are named by a cover sample: places whose offset in their text, modulo ``PERIOD``, lies in
a difference cover. Any two places have a common shift under ``PERIOD`` that takes both to
sample places, so two suffixes tie for ``LENGTH`` bytes just if at that shift they agree
in the bytes before the sample place, in the name of the ``LENGTH - PERIOD`` bytes from
it, and in the bytes after these. The steps, over texts dealt into chunks:

1. every chunk sends the names of its sample places to buckets; a bucket is sorted alone
   and answers which names are ranked with others (``ranked``);
2. only places of such names go on. They meet, bucket by bucket, by name, the resolved
   long tie; a bucket is sorted by the few bytes before and after, and for every shift it
   answers which suffixes tie in these as well (``Bucket``);
3. chunks mark the bytes covered by tied suffixes.

So one task holds one chunk or one bucket, whose sizes are parameters, never the corpus;
the suffix array itself is never stored. Order inside a bucket is by fingerprint, as only
ties matter. Names are 40 bits in step 1, where a chance collision only sends a place on
in vain, and 96 bits in step 2, where bytes around are told apart by 64 bits a name.

Equal texts meet once: a task sends one of them on, with a mark. A name within a chunk is
sent once. The places of a name of more than ``HOT`` members would be one large group, so
their suffixes go by 96-bit names of all their ``LENGTH`` bytes instead, each once a
chunk: the same answer, spread over all buckets.

Defined results: a null text counts as empty; texts shorter than ``LENGTH`` keep all;
rows with equal texts (repeated rows too) lose all of a long enough text; matches never
span two texts, but may overlap each other; a very long text is one chunk of its own, read
in pieces; null keys stay; an empty table gives an empty result. Columns are told by place
or named by the caller, so other columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .tokens import text_bytes

LENGTH = 400
# A perfect difference set, whose differences give every residue once.
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
NAMED = LENGTH - PERIOD
BEFORE = PERIOD - 1  # bytes before a sample place that tied suffixes may begin with
CONTEXT = BEFORE + PERIOD
#: Bytes of text in a chunk, and names or places in a bucket.
CHUNK_BYTES, BUCKET_NAMES = 1 << 22, 1 << 21
#: A name of more members is not one group.
HOT = 1 << 16
#: Bytes that are fingerprinted at a time.
PIECE = 1 << 19

# Three primes under 2^32: products of residues fit 64 bits.
_PRIMES = (4294967291, 4294967279, 4294967231)
_LOW40 = np.uint64((1 << 40) - 1)


def text_key(text: Column) -> Column:
    """What rows of equal texts share: 128 bits of the SHA-256."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


class Fingerprints:
    """Residues of windows of a byte sequence that do not depend on where a window lies."""

    def __init__(self):
        rng = np.random.default_rng(12)
        self.values, self.powers = [], []
        for p in _PRIMES:
            self.values.append(rng.integers(1, p, 256).astype(np.uint64))
            prime, step, powers = np.uint64(p), np.uint64(rng.integers(1 << 20, p - 1)), np.ones(1, np.uint64)
            while len(powers) < PIECE + LENGTH + 1:
                powers = np.concatenate([powers, powers * step % prime])
                step = step * step % prime
            self.powers.append(powers)

    def of(self, data: np.ndarray, at: np.ndarray, size: int, primes: int) -> np.ndarray:
        """Residues (one row a prime) of the ``size`` bytes from each place of ``at`` (ascending)."""
        out = np.empty((primes, len(at)), np.uint64)
        for lo in range(0, len(data), PIECE):
            a, b = np.searchsorted(at, [lo, lo + PIECE])
            if a == b:
                continue
            piece, i = data[lo : lo + PIECE + size], at[a:b] - lo
            for k in range(primes):
                prime, powers = np.uint64(_PRIMES[k]), self.powers[k]
                sums = np.zeros(len(piece) + 1, np.uint64)
                np.cumsum(self.values[k][piece] * powers[: len(piece)] % prime, out=sums[1:])
                out[k, a:b] = (sums[i + size] - sums[i]) % prime * powers[PIECE - i] % prime
        return out


_FINGERPRINTS: list[Fingerprints] = []


def fingerprints() -> Fingerprints:
    """One per Python worker."""
    if not _FINGERPRINTS:
        _FINGERPRINTS.append(Fingerprints())
    return _FINGERPRINTS[0]


def _mixed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (high << np.uint64(32) | low) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _bucket(name: np.ndarray, buckets: int) -> np.ndarray:
    return ((name >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _packed(x: np.ndarray) -> bytes:
    """An array as compressed planes of bytes, after its type and length."""
    raw = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return np.array([len(x)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    raw = pa.decompress(blob[8:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


class Chunk:
    """The different texts of a chunk in order of their keys, as one run of bytes.

    ``copied``: texts that occur twice or more.
    """

    def __init__(self, table: pa.Table):
        keys = table.column("key").to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        texts = table.column("text")
        first: dict[bytes, int] = {}
        twice = set()
        for i in order:
            if keys[i] in first:
                twice.add(keys[i])
            if keys[i] not in first or not texts[first[keys[i]]].is_valid:
                first[keys[i]] = i
        self.keys = list(first)
        self.copied = np.array([k in twice for k in self.keys], bool)
        column = texts.take(pa.array(list(first.values()), pa.int64())).combine_chunks()
        self.data, self.offsets = text_bytes(column)
        # Where places are sampled: the bytes from there must be named inside the text.
        self.places = np.concatenate([self._sample(a, b) for a, b in zip(self.offsets[:-1], self.offsets[1:])] or [np.empty(0, np.int64)])

    @staticmethod
    def _sample(begin: int, end: int) -> np.ndarray:
        room = end - begin - NAMED
        if room < PERIOD:
            return np.empty(0, np.int64)
        at = (np.arange(0, room + 1, PERIOD)[:, None] + np.array(COVER)).ravel()
        return begin + at[at <= room]

    def names(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Short names (bucket and 40 bits) in order, the place of each in that order's input, and where a new one starts."""
        name = _mixed(*fingerprints().of(self.data, self.places, NAMED, 2))
        short = (_bucket(name, buckets).astype(np.uint64) << np.uint64(40)) | (name & _LOW40)
        order = np.argsort(short, kind="stable")
        short = short[order]
        return short, order, np.append(True, short[1:] != short[:-1])[: len(short)]


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_NAMES = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("names", pa.binary()), ("members", pa.binary())])
_RANKS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("code", pa.binary())])
_PLACES = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("places", pa.binary()), ("names", pa.binary()), ("sizes", pa.binary()), ("context", pa.binary())])
#: Kinds of rows: places of a name with their contexts, suffixes by the name of all their bytes.
NEAR, WHOLE = 0, 1
_TIES = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("shifts", pa.binary())])
_SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in schema)


def sampled(chunk: int, table: pa.Table, buckets: int) -> pa.Table:
    """Step 1, chunk: its different names by bucket, and how many places have each (255: that or more)."""
    short, _, new = Chunk(table).names(buckets)
    head = np.flatnonzero(new)
    name, members = short[head], np.minimum(np.diff(np.append(head, len(short))), 255).astype(np.uint8)
    bucket = (name >> np.uint64(40)).astype(np.int64)
    cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]), len(bucket))
    rows = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        low = name[a:b] & _LOW40
        rows.append((int(bucket[a]), chunk, _packed(np.diff(low, prepend=np.uint64(0))), _packed(members[a:b])))
    return _table(_NAMES, rows)


def ranked(table: pa.Table, hot: int) -> pa.Table:
    """Step 1, bucket: for each name of each chunk 0 if no other place has it, 2 if more than ``hot`` have, else 1."""
    rows = [(c, b, np.cumsum(_unpacked(n, "u8")), _unpacked(m, "u1")) for b, c, n, m in zip(*(table.column(x).to_pylist() for x in ("bucket", "chunk", "names", "members")))]
    if not rows:
        return _table(_RANKS, [])
    names, members = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows])
    order = np.argsort(names, kind="stable")
    names = names[order]
    head = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    total = np.add.reduceat(members[order].astype(np.int64), head)
    # A chunk's count ends at 255, so a name met that often may be hot.
    full = np.maximum.reduceat(members[order], head) == 255
    code = np.empty(len(names), np.uint8)
    code[order] = np.repeat(np.where(full | (total > hot), 2, np.where(total > 1, 1, 0)).astype(np.uint8), np.diff(np.append(head, len(names))))
    out, at = [], 0
    for chunk, bucket, own, _ in rows:
        mine = code[at : at + len(own)]
        at += len(own)
        if mine.any():
            out.append((chunk, bucket, _packed(mine)))
    return _table(_RANKS, out)


def _contexts(data: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes before and after the named ones of each place (0 outside its text), and the shifts that stay inside."""
    text = np.searchsorted(offsets, at, side="right") - 1
    before, after = np.minimum(BEFORE, at - offsets[text]), np.minimum(PERIOD, offsets[text + 1] - at - NAMED)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(PERIOD, np.uint8)])
    out = np.empty((len(at), CONTEXT), np.uint8)
    out[:, :BEFORE] = np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[at]
    out[:, BEFORE:] = np.lib.stride_tricks.sliding_window_view(padded, PERIOD)[at + BEFORE + NAMED]
    short = np.flatnonzero(before < BEFORE)
    out[short] *= np.arange(CONTEXT) >= (BEFORE - before[short])[:, None]
    short = np.flatnonzero(after < PERIOD)
    out[short] *= np.arange(CONTEXT) < (BEFORE + after[short])[:, None]
    # A suffix that begins ``d`` before the place takes d bytes before and PERIOD - d after.
    return out, np.stack([PERIOD - after, before]).astype(np.uint8)


def related(chunk: int, table: pa.Table, ranks: pa.Table, buckets: int) -> pa.Table:
    """Step 2, chunk: its places of names that others have, with their contexts; of hot names, suffixes by whole names."""
    if not ranks.num_rows:
        return _table(_PLACES, [])
    own = Chunk(table)
    short, order, new = own.names(buckets)
    name_of = np.cumsum(new) - 1
    code = np.zeros(name_of[-1] + 1, np.uint8)
    bucket_of = (short[new] >> np.uint64(40)).astype(np.int64)
    for b, blob in zip(ranks.column("bucket").to_pylist(), ranks.column("code").to_pylist()):
        a, z = np.searchsorted(bucket_of, [b, b + 1])
        code[a:z] = _unpacked(blob, "u1")
    of_place = np.empty(len(short), np.uint8)
    of_place[order] = code[name_of]
    at = own.places[of_place == 1]
    r = fingerprints().of(own.data, at, NAMED, 3)
    name = _mixed(r[0], r[1])
    context, shifts = _contexts(own.data, own.offsets, at)
    rows = []
    for b, mine in _by_bucket(_bucket(name, buckets)):
        names = np.stack([name[mine], r[2][mine]]).ravel()
        rows.append((b, chunk, NEAR, _packed(at[mine]), _packed(names), _packed(shifts[:, mine].ravel()), _packed(context[mine].ravel())))
    hot = own.places[of_place == 2]
    if len(hot):
        _, shifts = _contexts(own.data, own.offsets, hot)
        starts = np.zeros(len(own.data) + 1, bool)
        for d in range(PERIOD):
            starts[hot[(shifts[0] <= d) & (d <= shifts[1])] - d] = True
        at = np.flatnonzero(starts)
        r = fingerprints().of(own.data, at, LENGTH, 3)
        name = _mixed(r[0], r[1])
        for b, mine in _by_bucket(_bucket(name, buckets)):
            mine = mine[np.lexsort((r[2][mine], name[mine]))]
            both = np.stack([name[mine], r[2][mine]])
            head = np.flatnonzero(np.append(True, (both[:, 1:] != both[:, :-1]).any(axis=0)))
            members = np.diff(np.append(head, len(mine))).astype(np.uint32)
            rows.append((b, chunk, WHOLE, _packed(at[mine]), _packed(both[:, head].ravel()), _packed(members), None))
    return _table(_PLACES, rows)


def _by_bucket(bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    cut = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)[: len(order)]), len(order))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(bucket[order[a]]), order[a:b]


def _groups(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each pair of 64-bit values, and the size of each group."""
    one, two = one.astype(np.uint64), two.astype(np.uint64)
    with np.errstate(over="ignore"):
        mark = _mixed(one, one) ^ two
    order = np.argsort(mark)
    m, a, b = mark[order], one[order], two[order]
    if ((m[1:] == m[:-1]) & ((a[1:] != a[:-1]) | (b[1:] != b[:-1]))).any():  # two pairs share a mark
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(np.append(False, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(order)])
    return number, np.bincount(number)


#: Values that stand for a byte at its place in a context; sums of them tell contexts of one name apart (64 bits).
_BYTE_VALUES = np.random.default_rng(13).integers(0, 1 << 64, (CONTEXT, 256), dtype=np.uint64)


def _tied_shifts(name: np.ndarray, low: np.ndarray, high: np.ndarray, context: np.ndarray) -> np.ndarray:
    """For each place the shifts, as bits, at which its suffix ties with that of another place of its name."""
    one = np.uint64(1)
    value = lambda c, rows=slice(None): _BYTE_VALUES[c][context[rows, c]]
    with np.errstate(over="ignore"):
        whole = low << np.uint64(8) | high
        for c in range(CONTEXT):
            whole += value(c)
        same, sizes = _groups(name, whole)
        ties = np.where(sizes[same] > 1, ((one << (high + one)) - one) & ~((one << low) - one), np.uint64(0))
        # One place of each kind stands for it, where a name has several kinds.
        kind = np.unique(same, return_index=True)[1]
        by_name, kinds = _groups(name[kind], np.zeros(len(kind)))
        kind = kind[kinds[by_name] > 1]
        found, mark = ties[kind], np.zeros(len(kind), np.uint64)
        for c in range(BEFORE, CONTEXT):
            mark += value(c, kind)
        for d in range(PERIOD):
            if d:
                mark += value(BEFORE - d, kind) - value(CONTEXT - d, kind)
            rows = np.flatnonzero((low[kind] <= d) & (d <= high[kind]))
            group, sizes = _groups(name[kind[rows]], mark[rows])
            found[rows[sizes[group] > 1]] |= one << np.uint64(d)
    # All of a kind have what the one that stands for it has.
    stands = np.zeros(len(name), np.uint64)
    stands[same[kind]] = found
    return ties | stands[same]


def tied(table: pa.Table) -> pa.Table:
    """Step 2, bucket: for each place, at which shifts its suffix ties with another (as bits; 1 is the place itself)."""
    rows = table.to_pylist()
    out = []
    near = [r for r in rows if r["kind"] == NEAR]
    if near:
        at = [_unpacked(r["places"], "i8") for r in near]
        name, third = np.concatenate([_unpacked(r["names"], "u8").reshape(2, -1) for r in near], axis=1)
        low, high = np.concatenate([_unpacked(r["sizes"], "u1").reshape(2, -1) for r in near], axis=1).astype(np.uint64)
        context = np.concatenate([_unpacked(r["context"], "u1").reshape(-1, CONTEXT) for r in near])
        ties = _tied_shifts(_groups(name, third)[0], low, high, context)
        for r, a, mine in zip(near, at, np.split(ties, np.cumsum([len(a) for a in at])[:-1])):
            if mine.any():
                out.append((r["chunk"], _packed(a[mine > 0]), _packed(mine[mine > 0])))
    whole = [r for r in rows if r["kind"] == WHOLE]
    if whole:
        members = [_unpacked(r["sizes"], "u4") for r in whole]
        number, sizes = _groups(*np.concatenate([_unpacked(r["names"], "u8").reshape(2, -1) for r in whole], axis=1))
        again = (sizes[number] > 1) | (np.concatenate(members) > 1)
        for r, m, mine in zip(whole, members, np.split(again, np.cumsum([len(m) for m in members])[:-1])):
            if mine.any():
                a = _unpacked(r["places"], "i8")[np.repeat(mine, m)]
                out.append((r["chunk"], _packed(a), _packed(np.ones(len(a), np.uint64))))
    return _table(_TIES, out)


SCHEMA = "key binary, spans array<struct<start:long,end:long>>, kept binary"


def covered(table: pa.Table, ties: pa.Table) -> pa.Table:
    """Step 3, chunk: the removed spans and the bytes left of every text that loses any."""
    own = Chunk(table)
    starts = np.zeros(len(own.data) + 1, bool)
    for at, bits in zip(ties.column("places").to_pylist(), ties.column("shifts").to_pylist()):
        at, bits = _unpacked(at, "i8"), _unpacked(bits, "u8")
        for d in range(PERIOD):
            starts[at[(bits >> np.uint64(d) & np.uint64(1)) > 0] - d] = True
    step = np.zeros(len(own.data) + 1, np.int64)
    first = np.flatnonzero(starts)
    step[first] += 1
    step[first + LENGTH] -= 1
    whole = own.copied & (np.diff(own.offsets) >= LENGTH)
    np.add.at(step, own.offsets[:-1][whole], 1)
    np.add.at(step, own.offsets[1:][whole], -1)
    gone = np.cumsum(step[:-1]) > 0
    keys, spans, kept = [], [], []
    total = np.concatenate([[0], np.cumsum(gone)])
    for t in np.flatnonzero(total[own.offsets[1:]] > total[own.offsets[:-1]]).tolist():
        mine = gone[own.offsets[t] : own.offsets[t + 1]]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
        keys.append(own.keys[t])
        spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
        kept.append(own.data[own.offsets[t] : own.offsets[t + 1]][~mine].tobytes())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"key": pa.array(keys, pa.binary()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})


def _one_of_each(batches):
    """Of equal texts that a task reads the first goes on, and once a row without a text tells of the others."""
    seen: dict[bytes, bool] = {}
    for b in batches:
        keys = b.column(1).to_pylist()
        take, told = [], []
        for i, k in enumerate(keys):
            if k not in seen:
                seen[k] = False
                take.append(i)
            elif not seen[k]:
                seen[k] = True
                told.append(i)
        chunk, key, text = (c.take(pa.array(take + told, pa.int64())) for c in b.columns)
        text = pa.concat_arrays([text[: len(take)], pa.nulls(len(told), text.type)])
        yield pa.RecordBatch.from_arrays([chunk, key, text], names=["chunk", "key", "text"])


def repeated_bytes(docs: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, bucket_names: int = BUCKET_NAMES, hot: int = HOT) -> DataFrame:
    """``key`` (see ``text_key``), removed ``spans`` (bytes) and bytes ``kept`` of every different text that loses any."""
    text = F.col(f"`{text_col}`")
    long = docs.select(text.alias("text")).where(F.octet_length("text") >= LENGTH)
    total = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(1, -(-total // chunk_bytes)), max(1, -(-total * len(COVER) // (PERIOD * bucket_names)))
    keyed = long.select(text_key(F.col("text")).alias("key"), "text").select(F.pmod(F.xxhash64("key"), F.lit(chunks)).alias("chunk"), "key", "text")
    # The three readers of the texts share one exchange, by chunk.
    dealt = keyed.mapInArrow(_one_of_each, "chunk long, key binary, text string").groupBy("chunk")

    def number(key) -> int:
        return key[0].as_py()

    names = dealt.applyInArrow(lambda key, t: sampled(number(key), t, buckets), _ddl(_NAMES))
    ranks = names.groupBy("bucket").applyInArrow(lambda t: ranked(t, hot), _ddl(_RANKS))
    places = dealt.cogroup(ranks.groupBy("chunk")).applyInArrow(lambda key, t, r: related(number(key), t, r, buckets), _ddl(_PLACES))
    ties = places.groupBy("bucket").applyInArrow(tied, _ddl(_TIES))
    return dealt.cogroup(ties.groupBy("chunk")).applyInArrow(covered, SCHEMA)


def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sizes = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    lost = repeated_bytes(docs).select("key", sizes.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    whole = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), text_key(F.col("text")).alias("key"), F.sha2("text", 256).alias("sha"))
    none = F.lit(0).cast("long")
    return whole.join(lost, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")
    )
