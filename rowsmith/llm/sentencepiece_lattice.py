"""Operator 3: SentencePiece encoding and decoding by a relational lattice.

A text is normalised as the model file says (a space in front, spaces as U+2581) and
cut into units at places that no piece of the vocabulary spans, so the best path of
the text is the best paths of its units, one after the other. Units are few against
their occurrences, so the lattice is built for distinct units only:

1. ``best_paths``: the substrings of a unit, of up to the longest piece's length, are
   exploded and equi-joined with the piece table (a fixed table of the model); edges
   are grouped by unit (which the table is already dealt by: no further shuffle);
   Viterbi is a fold over the edges with ``aggregate``. Of equal paths the one with the longest last piece wins, as in the library. A
   character without a piece costs the model's unknown penalty and becomes its bytes.
2. ``encode``: units of a sample of documents, of bounded number, form a dictionary of at most
   ``DICTIONARY`` units that every task has. Documents are dealt, compressed, in blocks of
   about ``BLOCK_BYTES`` of text. A block names each unit it holds beyond the dictionary
   once, whatever the number of its documents; those units get their paths the same way
   and come back to their block. Names and paths move many to a row, as one text and one
   run of ids. The sample and the blocks decide what moves, never the result.
3. ``decode``: pieces and bytes are put together again.

Scores are taken as those of a unigram model, whatever trained them: the result is
the path of the highest sum of scores, equal to the library's for the same file read
as a unigram model. Units beyond ``LONG_UNIT`` characters (texts with no place to
cut) are folded in Python, in time linear in their length, where their block is.

Defined results: a null or empty text has no ids and decodes to the empty text;
U+2581 itself in a text decodes as a space, as in the library; rows are encoded one
by one, so repeated rows repeat; a null key stays null; an empty table gives an
empty result; other input columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import tables
from .tokens import grouped, id_arrays, text_bytes, vocabulary_path
from .wordtable import KEY_BYTES, SLICE_BYTES, WordTable, slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
DICTIONARY = 1 << 17
SAMPLE_DOCS = 20_000
LONG_UNIT = 64
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 23
#: In place of an id: a unit that is not in the dictionary.
ELSEWHERE = 0xFFFFFFFF
#: How much less than the least score an unknown character scores (the library's value).
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model file."""

    table: dict[str, tuple[int, float]]
    bytes: tuple[int, ...]  # id of each byte
    text: tuple[bytes, ...]  # what each id stands for
    longest: int
    unknown: float


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    table, byte, text = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte[int(piece[1:-1], 16)] = i
            text.append(bytes([int(piece[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            text.append(b"")
        else:
            table[piece] = (i, float(sp.get_score(i)))
            text.append(piece.replace(SPACE, " ").encode())
    least = min(s for _, s in table.values())
    return Pieces(table, tuple(byte), tuple(text), max(map(len, table)), least - UNKNOWN_PENALTY)


@lru_cache(maxsize=4)
def _needed(path: str) -> list[tuple[str, int, float]]:
    """The pieces that a best path can hold: not those that score less than other pieces in their place.

    Less means by more than rounding accounts for, so that equal paths stay.
    """
    model, out = pieces(path), []
    for piece, (i, score) in model.table.items():
        best = [0.0]
        for end in range(1, len(piece) + 1):
            arriving = [best[a] + got[1] for a in range(end) if end - a < len(piece) and (got := model.table.get(piece[a:end]))]
            best.append(max(arriving, default=best[end - 1] + model.unknown))
        if len(piece) == 1 or best[-1] <= score + 1e-3:
            out.append((piece, i, score))
    return out


@lru_cache(maxsize=4)
def _cuts(path: str) -> np.ndarray:
    """Pairs of bytes between which no piece goes on: both ASCII, or a space after anything else."""
    inside = {p[i : i + 2].replace(SPACE, " ") for p in pieces(path).table for i in range(len(p) - 1)}
    cut = np.zeros((256, 256), bool)
    for a in range(128):
        for b in range(128):
            cut[a, b] = chr(a) + chr(b) not in inside
    cut[128:, 32] = not any(x[1] == " " and not x[0].isascii() for x in inside)
    return cut.ravel()


def units(data: np.ndarray, starts: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units; a new text starts a new unit."""
    new = np.zeros(len(data), bool)
    new[starts[starts < len(data)]] = True
    if len(data) > 1:
        new[1:] |= cuts[(data[:-1].astype(np.int32) << 8) | data[1:]]
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], len(data))


# -- best paths -----------------------------------------------------------------------


def fold_long(unit: str, model: Pieces) -> list[int]:
    """Viterbi over one unit in Python: the last ``longest`` places are all that a step looks at."""
    n = len(unit)
    best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
    ids: list[int] = [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - model.longest), end):
            got = model.table.get(unit[start:end]) or ((-1, model.unknown) if start == end - 1 else None)
            if got and best[start] + got[1] > best[end]:
                best[end], back[end], ids[end] = best[start] + got[1], start, got[0]
    out: list[list[int]] = []
    while n:
        out.append([ids[n]] if ids[n] >= 0 else [model.bytes[b] for b in unit[back[n] : n].encode()])
        n = back[n]
    return [i for part in reversed(out) for i in part]


#: Units to a task of the lattice: their edges are sorted by unit in its memory.
TASK_UNITS = 16_384


def _folded(short: DataFrame, path: str) -> DataFrame:
    """The rows of ``short``, each with the ``ids`` of its ``unit``, of at most ``LONG_UNIT`` characters.

    Rows are grouped by all their columns: where ``short`` is dealt by some of them, nothing moves.
    """
    model, own = pieces(path), short.columns
    table = short.sparkSession.createDataFrame(_needed(path), "piece string, id int, score double")
    n = F.char_length("unit")
    starts = short.select(*own, F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    ends = starts.select(*own, "start", F.explode(F.sequence(F.col("start") + 1, F.least(F.col("start") + model.longest, n))).alias("end"))
    spanned = ends.select(*own, "start", "end", F.substring("unit", F.col("start") + 1, F.col("end") - F.col("start")).alias("piece"))
    # The piece table is the model's own: its size does not depend on the data.
    known = spanned.join(F.broadcast(table), "piece", "left").where("id is not null or end = start + 1")
    # An unknown character is noted by its place, as -1 - start, and spelled at the end.
    edge = F.struct("end", "start", F.coalesce("id", -1 - F.col("start")).alias("id"), F.coalesce("score", F.lit(model.unknown)).alias("score"))
    lattice = known.groupBy(*own).agg(F.sort_array(F.collect_list(edge)).alias("edges"))

    def step(best: Column, e: Column) -> Column:
        """Edges come by end and start; ``best`` holds score and ids for each place reached so far."""
        total = best[e["start"]]["score"] + e["score"]
        arrived = F.array(F.struct(total.alias("score"), F.concat(best[e["start"]]["ids"], F.array(e["id"])).alias("ids")))
        return (
            F.when(F.size(best) <= e["end"], F.concat(best, arrived))
            .when(total > best[e["end"]]["score"], F.concat(F.slice(best, F.lit(1), e["end"]), arrived))
            .otherwise(best)
        )

    nothing = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))
    byte = F.array(*[F.lit(i) for i in model.bytes])

    def spelled(x: Column) -> Column:
        """The bytes of the character at place -1 - x."""
        digits = F.hex(F.encode(F.substring("unit", -x, F.lit(1)), "UTF-8"))
        return F.transform(
            F.sequence(F.lit(1), F.char_length(digits), F.lit(2)), lambda k: byte[F.conv(F.substring(digits, k, F.lit(2)), 16, 10).cast("int")]
        )

    folded = lattice.select(*own, F.aggregate("edges", nothing, step, lambda best: F.element_at(best, -1)["ids"]).alias("path"))
    ids = F.when(F.exists("path", lambda x: x < 0), F.flatten(F.transform("path", lambda x: F.when(x < 0, spelled(x)).otherwise(F.array(x)))))
    return folded.select(*own, ids.otherwise(F.col("path")).alias("ids"))


def best_paths(words: DataFrame, path: str, rows: int) -> DataFrame:
    """(``unit``, ``ids``) for the distinct values of ``unit`` (spaces written as U+2581).

    ``rows``, about how many units there are, sets the number of tasks: a unit is a
    few bytes and its lattice a hundred times that, so sizes in bytes do not tell.
    """
    distinct = words.select("unit").distinct().repartition(max(1, -(-rows // TASK_UNITS)), "unit")
    done = _folded(distinct.where(F.char_length("unit") <= LONG_UNIT), path)

    def fold(batches):
        own = pieces(path)
        for b in batches:
            found = [fold_long(u, own) for u in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], ["unit", "ids"])

    return done.union(distinct.where(F.char_length("unit") > LONG_UNIT).mapInArrow(fold, "unit string, ids array<int>"))


# -- documents -----------------------------------------------------------------------


class _Dictionary(WordTable):
    """The dictionary's units and their ids, in the arrays of a word table; any other unit is marked."""

    def __init__(self, known: pa.Table, bits: int):
        units_ = pc.replace_substring(known.column("unit").combine_chunks(), SPACE, " ")
        ids = known.column("ids").combine_chunks()
        size, flat = np.diff(ids.offsets.to_numpy()), ids.values.to_numpy().astype(np.uint32)
        data, offsets = text_bytes(units_)
        short = np.diff(offsets) <= KEY_BYTES
        cut = np.concatenate([[0], np.cumsum(size)])
        self.known = data, offsets[:-1][short], offsets[1:][short]
        self.answers = size[short], flat[np.repeat(short, size)]
        self.known_long = {data[offsets[i] : offsets[i + 1]].tobytes(): flat[cut[i] : cut[i + 1]] for i in np.flatnonzero(~short)}
        self.loading = False
        super().__init__(self._resolve, bits, lower=False)

    def _clear(self) -> None:
        """Afresh, with the dictionary in it: what is missing from the table is missing from the dictionary."""
        super()._clear()
        self.loading = True
        self.values(*self.known)
        self.loading = False

    def _order(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The answers in the order the table asks for them while loading."""
        data, start, end = self.known
        place = {data[a:b].tobytes(): i for i, (a, b) in enumerate(zip(start.tolist(), end.tolist()))}
        size, flat = self.answers
        cut = np.concatenate([[0], np.cumsum(size)])
        at = [place[w] for w in words]
        return size[at], np.concatenate([flat[cut[i] : cut[i + 1]] for i in at]) if at else flat[:0]

    def _resolve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.loading:
            return self._order(words)
        found = [self.known_long.get(w, _MARK) for w in words]
        return np.array([len(f) for f in found]), np.concatenate(found) if found else np.empty(0, np.uint32)


class _Reader:
    """Ids of texts from a dictionary; units that are not in it are marked."""

    def __init__(self, path: str, known: pa.Table):
        self.path, self.cuts = path, _cuts(path)
        # Room for as many units beside the dictionary's before the table starts afresh.
        self.table = _Dictionary(known, max(10, int(2 * known.num_rows / 0.6).bit_length()))
        self.back = _Decoder(path)

    def texts(self, column: pa.Array):
        """Per text: the ids, with ELSEWHERE for each unknown unit, and those units in order."""
        column = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), SPACE, " ")
        prefix = pc.if_else(pc.equal(pc.binary_length(column), 0), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        data, offsets = text_bytes(pc.binary_join_element_wise(prefix, column, pa.scalar("", pa.large_string())))
        for i, j in slices(offsets):
            part, starts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            begin, end = units(part, starts[:-1], self.cuts)
            step = max(1, len(begin) * SLICE_BYTES // max(1, len(part)))  # a long text: so many units at once
            sizes, values = zip(*[self.table.values(part, begin[k : k + step], end[k : k + step]) for k in range(0, max(1, len(begin)), step)])
            size, ids = np.concatenate(sizes), np.concatenate(values)
            total = np.concatenate([[0], np.cumsum(size)])
            first = np.searchsorted(begin, starts)
            lost = np.flatnonzero(ids == ELSEWHERE)
            owner = np.searchsorted(total, lost, side="right") - 1
            cut = np.searchsorted(lost, total[first])
            for k in range(j - i):
                own = owner[cut[k] : cut[k + 1]]
                words = [part[begin[u] : end[u]].tobytes().decode().replace(" ", SPACE) for u in own]
                yield ids[total[first[k]] : total[first[k + 1]]], words


_MARK = np.array([ELSEWHERE], np.uint32)
_READERS: dict = {}


def _reader(path: str, shared) -> _Reader:
    """One per Python worker and dictionary."""
    if shared.id not in _READERS:
        _READERS.clear()
        _READERS[shared.id] = _Reader(path, pa.ipc.open_stream(shared.data).read_all())
    return _READERS[shared.id]


@dataclass(frozen=True)
class _Shared:
    """A dictionary as every task gets it."""

    id: str
    broadcast: object
    #: At most about so many units are beyond it, by those of the sample that are.
    beyond: int

    @property
    def data(self) -> bytes:
        return self.broadcast.value


def _dictionary(docs: DataFrame, path: str, sample_docs: int, most: int) -> _Shared:
    """The most frequent units of about ``sample_docs`` documents, at most ``most``, with their ids."""
    spark = docs.sparkSession
    # Hashes are spread evenly over 64 bits: a cut by the number of rows leaves about so many.
    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = docs.where(F.xxhash64("doc_id", "text").cast("double") <= F.lit((share - 0.5) * 2.0**64))

    def cut(batches):
        cuts = _cuts(path)
        for b in tables.sliced(batches):
            data, offsets = text_bytes(pc.binary_join_element_wise(pa.scalar(" "), pc.replace_substring(b.column(0).cast(pa.string()).fill_null(""), SPACE, " "), ""))
            seen: Counter[bytes] = Counter()
            for i, j in slices(offsets):
                part = data[offsets[i] : offsets[j]]
                raw = part.tobytes()
                seen.update(raw[x:y] for x, y in zip(*(a.tolist() for a in units(part, offsets[i:j] - offsets[i], cuts))) if y - x <= LONG_UNIT)
            columns = [pa.array([w.decode().replace(" ", SPACE) for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "n"])

    counts = tables.written(sample.select("text").mapInArrow(cut, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")), "unit-counts")
    # The most frequent ones: at least so often that no more than ``most`` are left.
    # There are far fewer different counts than units: one row each.
    often, total = 0, 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("m")).orderBy(F.col("n").desc()).collect():
        total += r["m"]
        if total > most:
            often = max(often, r["n"] + 1)
    words = counts.where(F.col("n") >= often).select("unit")
    known = best_paths(words, path, min(total, most)).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as w:
        w.write_table(known)
    shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    return _Shared(uuid4().hex, shared, int((total - known.num_rows) / share))


def _packed(batches):
    """Consecutive rows as blocks: one value of each, compressed, under a number made of it."""
    squeeze = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    parts = (x for b in tables.sliced(batches, 64) for x in tables.sliced([b], 64 if b.nbytes <= BLOCK_BYTES else 1))
    for group in grouped(parts, lambda b: b.nbytes, BLOCK_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, group[0].schema, options=squeeze) as w:
            w.write_table(pa.Table.from_batches(group).combine_chunks())
        rows = sink.getvalue().to_pybytes()
        number = int.from_bytes(hashlib.blake2b(rows, digest_size=8).digest(), "little", signed=True)
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([rows], pa.binary())], ["block", "rows"])


def _unpacked(table: pa.Table):
    """The rows of each block of a group."""
    for rows in table.column("rows"):
        yield from pa.ipc.open_stream(rows.as_buffer()).read_all().combine_chunks().to_batches()


#: Units, which write a space as U+2581, are joined by this.
BETWEEN = " "
_ASKED = "bucket int, block long, units string"
_ANSWERS = "block long, units string, sizes binary, ids binary"
#: Buckets of units to a task of the lattice.
TASK_BUCKETS = 4


def _asked(block: int, words: set[str], buckets: int) -> pa.Table:
    """A block's units beyond the dictionary, by bucket, each once."""
    dealt: dict[int, list[str]] = {}
    for w in sorted(words):
        dealt.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)
    rows = [pa.array(dealt, pa.int32()), pa.array([block] * len(dealt), pa.int64()), pa.array(map(BETWEEN.join, dealt.values()), pa.string())]
    return pa.Table.from_arrays(rows, names=["bucket", "block", "units"])


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``start`` to ``start + size`` of each, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _answered(asked: pa.Table, found: pa.Table) -> pa.Table:
    """What each block asked a bucket, with the ids of its units."""
    ids = found.column("ids").combine_chunks()
    cut, flat = ids.offsets.to_numpy().astype(np.int64), ids.values.to_numpy().astype("<u4")
    place = {w: i for i, w in enumerate(found.column("unit").to_pylist())}
    blocks, sizes, packed = asked.column("block"), [], []
    for units_ in asked.column("units").to_pylist():
        at = np.array([place[w] for w in units_.split(BETWEEN)])
        size = cut[at + 1] - cut[at]
        sizes.append(size.astype("<u2").tobytes())
        packed.append(_narrow(flat[_spans(cut[at], size)]))
    rows = [blocks, asked.column("units"), pa.array(sizes, pa.binary()), pa.array(packed, pa.binary())]
    return pa.Table.from_arrays(rows, names=["block", "units", "sizes", "ids"])


def _narrow(ids: np.ndarray) -> bytes:
    """Ids as their low halves, then their high halves: the latter are mostly zeros and shrink to nothing."""
    return np.ascontiguousarray(ids.astype("<u4").view("<u2").reshape(-1, 2).T).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(2, -1).T).view("<u4").ravel()


class _Answers:
    """The ids of a block's units beyond the dictionary."""

    def __init__(self, path: str, table: pa.Table):
        self.model = pieces(path)
        self.place: dict[str, int] = {}
        for units_ in table.column("units").to_pylist():
            for w in units_.split(BETWEEN):
                self.place[w] = len(self.place)
        sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), "<u2").astype(np.int64)
        self.cut = [0, *np.cumsum(sizes).tolist()]
        self.ids = np.concatenate([np.empty(0, np.uint32), *map(_wide, table.column("ids").to_pylist())])
        self.others: dict[str, np.ndarray] = {}

    def of(self, word: str) -> np.ndarray:
        i = self.place.get(word)
        if i is not None:
            return self.ids[self.cut[i] : self.cut[i + 1]]
        if word not in self.others:
            self.others[word] = np.array(fold_long(word, self.model), np.uint32)
        return self.others[word]

    def whole(self, ids: np.ndarray, words: list[str]) -> np.ndarray:
        """``ids`` with those of ``words`` in their marked places."""
        if not words:
            return ids
        answer, lost = [self.of(w) for w in words], ids == ELSEWHERE
        size = np.ones(len(ids), np.int64)
        size[lost] = [len(a) for a in answer]
        out = np.repeat(ids, size)
        out[np.repeat(lost, size)] = np.concatenate(answer)
        return out


def encode(
    docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, dictionary: int = DICTIONARY,
    check: bool = False,
) -> DataFrame:
    """Per row: ``doc_id, text_crc32, ids`` (little-endian 32-bit); the digest is of the normalised text.

    With ``check`` every row is decoded again in the same task: ``decoded_bytes`` and
    ``decoded_crc32`` follow, of the text that came back.
    """
    slim = docs.select(F.col(key_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = _dictionary(slim, path, sample_docs, dictionary)
    tasks = max(1, -(-shared.beyond // TASK_UNITS))
    buckets = TASK_BUCKETS * tasks
    # Texts move once: whoever names units and whoever puts the paths in share one exchange, by block.
    dealt = slim.mapInArrow(_packed, "block long, rows binary").groupBy("block")

    def missing(key, table):
        own = _reader(path, shared)
        words = {w for t in _unpacked(table) for _, found in own.texts(t.column(1)) for w in found}
        return _asked(key[0].as_py(), {w for w in words if len(w) <= LONG_UNIT}, buckets)

    asked = dealt.applyInArrow(missing, _ASKED).repartition(tasks, "bucket")
    # ``block`` goes along for no other purpose than that both readers of ``asked`` read the same rows: one exchange.
    beyond = asked.select("bucket", "block", F.explode(F.split("units", BETWEEN)).alias("unit")).groupBy("bucket", "unit").agg(F.min("block").alias("block"))
    paths = _folded(beyond, path).withColumnRenamed("bucket", "same_bucket")
    answers = asked.groupBy("bucket").cogroup(paths.groupBy("same_bucket")).applyInArrow(_answered, _ANSWERS)

    def finish(table, found):
        own, more, out = _reader(path, shared), _Answers(path, found), []
        for t in _unpacked(table):
            at = 0
            for group in grouped((more.whole(*x) for x in own.texts(t.column(1))), len, 1 << 21):
                mine = t.slice(at, len(group))
                crc = [zlib.crc32((x or "").replace(SPACE, " ").encode()) for x in mine.column(1).to_pylist()]
                columns = [mine.column(0), pa.array(crc, pa.int64()), id_arrays(group)]
                if check:
                    back = [own.back.text(ids) for ids in group]
                    columns += [pa.array([len(x) for x in back], pa.int64()), pa.array([zlib.crc32(x) for x in back], pa.int64())]
                out.append(pa.RecordBatch.from_arrays(columns, schema.names))
                at += len(group)
        return pa.Table.from_batches(out) if out else to_arrow_schema(schema).empty_table()

    schema = tables.fields(slim.select("doc_id"), "text_crc32 long, ids binary" + ", decoded_bytes long, decoded_crc32 long" * check)
    return dealt.cogroup(answers.groupBy("block")).applyInArrow(finish, schema)


class _Decoder:
    """Texts from ids: the bytes of the pieces one after the other, without the space put in front."""

    def __init__(self, path: str):
        text = pieces(path).text
        self.flat = np.frombuffer(b"".join(text), np.uint8)
        self.size = np.array([len(t) for t in text])
        self.start = np.cumsum(self.size) - self.size

    def text(self, ids: np.ndarray) -> bytes:
        n = self.size[ids]
        place = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.flat[place].tobytes()[1:]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` and the ``text`` that its ``ids`` stand for."""
    at, schema = encoded.columns.index("ids"), tables.fields(encoded, "text string")

    def join(batches):
        own = _Decoder(path)
        for b in tables.sliced(batches):
            out = [own.text(np.frombuffer(v.as_buffer(), "<u4")).decode() for v in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], schema.names)

    return encoded.mapInArrow(join, schema)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, decoded again and compared."""
    found = encode(tables.table(spark, sf_dir, "documents"), vocabulary_path(MODEL), check=True)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        "decoded_bytes",
        (F.col("decoded_crc32") == F.col("text_crc32")).alias("round_trip"),
    )
