"""Operator 6: token ids in files, canonical length-limited Huffman code.

1. Every text is encoded once (``tokens.Encoder``), the end id appended, and the
   ids are written to the shared folder.
2. Global counts: a bincount per batch, summed by Spark per id. The alphabet is
   the vocabulary, so at most ``vocabulary`` rows reach the driver whatever the
   corpus holds.
3. Code lengths come from package-merge with at most ``MAX_BITS`` bits; codes are
   canonical, so the lengths alone (one byte per id) are the code book.
4. The ids are range-partitioned by key and sorted, and every partition is coded
   and cut into blocks of whole documents. A block decodes on its own: header,
   keys, token counts, bit offsets, bits. A document starts at a whole byte, and
   its bit offset is noted at every ``CHECKPOINT`` tokens.
5. Reading back, all segments of a block between two checkpoints are decoded in
   lockstep through one table of 2**MAX_BITS entries.

The files are Parquet with one row per block (``shard``, ``first``, ``tokens``, ``payload``):
any store that Spark reads will do, and a block is a unit of recovery.

Defined results: a null text counts as empty (the end id alone); a null key is
kept, flagged in the block, and comes first; rows of one key follow each other
in the order of their ids' hash and ids (a repeated row repeats); an empty
table gives empty files and no rows; other input columns are not looked at,
whatever their names. A document longer than a block has a block of its own.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables
from .tokens import VOCABULARY_SIZE, encoder, grouped, id_arrays, vocabulary_path

MAX_BITS = 16
CHECKPOINT = 512
BLOCK_TOKENS = 1 << 18
END_ID = 2
MAGIC = b"RSH1"
_HEADER = "<4sIQQI"  # magic, documents, tokens, bits, checkpoint interval


# -- the code -----------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols do not fit codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    # Level by level: packages of the level below merged with the symbols. A
    # level remembers which of its items are symbols; the first 2n-2 items of the
    # last one decide, and every level passes on how many it needs.
    levels, items = [], weight
    for level in range(most):
        if level:
            pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
            both = np.concatenate([weight, pairs])
            rank = np.argsort(both, kind="stable")
            items, leaf = both[rank], rank < n
        else:
            leaf = np.ones(n, bool)
        levels.append(leaf)
    need = 2 * n - 2
    got = np.zeros(n, np.int64)
    for leaf in reversed(levels):
        symbols = int(leaf[:need].sum())
        got[:symbols] += 1
        need = 2 * (need - symbols)
    lengths[order] = got
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), counting upwards."""
    codes = np.zeros(len(lengths), np.uint64)
    code = previous = 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        if n := int(lengths[i]):
            code <<= n - previous
            codes[i] = code
            code, previous = code + 1, n
    return codes


def decode_table(lengths: np.ndarray, most: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Id and length for every pattern of ``most`` bits."""
    ids, size = np.zeros(1 << most, np.uint32), np.ones(1 << most, np.uint8)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    span = (1 << (most - lengths[order].astype(np.int64))).astype(np.int64)
    filled = int(span.sum())
    ids[:filled] = np.repeat(order, span)
    size[:filled] = np.repeat(lengths[order], span)
    return ids, size


def put_bits(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of many documents (``ends``: of each in ``ids``), most significant bit first.

    Returns the bytes, the first byte of each document and one past the last, and
    the bit offset of every id within its document.
    """
    size = lengths[ids].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    starts = np.concatenate([[0], ends])[:-1]
    bytes_each = (total[ends] - total[starts] + 7) // 8
    first_byte = np.concatenate([[0], np.cumsum(bytes_each)])
    within = total[:-1] - np.repeat(total[starts], ends - starts)
    at = within + np.repeat(8 * first_byte[:-1], ends - starts)
    words = np.zeros(int(first_byte[-1]) // 4 + 2, np.uint64)
    if len(ids):
        word = at >> 5
        value = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        change = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        words[word[change]] += np.add.reduceat(value >> np.uint64(32), change)
        words[word[change] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), change)
    return np.frombuffer(words.astype(">u4").tobytes(), np.uint8), first_byte, within


# -- blocks -------------------------------------------------------------------


def pack_block(keys: list, ids: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, int]:
    """One block of whole documents, and its number of tokens."""
    tokens = np.array([len(x) for x in ids])
    ends = np.cumsum(tokens)
    stream, byte, within = put_bits(np.concatenate(ids), ends, codes, lengths)
    marks = np.concatenate([within[e - n : e : CHECKPOINT] + 8 * b for e, n, b in zip(ends, tokens, byte)])
    null = np.array([k is None for k in keys], np.uint8)
    named = np.array([0 if k is None else k for k in keys], "<i8")
    head = struct.pack(_HEADER, MAGIC, len(keys), int(ends[-1]), len(marks), CHECKPOINT)
    body = [null.tobytes(), named.tobytes(), tokens.astype("<u8").tobytes(), marks.astype("<u8").tobytes(), stream[: byte[-1]].tobytes()]
    return b"".join([head, *body]), int(ends[-1])


def unpack_block(payload: bytes, ids: np.ndarray, size: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """Keys, tokens of each document, and all ids of a block."""
    magic, docs, total, segments, every = struct.unpack_from(_HEADER, payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = struct.calcsize(_HEADER)
    null = np.frombuffer(payload, np.uint8, docs, at)
    keys = np.frombuffer(payload, "<i8", docs, at + docs)
    tokens = np.frombuffer(payload, "<u8", docs, at + 9 * docs).astype(np.int64)
    where = np.frombuffer(payload, "<u8", segments, at + 17 * docs).astype(np.int64)
    stream = np.frombuffer(payload[at + 17 * docs + 8 * segments :] + b"\0" * 3, np.uint8).astype(np.uint32)
    wide = (stream[:-2] << np.uint32(16)) | (stream[1:-1] << np.uint32(8)) | stream[2:]
    # Ids of each segment: ``every``, or what is left of its document.
    count = -(-tokens // every)
    nth = np.arange(segments) - np.repeat(np.cumsum(count) - count, count)
    left = np.minimum(np.repeat(tokens, count) - nth * every, every)
    place = np.cumsum(left) - left
    order = np.argsort(-left, kind="stable")
    where, place, left = where[order], place[order], left[order]
    out = np.empty(total, np.uint32)
    active = np.searchsorted(-left, -np.arange(every), side="left")  # segments with more ids than the step
    for step in range(int(left[0]) if segments else 0):
        n = active[step]
        where, place = where[:n], place[:n]
        look = (wide[where >> 3] >> (8 - (where & 7)).astype(np.uint32)) & np.uint32((1 << MAX_BITS) - 1)
        out[place + step] = ids[look]
        where = where + size[look]
    return [None if x else int(k) for x, k in zip(null, keys)], tokens, out


# -- the jobs -----------------------------------------------------------------


#: Ids of the largest vocabulary that fits the 16 bits of an id on its way to the files.
MOST_IDS = 1 << 16


def token_ids(docs: DataFrame, path: str, end_id: int, key_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and the ids of each text with the end id, as little-endian 16-bit integers."""
    slim = docs.select(F.col(key_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], np.uint32)

    def encode(batches):
        own = encoder(path)
        for b in batches:
            at = 0
            for rows in grouped((np.concatenate([x, end]) for x in own.texts(b.column(1))), len, 1 << 21):
                if max(int(x.max()) for x in rows) >= MOST_IDS:
                    raise ValueError(f"an id of {path} does not fit 16 bits")
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(rows)), id_arrays(rows, "<u2")], ["doc_id", "ids"])
                at += len(rows)

    return slim.mapInArrow(encode, "doc_id long, ids binary")


def id_counts(ids: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs: at most one row per id of the vocabulary reaches the driver."""

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for rows in grouped((np.frombuffer(x.as_buffer(), "<u2") for x in b.column(0)), len, 1 << 20):
                total += np.bincount(np.concatenate(rows), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(vocabulary, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


def blocks(ids: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Blocks of the documents in ascending key order; ``shard`` is the place of the partition."""
    spark = ids.sparkSession
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    n = int(setting) if str(setting).isdigit() else spark.sparkContext.defaultParallelism
    ordered = ids.repartitionByRange(n, *keys[:2]).sortWithinPartitions(*keys)

    def pack(batches):
        shard, first, codes = TaskContext.get().partitionId(), 0, canonical_codes(lengths)
        rows = ((k, np.frombuffer(x.as_buffer(), "<u2")) for b in batches for k, x in zip(b.column(0).to_pylist(), b.column(1)))
        for group in grouped(rows, lambda r: len(r[1]), BLOCK_TOKENS):
            block, tokens = pack_block([k for k, _ in group], [x for _, x in group], codes, lengths)
            columns, kinds = [[shard], [first], [tokens], [block]], [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "first", "tokens", "payload"])
            first += tokens

    return ordered.mapInArrow(pack, "shard int, first long, tokens long, payload binary")


#: The shard of the row that holds the code book.
BOOK = -1


def write_token_files(
    docs: DataFrame, path: str, end_id: int = END_ID, key_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY_SIZE
) -> tuple[DataFrame, np.ndarray]:
    """Writes the blocks in ascending key order; the written table and its code book (the code lengths).

    The code book is in the table as well, as the payload of a row of shard ``BOOK``,
    one byte per id, so that the files can be read by themselves.
    """
    if vocabulary > MOST_IDS or not 0 <= end_id < vocabulary:
        raise ValueError(f"ids are kept in 16 bits: at most {MOST_IDS} of them, the end id among them; got {vocabulary} and {end_id}")
    ids = tables.written(token_ids(docs, path, end_id, key_col, text_col), "token-ids")
    lengths = code_lengths(id_counts(ids, vocabulary))
    coded = blocks(ids, lengths)
    book = ids.sparkSession.createDataFrame([(BOOK, 0, 0, bytearray(lengths.astype(np.uint8).tobytes()))], coded.schema)
    return tables.written(coded.unionByName(book), "token-files"), lengths


def code_book(files: DataFrame) -> np.ndarray:
    """The code lengths that the files were written with: one row reaches the driver."""
    row = files.where(F.col("shard") == BOOK).select("payload").first()
    if row is None:
        raise ValueError("no code book in the files")
    return np.frombuffer(bytes(row["payload"]), np.uint8).astype(np.int64)


def read_token_files(files: DataFrame, lengths: np.ndarray | None = None) -> DataFrame:
    """Per document in the files: ``doc_id, start, n_tokens, ids`` (little-endian 32-bit).

    The code book comes from the files, unless it is given.
    """
    lengths = code_book(files) if lengths is None else lengths
    files = files.where(F.col("shard") != BOOK)
    # A block knows the tokens before it in its shard. Shards are partitions of the
    # sorted table: their totals are one row for each, whatever the corpus holds,
    # so a single task may sum them up and every task may have them.
    sizes = files.groupBy("shard").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = files.join(F.broadcast(shards), "shard").select("payload", (F.col("before") + F.col("first")).alias("base"))

    def read(batches):
        table = decode_table(lengths)
        for b in batches:
            for payload, base in zip(b.column(0), b.column(1).to_pylist()):
                keys, n, ids = unpack_block(payload.as_py(), *table)
                ends = np.cumsum(n)
                columns = [pa.array(keys, pa.int64()), pa.array(base + ends - n, pa.int64()), pa.array(n, pa.int64()), id_arrays(np.split(ids, ends[:-1]))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the corpus as token files, read them back, and digest what came back."""
    files, _ = write_token_files(tables.table(spark, sf_dir, "documents"), vocabulary_path())
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
