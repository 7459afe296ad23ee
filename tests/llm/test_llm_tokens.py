"""Operators 1, 6 and 10 against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, frame
from pyspark.sql import functions as F

from rowsmith.llm import packing, tokens, wordtable
from rowsmith.llm import token_counts as tc
from rowsmith.llm import token_files as tf

PATH = tokens.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text, end=()):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + list(end), "<u4")


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def awkward_texts(n=4000):
    rng = random.Random(1)
    alphabet = list("aAzZ09 \t\n'’,.é́É<|>#\x1c\x85\xa0\x00œ日本Σσςİ½²!-") + ["<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|>", "'s", "'LL", "don't", "x" * 30]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)] + ["a" * 300, "", "ab " * 300]


def test_ids_of_awkward_texts(library):
    texts = awkward_texts()
    got = list(tokens.Encoder(PATH).texts(pa.array([*texts, None])))
    assert all(np.array_equal(g, ids_of(library, t)) for g, t in zip(got, texts))
    assert len(got[-1]) == 0


def test_counts_of_awkward_texts(library):
    texts = awkward_texts()
    assert list(tc.MergeCounter(PATH).texts(pa.array(texts))) == [len(ids_of(library, t)) for t in texts]


def test_a_table_that_fills_up_gives_the_same(library, monkeypatch):
    encoder = tokens.Encoder(PATH)
    encoder.words = wordtable.WordTable(encoder._resolve, bits=6)  # 38 runs, then afresh
    texts = awkward_texts(400)
    assert all(np.array_equal(g, ids_of(library, t)) for g, t in zip(encoder.texts(pa.array(texts)), texts))


def test_long_texts_are_cut_at_white_space(library, monkeypatch):
    monkeypatch.setattr(wordtable, "SLICE_BYTES", 100)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    monkeypatch.setattr(tc, "SLICE_BYTES", 100)
    texts = ["the nation's words, " * 40, "y" * 700, "short"]
    want = [ids_of(library, t) for t in texts]
    assert all(np.array_equal(g, w) for g, w in zip(tokens.Encoder(PATH).texts(pa.array(texts)), want))
    assert list(tc.MergeCounter(PATH).texts(pa.array(texts))) == [len(w) for w in want]


def test_one_long_word_is_quick():
    assert tc.MergeCounter(PATH).merged(b"thequick" * 20_000) > 0


def test_token_counts(spark, library):
    out = tc.token_counts(frame(spark), PATH, limit=50)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect())
    n = {t: len(ids_of(library, t)) for _, t, *_ in documents()}
    assert got == sorted((i is None, i or 0, len((t or "").encode()), n[t], n[t] > 50) for i, t, *_ in documents())
    assert tc.token_counts(frame(spark, []), PATH).count() == 0


# -- operator 6 ---------------------------------------------------------------------


def test_code_lengths_are_optimal():
    import heapq

    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, 300)
    lengths = tf.code_lengths(counts)
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((counts * lengths).sum()) == cost
    steep = tf.code_lengths((1.6 ** np.arange(60)).astype(np.int64))
    assert steep.max() == tf.MAX_BITS and (2.0 ** -steep.astype(float)).sum() == 1
    assert tf.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0] and not tf.code_lengths(np.zeros(4)).any()


def test_limited_lengths_against_brute_force():
    from itertools import product

    rng = np.random.default_rng(2)
    for _ in range(20):
        counts = rng.integers(1, 100, 5)
        best = min(int((counts * np.array(x)).sum()) for x in product(range(1, 4), repeat=5) if sum(2.0**-k for k in x) <= 1)
        assert int((counts * tf.code_lengths(counts, most=3)).sum()) == best


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.3, n).clip(0, 999).astype(np.uint32) for n in (1, 511, 512, 513, 5000, 2, 1)]
    lengths = tf.code_lengths(np.bincount(np.concatenate(docs), minlength=1000))
    block, total = tf.pack_block([5, None, 7, 8, 9, 9, 10], docs, tf.canonical_codes(lengths), lengths)
    keys, n, ids = tf.unpack_block(block, *tf.decode_table(lengths))
    assert keys == [5, None, 7, 8, 9, 9, 10] and n.tolist() == [len(d) for d in docs]
    assert total == len(ids) and np.array_equal(ids, np.concatenate(docs))


def test_token_files(spark, library, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_TOKENS", 500)
    files, lengths = tf.write_token_files(frame(spark), PATH)
    got = tf.read_token_files(files, lengths).collect()
    rows = documents()
    assert len(got) == len(rows)
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == [0, *np.cumsum([r["n_tokens"] for r in by_start])[:-1].tolist()]
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in by_start]
    assert keys == sorted(keys)
    want = sorted((i if i is not None else -1, crc(ids_of(library, t, [2]))) for i, t, *_ in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, zlib.crc32(r["ids"])) for r in got) == want
    empty, lengths = tf.write_token_files(frame(spark, []), PATH)
    assert tf.read_token_files(empty, lengths).count() == 0


def test_token_files_are_read_by_themselves(spark):
    files, lengths = tf.write_token_files(frame(spark), PATH)
    again = spark.read.parquet(*files.inputFiles())  # what a later session has
    assert np.array_equal(tf.code_book(again), lengths)
    assert sorted(map(str, tf.read_token_files(again).collect())) == sorted(map(str, tf.read_token_files(files, lengths).collect()))


# -- operator 10 --------------------------------------------------------------------


def test_nnls_against_known_solutions():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a = rng.random((12, 8))
        x = np.maximum(rng.normal(size=8), 0)
        assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    b = rng.normal(size=12)
    x = packing.nnls(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gain <= 1e-6).all() and abs((gain * x).sum()) < 1e-6  # optimal: no gain left


@pytest.mark.parametrize("histogram", [{}, {1: 5}, {70: 50}, {128: 3}, {3: 1000, 100: 7}, {k: 1000 // k for k in range(1, 129)}])
def test_plans_use_up_the_histogram(histogram):
    plan = packing.plan_sequences(histogram, 128)
    used = {}
    for combo, times in plan:
        assert sum(combo) <= 128 and times > 0
        for k in combo:
            used[k] = used.get(k, 0) + times
    assert used == {k: n for k, n in histogram.items() if n}


def test_little_padding():
    rng = np.random.default_rng(5)
    histogram = {k: int(rng.integers(50, 60)) for k in range(1, 128)}
    plan = packing.plan_sequences(histogram, 128)
    filled = sum(k * n for k, n in histogram.items()) / (128 * sum(t for _, t in plan))
    assert filled > 0.98


def test_packing(spark, library):
    pieces = packing.pack(frame(spark), PATH, window=64, unit=8).collect()
    want = {}
    for i, t, *_ in documents():
        want.setdefault(i, []).append(ids_of(library, t, [1]))
    cover = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] <= 64
        assert any(p["doc_tokens"] == len(w) and np.array_equal(ids, w[p["start"] : p["start"] + p["length"]]) for w in want[p["doc_id"]])
        cover[p["doc_id"]] = cover.get(p["doc_id"], 0) + p["length"]
    assert cover == {i: sum(map(len, w)) for i, w in want.items()}
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.pack(frame(spark, []), PATH).count() == 0


def test_ids_are_sorted_in_tasks_of_bounded_size(spark, monkeypatch):
    """More ids give more tasks, whatever the session's number of shuffle partitions."""

    def packed():
        rows = packing.pack(frame(spark), PATH, window=64, unit=8).withColumn("task", F.spark_partition_id()).collect()
        return sorted(((r["sequence_id"], r["offset"], r["length"]) for r in rows)), {r["task"] for r in rows}, sum(r["length"] for r in rows)

    plain, tasks, total = packed()
    assert len(tasks) == 1 and 4 * total < packing.TASK_BYTES
    monkeypatch.setattr(packing, "TASK_BYTES", 4096)
    small, tasks, _ = packed()
    assert small == plain
    assert len(tasks) >= 4 * total // 4096 // 2 > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_ids_beyond_16_bits_are_refused(spark):
    docs = frame(spark)
    with pytest.raises(ValueError, match="16 bits"):
        tf.write_token_files(docs, PATH, vocabulary=70_000)
    with pytest.raises(ValueError, match="end id"):
        tf.write_token_files(docs, PATH, end_id=70_000)
