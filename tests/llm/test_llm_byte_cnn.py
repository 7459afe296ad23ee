"""Operator 9: held-out accuracy, folds, awkward texts."""

import zlib

import numpy as np
import pyarrow as pa
from llm_cases import documents, frame
from pyspark.sql import functions as F

from rowsmith.llm import byte_cnn as bc
from rowsmith.llm.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op9_byte_cnn"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    assert all(got[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) for d in docs)
    tested = [d for d in docs if got[d["doc_id"]]["held_out"]]
    right = [got[d["doc_id"]]["lang_pred"] == d["lang"] for d in tested]
    assert len(right) > 20 and np.mean(right) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_tables_equal_the_network():
    rng = np.random.default_rng(1)
    x = rng.integers(97, 100, (200, bc.WINDOW)).astype(np.uint8)
    y = (x[:, :50] == 97).sum(axis=1) % 2
    net = bc.train(x, y, ["a", "b"], epochs=1)
    assert np.allclose(bc.Predictor(net).windows(x), bc._forward(net, x)[2], atol=1e-4)


def test_every_window_counts():
    x = np.array([list(b"aaaa" * 64), list(b"zzzz" * 64)] * 40, np.uint8)
    net = bc.train(x, np.array([0, 1] * 40), ["a", "z"], epochs=60)
    texts = ["a" * 256, "z" * 256, "a" * 256 + "z" * 256 * 9, "a" * 256 * 9 + "z" * 256, None, "", "123 !?", "a" * 300_000]
    names, scores = bc.Predictor(net).texts(pa.array(texts))
    assert names == ["a", "z", "z", "a", "und", "und", "und", "a"]
    assert scores[2] > 0.7 and scores[4] == scores[5] == scores[6] == 0


def test_awkward_documents(spark):
    docs = frame(spark)
    net = bc.fit(docs)
    assert net.languages == ["de", "en"]
    out = bc.identify(docs, net)
    assert out.columns == docs.columns + ["_lang_pred", "lang_score"]
    rows = out.collect()
    assert len(rows) == len(documents())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["_lang_pred"] == "und") == (not letters) and (letters or r["lang_score"] == 0)
    assert docs.where(bc.held_out(F.col("doc_id")) & F.col("doc_id").isNull()).count() == 1
    empty = frame(spark, [])
    assert bc.fit(empty) is None
    assert [r["_lang_pred"] for r in bc.identify(docs.limit(1), None).collect()] == ["und"]
    assert bc.identify(empty, net).count() == 0


def test_the_held_out_fold_is_never_learned_from(spark):
    rows = [(i, "hello there" if zlib.crc32(str(i).encode()) % 5 else "never seen", "en" if zlib.crc32(str(i).encode()) % 5 else "xx") for i in range(200)]
    net = bc.fit(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING"))
    assert net.languages == ["en"]


def test_a_repeated_key_brings_one_text(spark, monkeypatch):
    given = []
    train = bc.train
    monkeypatch.setattr(bc, "train", lambda x, labels, languages: given.append(len(x)) or train(x, labels, languages, epochs=1))
    free = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:2]
    rows = [(free[0], f"hello number {i}", "en") for i in range(3000)] + [(free[1], "der die das", "de")]
    assert bc.fit(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")).languages == ["de", "en"]
    assert given == [2]
