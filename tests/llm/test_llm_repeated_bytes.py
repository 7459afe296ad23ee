"""Operator 12 against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, frame

from rowsmith.llm import repeated_bytes as rb


def brute(texts, length=400):
    """Removed bytes (as a mask) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


def expected(texts):
    out = []
    for t, gone in zip(texts, brute(texts)):
        data = (t or "").encode()
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def awkward_texts(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choices("abcdefgh é\n", k=n))
    passages = [letters(n) for n in (380, 395, 399, 400, 401, 405, 420, 456, 457, 700, 1500)]
    texts = [letters(rng.randint(0, 500)) + rng.choice(passages) + letters(rng.randint(0, 90)) for _ in range(60)]
    texts += ["".join(rng.choice(passages) for _ in range(3)) for _ in range(10)]
    near = list(letters(1300))
    for _ in range(12):  # near copies
        t = list(near)
        t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [passages[-1]] * 3 + ["a" * 399, "a" * 400, "a" * 401, "b" * 402, "ab" * 300, letters(399), letters(400), "", None, "short"]
    rng.shuffle(texts)
    return texts


def test_cover_has_every_difference():
    assert {(a - b) % rb.PERIOD for a in rb.COVER for b in rb.COVER} == set(range(rb.PERIOD))


@pytest.mark.parametrize("size", [dict(), dict(chunk_bytes=5000, bucket_names=300), dict(chunk_bytes=5000, bucket_names=300, hot=2), dict(hot=0)])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, size):
    texts = awkward_texts(len(size))
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, texts[0], "x", 1), (5, texts[5], "x", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, key string, chunk long").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(rb, "repeated_bytes", lambda d, f=rb.repeated_bytes: f(d, **size))
    got = [tuple(r) for r in rb.op12_repeated_bytes(spark, str(tmp_path)).collect()]
    wanted = [(r[0], *e) for r, e in zip(rows, expected([r[1] for r in rows]))]
    assert sum(w[2] for w in wanted) > 1000
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 50_000).astype(np.uint8)
    at = np.sort(rng.choice(len(data) - rb.LENGTH, 500, replace=False))
    whole = rb.Fingerprints().of(data, at, rb.NAMED, 3)
    monkeypatch.setattr(rb, "PIECE", 1000)
    pieces = rb.Fingerprints()
    assert len(np.unique(pieces.of(data, at, rb.NAMED, 3)[0])) == len(np.unique(whole[0])) == len(at)
    moved = pieces.of(data[137:], at[at >= 137] - 137, rb.NAMED, 3)
    assert (moved == pieces.of(data, at, rb.NAMED, 3)[:, at >= 137]).all()


def test_spans_and_empty_tables(spark):
    rows = documents()
    texts = sorted({r[1] for r in rows if r[1]})
    masks = dict(zip([r[1] for r in rows], brute([r[1] for r in rows])))
    found = rb.repeated_bytes(frame(spark, rows)).join(spark.createDataFrame([(t,) for t in texts], "text string").withColumn("key", rb.text_key("text")), "key")
    got = {r.text: [tuple(s) for s in r.spans] for r in found.collect()}
    wanted = {}
    for t in texts:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], masks[t].astype(np.int8), [0]])))
        if len(edge):
            wanted[t] = [tuple(x) for x in edge.reshape(-1, 2).tolist()]
    assert got == wanted and wanted
    assert rb.repeated_bytes(frame(spark, rows).limit(0)).count() == 0
