"""Operator 11 against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame

from rowsmith.llm import periodic_runs as pr


def brute(words):
    """All runs: for each period, maximal stretches that match one period off; smallest period of each interval."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def batch_runs(texts):
    start, end, period, text, begin = pr.runs_of(texts)
    out = [[] for _ in texts]
    for s, e, q, t in zip(start.tolist(), end.tolist(), period.tolist(), text.tolist()):
        out[t].append((s - int(begin[t]), e - s, q))
    return out


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def thue_morse(n):
    return [str(bin(i).count("1") % 2) for i in range(n)]


def shaped(rng):
    """A text of repetitions inside repetitions, with changes."""
    out = []
    while len(out) < rng.randint(1, 200):
        unit = [rng.choice("abcdefg"[: rng.randint(1, 7)]) for _ in range(rng.randint(1, 15))]
        unit = unit * rng.randint(1, 6) + [rng.choice("xyz")] * rng.randint(0, 2)
        out += unit * rng.randint(1, 5)
        if rng.random() < 0.5:
            out[rng.randrange(len(out))] = "q"
    return out


def test_shaped_texts_in_one_batch():
    rng = random.Random(5)
    texts = [shaped(rng) for _ in range(400)] + [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 777, fibonacci(700), thue_morse(700)]
    texts += [list("abcabd") * 40 + list("abc"), [str(i) for i in range(300)], [str(i) for i in range(150)] * 2, [str(i) for i in range(6)] * 2, [str(i) for i in range(5)] * 2]
    for got, words in zip(batch_runs(texts), texts):
        assert got == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aab"), max_size=60), max_size=4))
def test_small_alphabets(texts):
    assert batch_runs(texts) == [brute(t) for t in texts]


def test_a_long_text_is_no_danger():
    words = ["w"] * 200_000 + [str(i % 5000) for i in range(200_000)]
    (got,) = batch_runs([words])
    assert got == [(0, 200_000, 1), (200_000, 200_000, 5000)]


def test_a_fingerprint_that_lies_is_found(monkeypatch):
    true, seeds = pr.Extensions._same, []

    class Lying(pr.Extensions):
        def __init__(self, ids, seed):
            super().__init__(ids, seed)
            seeds.append(seed)

        def _same(self, i, j, n):
            return true(self, i, j, n) if seeds[-1] > 1 else i == i

    monkeypatch.setattr(pr, "Extensions", Lying)
    words = list("abc") * 10 + list("xyzuvw")
    assert batch_runs([words]) == [brute(words)] and seeds == [1, 2]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def digests(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = None if not runs else 1000 * top[1] // top[2]
    return doc_id, len(runs), *top, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))


def test_frame_with_clashing_names(spark):
    rows = documents()
    got = pr.periodic_runs(frame(spark, rows).withColumnRenamed("host", "runs"))
    assert got.columns.count("runs") == 1 and "lang" in got.columns and "text" not in got.columns
    wanted = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        wanted.append((r[0], brute(words), collapsed(words, brute(words))))
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr) == sorted(wanted, key=repr)
    assert pr.periodic_runs(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("shift", [0, 7919])
def test_query_on_a_small_table(spark, tmp_path, shift):
    rows = [(None if r[0] is None else r[0] * 13 + shift, r[1]) for r in documents()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in pr.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((digests(*r) for r in rows), key=repr)
