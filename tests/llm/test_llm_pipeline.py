"""The pipeline, stage by stage against plain versions on awkward documents, and whole."""

import re

import numpy as np
from llm_cases import documents, frame
from pyspark.sql import functions as F
from test_llm_chat_rules import counts
from test_llm_minhash import brute as components
from test_llm_pii import brute as personal

import corpus_pipeline as cp
from rowsmith.llm import tables

SF = "/root/testdata/sf0.001"


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None, r["text"] or "")


def test_stages(spark):
    docs = frame(spark)
    rows = docs.collect()
    language = cp.language_id(spark, docs, SF)
    assert language.columns == docs.columns
    kept = sorted(key(r) for r in language.collect())
    assert set(kept) <= {key(r) for r in rows}
    assert all(any(c.isalpha() for c in k[3]) for k in kept)
    assert {key(r) for r in rows if r["lang"] is not None and len(r["text"] or "") > 100} <= set(kept)

    docs = tables.written(language, "t")
    quality = cp.quality_rules(spark, docs, SF)
    assert quality.columns == docs.columns
    good = lambda t: (c := counts(t))[0] >= 10 and 100 * c[4] <= 20 * c[0]
    assert sorted(key(r) for r in quality.collect()) == sorted(k for k in kept if good(k[3]))

    docs = tables.written(quality, "t")
    before = sorted((key(r) for r in docs.collect()))
    unique = cp.near_dedup(spark, docs, SF)
    assert unique.columns == docs.columns
    after = sorted(key(r) for r in unique.collect())
    named = [(None if k[0] else k[1], k[3]) for k in before]
    stay = {c for null, i, _, c in components(named, n=5) if not null}
    assert sorted(k[1] for k in after if not k[0]) == sorted(stay)  # one row of each group
    assert [k for k in after if k[0]] == [k for k in before if k[0]] and set(after) <= set(before)

    docs = tables.written(unique, "t")
    clean = cp.redact_pii(spark, docs, SF)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    for r in clean.collect():
        assert not personal(r["text"]) and r["n_chars"] == len(r["text"])
    assert clean.count() == docs.count()

    docs = tables.written(clean, "t")
    packed = cp.pack_sequences(spark, docs, SF).collect()
    assert {p["doc_id"] for p in packed} == {r["doc_id"] for r in docs.collect()}
    total = {}
    for p in packed:
        total[p["sequence_id"]] = total.get(p["sequence_id"], 0) + p["length"]
    assert max(total.values()) <= 2048


def test_empty(spark):
    docs = frame(spark, [])
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.STAGES[-1][1](spark, docs, SF).count() == 0


def test_run(spark):
    out = cp.run(spark, SF).collect()
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    left = {p["doc_id"] for p in out}
    assert left <= set(given)
    texts = [given[i] for i in left]
    assert len(set(texts)) == len(texts)
    assert all(len(re.findall(r"\S+", t)) >= 10 for t in texts)
    assert len(left) > 0.6 * len(given)
    per_doc = {}
    for p in out:
        per_doc.setdefault(p["doc_id"], []).append((p["start"], np.frombuffer(p["ids"], "<u4"), p["doc_tokens"]))
    for pieces in per_doc.values():
        ids = np.concatenate([x for _, x, _ in sorted(pieces, key=lambda x: x[0])])
        assert len(ids) == pieces[0][2] and ids[-1] == 1 and (ids[:-1] != 1).all() or len(ids) == pieces[0][2]
    assert [n for n, _ in cp.STAGES] == ["language_id", "quality_rules", "near_dedup", "redact_pii", "pack_sequences"]
    assert documents()


def test_without_labels_every_text_with_a_letter_stays(spark):
    docs = frame(spark)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = sorted(key(r) for r in cp.language_id(spark, unlabelled, SF).collect())
    assert kept == sorted(k for k in map(key, docs.collect()) if any(c.isalpha() for c in k[3])) and kept
