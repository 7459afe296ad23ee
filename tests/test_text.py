"""F3-F6 edge cases and property tests against a plain-Python model of the
semantics (Python's re / str.split, as the reference uses them)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsmith.functions import text as X

LABELS = ["materialeindkøb", "tjenesteydelse"]


# -- the reference semantics, restated in Python -------------------------------
def py_clean(w):
    return re.sub(r"[^\w]", "", w).lower()


def py_strip(t):
    return re.sub(r"<think>.*?</think>", "", t, flags=re.DOTALL)


def py_counts(t):
    total = len(t.split())
    return total - len(py_strip(t).split()), total


def py_label(t, labels, remove_thinking=True):
    if remove_thinking:
        t = py_strip(t)
    if not labels:
        return None
    cl = [py_clean(x) for x in labels]
    for w in t.split():
        cw = py_clean(w)
        for lab, c in zip(labels, cl):
            if cw == c:
                return lab
    return None


def _one(spark, texts, *cols):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_clean_word_cases(spark):
    words = ["**Materialeindkøb**", "æøåÆØÅ", "_", "a1b2", "!!!", "ét", "Tjeneste-ydelse."]
    got = _one(spark, words, X.clean_word("t"))
    assert [g[0] for g in got] == [py_clean(w) for w in words]
    assert got[0][0] == "materialeindkøb"


def test_thinking_cases(spark):
    texts = [
        "no tags here",
        "<think>a b</think> c <think>d</think> e",
        "<think>\nmany\nlines\n</think>\nsvar",
        "<think>unclosed a b c",
        "<think>outer <think>inner</think> tail</think> end",
        "glued<think>x y</think>words",
        "<think></think>",
        "nbsp split and\x1cfs",
    ]
    got = _one(spark, texts, X.strip_thinking("t"), X.thinking_word_count("t"), X.word_count("t"))
    for t, (stripped, thinking, total) in zip(texts, got):
        assert stripped == py_strip(t)
        assert (thinking, total) == py_counts(t)


def test_label_cases(spark):
    texts = [
        "Svaret er tjenesteydelse, ikke materialeindkøb",
        "<think> materialeindkøb </think> nothing here",
        "**MATERIALEINDKØB**",
        "no label at all",
        "",
    ]
    got = _one(spark, texts, X.extract_label("t", LABELS), X.extract_label("t", LABELS, remove_thinking=False))
    for t, (a, b) in zip(texts, got):
        assert a == py_label(t, LABELS)
        assert b == py_label(t, LABELS, remove_thinking=False)
    assert got[0][0] == "tjenesteydelse"
    assert got[1] == (None, "materialeindkøb")


def test_label_null_and_no_labels(spark):
    df = spark.createDataFrame([(None,), ("materialeindkøb",)], "t STRING")
    r = df.select(X.extract_label("t", LABELS).alias("a"), X.extract_label("t", []).alias("b")).collect()
    assert r[0]["a"] is None and r[1]["a"] == "materialeindkøb"
    assert r[0]["b"] is None and r[1]["b"] is None


def test_label_that_cleans_to_nothing(spark):
    got = _one(spark, ["a ** b", "a b"], X.extract_label("t", ["**", "b"]))
    assert [g[0] for g in got] == [py_label("a ** b", ["**", "b"]), py_label("a b", ["**", "b"])]


ALPHABET = st.sampled_from(list("abæøåÆ xy_1.*<>/\n\t \x1c-") + ["<think>", "</think>", "Tjenesteydelse", "materialeindkøb"])
TEXTS = st.lists(ALPHABET, max_size=25).map("".join)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXTS, min_size=1, max_size=20))
def test_properties_match_python(spark, texts):
    got = _one(
        spark, texts, X.strip_thinking("t"), X.thinking_word_count("t"), X.word_count("t"),
        X.extract_label("t", LABELS), X.extract_label("t", LABELS, remove_thinking=False),
    )
    for t, (stripped, thinking, total, lab, lab_raw) in zip(texts, got):
        assert stripped == py_strip(t)
        assert (thinking, total) == py_counts(t)
        assert lab == py_label(t, LABELS)
        assert lab_raw == py_label(t, LABELS, remove_thinking=False)
