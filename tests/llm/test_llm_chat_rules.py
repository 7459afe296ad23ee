"""Operators 7 and 8 against plain Python and their SQL; no Python in their plans."""

import hashlib
import re

import duckdb
import pytest
from llm_cases import documents, frame

from rowsmith.llm import chat_format as cf
from rowsmith.llm import host_rules as hr
from rowsmith.llm.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"

TURNS = [
    (1, 0, "system", "be kind"), (1, 2, "user", "a"), (1, 1, "user", "b <|im_end|> <\\|x <\\\\| <||"), (1, 3, "assistant", "c<"), (1, 4, "assistant", "|im_start|>d"),
    (2, 0, "assistant", None), (2, 0, "assistant", ""), (3, None, None, "who"), (3, 1, "two words\nand a line", "text\nlines\n"), (None, 1, "user", "no conversation"),
    (4, 1, "user", "tie b"), (4, 1, "user", "tie a"), (4, 1, "assistant", "tie"), (5, 1, "user", "x" * 20_000), (4, 1, "user", "tie b"),
    (6, 1, "user", "<|im_sep|>"), (6, 2, "user", "<|im_sep|>"),
]


def turns(spark):
    rows = [(*t, "clash", True) for t in TURNS]
    return spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING, segments STRING, loss BOOLEAN").repartition(3)


def test_chats_read_back(spark):
    got = {r["conv_id"]: r for r in cf.read_chats(cf.format_chats(turns(spark))).collect()}
    want = {}
    for c, t, role, text in TURNS:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(want)
    for c, rows in want.items():
        rows = sorted(rows)
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [(r, x) for _, _, r, x in rows]
        assert got[c]["learned"] == "".join(x for _, _, r, x in rows if r == "assistant")
        # Markers stand only where the template puts them.
        blocks = sum(1 for i, r in enumerate(rows) if i == 0 or rows[i - 1][2] != r[2])
        assert got[c]["formatted"].count(cf.START) == got[c]["formatted"].count(cf.END) == blocks
        assert got[c]["formatted"].count(cf.SEP) == len(rows) - blocks
    assert cf.format_chats(turns(spark).limit(0)).count() == 0


def test_forged_markers_stay_text(spark):
    row = QUERIES["op7_chat_format"](spark, SF).where("conv_id = -1").first()
    lines = "".join(f"{r}\n{cf.FORGED}\n" for r in ("user", "assistant"))
    assert row["n_turns"] == 2 and row["turns_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(cf.FORGED.encode()).hexdigest() and row["loss_chars"] == len(cf.FORGED)


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(set(windows)) < len(windows) else set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


EXTRA = ["a b c d e a b c d e", "a b c d e f a b c d e", "x " * 9, "a # * $ % & | < >", "one\none\n \n\none\ntwo", "a b c d e f g h i j k l m n o p"]


def test_counts(spark):
    rows = documents() + [(5000 + i, t, None, "s", 1, *[None] * 10) for i, t in enumerate(EXTRA)]
    out = hr.judged(frame(spark, rows)).collect()
    got = sorted((r["row"]["doc_id"] is None, r["row"]["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in out)
    want = []
    for i, t, *_ in rows:
        c = counts(t)
        want.append((i is None, i or 0, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert got == sorted(want)
    assert all(not r["kept"] for r in out if r["base_failed"])
    assert hr.judged(frame(spark, [])).count() == 0


def test_hosts_are_shrunk_and_judged(spark):
    clean = " ".join(f"w{i}" for i in range(40))
    noisy = " ".join(f"w{i}#" for i in range(40))  # fails the strict rules alone
    rows = [(i, noisy if i % 10 else clean, "bad") for i in range(300)]
    rows += [(1000 + i, clean if i % 10 else noisy, "good") for i in range(300)]
    rows += [(2000, noisy, "tiny"), (2001, clean, None), (2002, noisy, None)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING").repartition(3)
    verdicts = {r["host"]: r for r in hr.host_verdicts(hr.with_counts(df)).collect()}
    assert verdicts["bad"]["bad"] and not verdicts["good"]["bad"]
    assert 0.5 < verdicts["tiny"]["rate"] < 1  # one failure of one is shrunk towards the mean
    kept = {r["row"]["doc_id"] for r in hr.judged(df).where("kept").collect()}
    assert {i for i, t, s in rows if t == clean} <= kept  # a clean document stays, whatever its host
    assert {i for i, t, s in rows if s == "bad" and t == noisy}.isdisjoint(kept)
    assert {i for i, t, s in rows if s == "good"} <= kept


@pytest.mark.parametrize("name", ["op7_chat_format", "op8_host_rules", "op4_vptree"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    norm = lambda v: round(float(v), 9) if isinstance(v, float) else v
    rows = sorted([tuple(norm(r[c]) for c in columns) for r in got.collect()], key=repr)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert rows == sorted([tuple(norm(v) for v in r) for r in want], key=repr)


@pytest.mark.parametrize("name", ["op7_chat_format", "op8_host_rules"])
def test_no_python_in_native_plans(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)


def test_a_bad_host_loses_what_fails_the_strict_rules(spark):
    good = " ".join(f"word{i}" for i in range(40))
    noisy = good + " " + "#$%&" * 30  # fails the strict rules alone
    rows = [(1000 * h + i, f"{good} {h} {i}", f"host{h}") for h in range(10) for i in range(100)]
    rows += [(20_000 + i, f"{noisy} {i}", "host3") for i in range(60)] + [(30_000 + h, f"{noisy} {h} again", f"host{h}") for h in range(10) if h != 3]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    bad = {r.host for r in hr.host_verdicts(hr.with_counts(docs)).where("bad").collect()}
    assert bad == {"host3"}
    kept = {r.doc_id: r.kept for r in hr.judged(docs).select("row.doc_id", "kept").collect()}
    assert [d for d, k in kept.items() if not k] == list(range(20_000, 20_060))  # noisy ones elsewhere stay, and so does what is clean on the host


def test_one_failure_makes_no_small_host_bad(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{good} {i}" if i % 7 else "few words", f"host{i % 20}") for i in range(2000)] + [(9999, "few words", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    assert hr.host_verdicts(hr.with_counts(docs)).where("bad").count() == 0
