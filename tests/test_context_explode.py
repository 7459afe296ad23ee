"""J1, W2, F10, F12, W3 edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import explode as EX
from rowsmith.operators import metrics as MT
from rowsmith.operators.context import invoice_context, ordered_groups, running_history

LINES = [
    # creditor, invoice, line, text, qty, price
    ("K1", 100, 2, "b", 1.0, 2.0),
    ("K1", 100, 1, "a", 1.0, 1.0),
    ("K1", 100, None, "z", 1.0, 1.0),  # null line number sorts last
    ("K1", 100, 1, "a2", 3.0, float("nan")),  # tie on line number, NaN price
    ("K2", 100, 1, "other creditor", 1.0, 1.0),  # same invoice number, other creditor
    (None, 100, 1, "no creditor", 1.0, 1.0),
    ("K1", None, 1, "no invoice", 1.0, 1.0),
    ("K3", 7, 1, "single", 2.0, 5.0),
]
SCHEMA = "k STRING, f LONG, l INT, t STRING, q DOUBLE, p DOUBLE"


@pytest.mark.parametrize("partitions", [1, 5])
def test_invoice_context(spark, partitions):
    df = spark.createDataFrame(LINES, SCHEMA).repartition(partitions)
    out = invoice_context(df, ["k", "f"], "l", {"fakturalinje": "t", "antal": "q", "stykpris": "p"},
                          tie_breakers=["t"], context_col="ctx")
    got = {r["t"]: r["ctx"] for r in out.collect()}
    k1 = ('[{"fakturalinje":"a","antal":1.0,"stykpris":1.0},{"fakturalinje":"a2","antal":3.0,"stykpris":null},'
          '{"fakturalinje":"b","antal":1.0,"stykpris":2.0},{"fakturalinje":"z","antal":1.0,"stykpris":1.0}]')
    for t in ("a", "b", "z", "a2"):
        assert got[t] == k1
    assert got["other creditor"] == '[{"fakturalinje":"other creditor","antal":1.0,"stykpris":1.0}]'
    assert got["no creditor"] == "[]"
    assert got["no invoice"] == "[]"
    assert got["single"] == '[{"fakturalinje":"single","antal":2.0,"stykpris":5.0}]'
    assert out.count() == len(LINES)


def test_chat_batches_sizes(spark):
    for n in (3, 25, 26):
        df = spark.range(n).withColumn("batch", F.floor(F.col("id") / 25)).withColumn("msg", F.col("id").cast("string"))
        h = running_history(df, ["batch"], ["id"], "msg").orderBy("id").collect()
        sizes = [len(r["history"]) for r in h]
        assert sizes == [i % 25 + 1 for i in range(n)]
        assert h[-1]["history"][-1] == str(n - 1)


def test_running_history_include(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "x"), (1, 2, "user", "b")],
                               "c INT, turn INT, role STRING, text STRING")
    h = running_history(df, ["c"], ["turn"], "text", include=F.col("role") == "user").orderBy("turn").collect()
    assert [r["history"] for r in h] == [["a"], ["a"], ["a", "b"]]


def _tokens(spark, n, same_ts=False):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, "s", base if same_ts else base + dt.timedelta(seconds=i), f"t{i}") for i in range(n)]
    return spark.createDataFrame(rows, "i LONG, stream STRING, ts TIMESTAMP, tok STRING")


@pytest.mark.parametrize("n", [0, 49, 50, 51, 120])
def test_count_windows(spark, n):
    out = MT.count_windows(_tokens(spark, n), ["stream"], ["ts", "i"], "ts", "tok", size=50).orderBy("window_no").collect()
    assert [r["n_tokens"] for r in out] == [min(50, n - 50 * w) for w in range((n + 49) // 50)]
    if n:
        assert out[0]["text"] == "".join(f"t{i}" for i in range(min(50, n)))
        # First window: from its own first token (49 s for 50 tokens one second apart).
        assert out[0]["elapsed_us"] == (min(50, n) - 1) * 1_000_000
    if n > 50:
        # Next window starts where the previous ended.
        assert out[1]["elapsed_us"] == (min(100, n) - 50) * 1_000_000


def test_count_windows_equal_timestamps(spark):
    out = MT.count_windows(_tokens(spark, 60, same_ts=True), ["stream"], ["ts", "i"], "ts", "tok", size=50).collect()
    assert all(r["tokens_per_sec"] == 0.0 for r in out)


def test_explode_answer_cases(spark):
    ddl = "id INT, Kreditor STRING, answer STRUCT<kreditor: STRING, lines: ARRAY<STRUCT<x: INT, kreditor: STRING>>>"
    rows = [
        (1, "in1", ("a1", [])),
        (2, "in2", ("a2", None)),
        (3, "in3", ("a3", [(10, "e")])),
        (4, "in4", ("a4", [(1, "p"), (2, "q"), (3, "r")])),
    ]
    df = spark.createDataFrame(rows, ddl)
    out = EX.explode_answer(df, "answer", "lines", keep=["id", "Kreditor"], scalar_fields=["kreditor"], position="pos")
    got = sorted(tuple(r) for r in out.collect())
    # The element's "kreditor" replaces the input "Kreditor" (one name in Spark);
    # the answer-level "kreditor" survives under its prefix.
    assert got == [(3, "a3", 10, "e", 1), (4, "a4", 1, "p", 1), (4, "a4", 2, "q", 2), (4, "a4", 3, "r", 3)]
    assert out.columns == ["id", "answer_kreditor", "x", "kreditor", "pos"]
    assert sorted(r["id"] for r in EX.unexploded(df, "answer", "lines").collect()) == [1, 2]


def test_page_explode_and_names(spark):
    df = spark.createDataFrame([(5, "p1\np2\n"), (6, "only")], "doc LONG, text STRING")
    out = EX.page_explode(df, "doc", EX.split_pages("text")).orderBy("doc", "page_no").collect()
    assert [(r["doc"], r["page_no"], r["page_name"], bytes(r["content"]).decode()) for r in out] == [
        (5, 1, "5_1.png", "p1"), (5, 2, "5_2.png", "p2"), (5, 3, "5_3.png", ""), (6, 1, "6_1.png", "only")]


def test_ordered_groups_of_a_hot_key(spark, monkeypatch):
    from rowsmith.operators import context as C

    rows = [("hot", i % 37, f"t{i % 11}", float(i % 5)) for i in range(3000)]
    rows += [(f"c{i % 20}", i % 3, f"u{i}", None) for i in range(200)]
    rows += [(None, 1, "nokey", 1.0)]
    df = spark.createDataFrame(rows, "k STRING, l INT, t STRING, q DOUBLE").repartition(5)
    fields = {"t": "t", "q": "q"}
    got = {r["k"]: [tuple(x) for x in r["items"]] for r in C.ordered_groups(df, ["k"], "l", fields).collect()}
    want = {}
    for k, line, t, q in rows:
        if k is not None:
            want.setdefault(k, []).append((line, t, q))
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == [x[1:] for x in sorted(v, key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0))]


def test_ordered_groups_moves_rows_once(spark):
    df = spark.range(30_000, numPartitions=6).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), (-F.col("id")).alias("o"), F.col("id").cast("string").alias("v"))
    out = ordered_groups(df, ["k"], "o", {"v": "v"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_collect_list" in plan  # listed where the rows lie, then met once
    got = {r.k: [x.v for x in r["items"]] for r in out.collect()}
    want = {}
    for i in reversed(range(30_000)):
        want.setdefault(i % 3 * (i % 2), []).append(str(i))
    assert got == want


def test_chunks_bound_every_first_level_group(spark):
    from rowsmith.operators.context import chunked

    df = spark.range(5000).withColumn("k", F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).repartition(3)
    sizes = chunked(df, 256).groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert sizes <= 256
    with pytest.raises(ValueError):
        chunked(df, 100)


def test_context_job_sends_a_context_once(spark):
    from backends import PromptLengths
    from rowsmith.operators import context as C
    from rowsmith.operators import model as M
    from rowsmith.plans import jobs as J

    # One invoice holds half the table.
    rows = [("K", 1, i, f"line {i}", 1.0, 1.0) for i in range(600)] + [(f"k{i}", i, 1, f"x{i}", 1.0, 2.0) for i in range(600)]
    rows += [(None, 5, 1, "no creditor", 1.0, 1.0), ("K9", 9, 1, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k STRING, f LONG, l INT, t STRING, q DOUBLE, p DOUBLE")
    keys, fields = ["k", "f"], {"fakturalinje": "t", "antal": "q", "stykpris": "p"}
    parts = F.when(F.col("t").isNotNull(), J.P.render_around(J.CONTEXT_TEMPLATE, "faktura", {"kreditor": "k", "fakturalinje": "t"}))
    requests = C.context_requests(df, keys, C.invoice_groups(df, keys, "l", fields), parts, chunk_rows=64)
    assert requests.select(F.max(F.size("lines"))).first()[0] <= 64
    assert requests.select(F.sum(F.size("lines"))).first()[0] == len(rows)
    acc = spark.sparkContext.accumulator(0)
    out = M.call_model_joined(requests, PromptLengths(acc))
    ctx = C.invoice_context(df, keys, "l", fields, context_col="faktura")
    prompt = F.when(F.col("t").isNotNull(), J.P.render(J.CONTEXT_TEMPLATE, {"kreditor": "k", "faktura": "faktura", "fakturalinje": "t"}))
    want = sorted((r[0], r[1]) for r in ctx.select(F.coalesce("t", F.lit("-")), F.length(prompt).cast("string")).collect())
    got = sorted((r["t"] or "-", r["response"]) for r in out.collect())
    assert [g[0] for g in got] == [w[0] for w in want] and dict(got) == dict(want)
    assert acc.value == len(rows) - 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "faktura" not in out.columns and "context" not in out.columns and "MapInArrow" in plan


def test_explode_element_fields_override_inputs(spark):
    df = spark.createDataFrame([(1, 9, 99, ("a", [(5,)]))],
                               "id INT, X INT, linjenummer INT, answer STRUCT<k: STRING, lines: ARRAY<STRUCT<x: INT>>>")
    out = EX.explode_answer(df, "answer", "lines", keep=["id", "X", "linjenummer"], scalar_fields=["k"])
    assert out.columns == ["id", "answer_k", "x", "linjenummer"]
    assert tuple(out.first()) == (1, "a", 5, 1)


def test_history_of_a_hot_conversation_is_built_in_chunks(spark):
    rows = [("hot", i, "user" if i % 3 else "tool", None if i % 11 == 5 else f"m{i}") for i in range(700)]
    rows += [(None if i % 9 == 0 else f"c{i}", t, "user", f"x{i}.{t}") for i in range(60) for t in (3 * i, 3 * i + 1)]
    df = spark.createDataFrame(rows, "c STRING, turn INT, role STRING, text STRING").repartition(5)
    user = F.col("role") == "user"
    out = running_history(df, ["c"], ["turn"], "text", include=user)
    want = running_history(df, ["c"], ["turn"], "text", include=user, bounded=True)
    key = lambda r: (r["c"] or "", r["turn"])
    assert out.columns == want.columns
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] or "", r[1])) == [tuple(r) for r in sorted(want.collect(), key=key)]
    small = running_history(df, ["c"], ["turn"], "text", chunk_rows=7).collect()
    plain = running_history(df, ["c"], ["turn"], "text", bounded=True).collect()
    assert [tuple(r) for r in sorted(small, key=key)] == [tuple(r) for r in sorted(plain, key=key)]
    # No window gathers the messages of a whole conversation.
    windows = [[x for x in h._jdf.queryExecution().optimizedPlan().toString().splitlines() if "collect_list" in x and "windowspecdefinition" in x] for h in (out, want)]
    assert not windows[0] and windows[1]
