"""M1-M7 model stage and W1/P10 ordering."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from backends import NullAnswers, RaiseOn, WrongLength
from rowsmith.operators import model as M
from rowsmith.operators import standins as B
from rowsmith.operators.ordering import every_nth, row_index


def _prompts(spark, items):
    return spark.createDataFrame([(i, p) for i, p in enumerate(items)], "id INT, prompt STRING")


def test_error_isolated_per_row(spark):
    items = ["a", "bad1", "c", None, "d", "bad2"] + [f"x{i}" for i in range(50)]
    out = {r["id"]: r for r in M.call_model(_prompts(spark, items), RaiseOn(), slots=None).collect()}
    assert out[0]["response"] == "ok:a" and out[0]["error"] is None
    assert out[1]["response"] is None and "boom" in out[1]["error"]
    assert out[5]["response"] is None and "boom" in out[5]["error"]
    assert out[3]["response"] is None and out[3]["error"] is None  # null prompt: never sent
    assert all(out[i]["response"] == f"ok:{items[i]}" for i in range(6, len(items)))
    assert "prompt" not in M.call_model(_prompts(spark, items), RaiseOn()).columns


def test_wrong_length_and_null_answers(spark):
    out = M.call_model(_prompts(spark, ["a", "b"]), WrongLength()).collect()
    assert all(r["response"] is None and "answers for" in r["error"] for r in out)
    out = M.call_model(_prompts(spark, ["a"]), NullAnswers()).collect()
    assert out[0]["response"] is None and out[0]["error"] is None


def test_output_clash_rejected(spark):
    df = _prompts(spark, ["a"]).withColumn("error", F.lit("x"))
    with pytest.raises(ValueError):
        M.call_model(df, RaiseOn())


def test_worker_singleton():
    spec = B.KeywordBackend()
    assert M.worker_backend(spec) is M.worker_backend(B.KeywordBackend())


def test_slots(spark):
    df = _prompts(spark, ["a"] * 10).coalesce(1)
    assert M.call_model(df, B.EchoBackend(), slots=4).rdd.getNumPartitions() == 4
    assert M.call_model(df, B.EchoBackend(), slots=None).rdd.getNumPartitions() == 1


def test_keyword_backend_rules():
    be = B.KeywordBackend()
    out = be.respond(pd.DataFrame({"prompt": ["a Rod and bolt", "GEAR", "nothing"]}))
    assert out["response"].tolist()[0].startswith('{"label": "materialeindkøb", "reason": "rule bolt"')
    assert '"label": "tjenesteydelse"' in out["response"].tolist()[1]
    assert '"label": "ved ikke"' in out["response"].tolist()[2]


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_index_matches_window(spark, partitions):
    rows = [(i, "hot" if i % 3 else ("g%d" % (i % 7)), (i * 37) % 101) for i in range(600)]
    rows += [(1000 + i, None, i) for i in range(5)]  # null group
    df = spark.createDataFrame(rows, "id INT, g STRING, k INT").repartition(partitions)
    got = row_index(df, ["k", "id"], ["g"]).select("id", "row_id")
    w = Window.partitionBy("g").orderBy("k", "id")
    want = df.select("id", (F.row_number().over(w) - 1).alias("row_id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    glob = row_index(df, ["id"]).select("id", "row_id").collect()
    assert sorted(r["row_id"] for r in glob) == list(range(len(rows)))


def test_row_index_without_a_shuffle_partition_setting(spark):
    own = spark.newSession()
    own.conf.unset("spark.sql.shuffle.partitions")  # as on a cluster that never set it
    df = own.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert row_index(df, ["k"]).filter("row_id <> k").count() == 0


def test_every_nth(spark):
    df = row_index(spark.range(100).withColumnRenamed("id", "k"), ["k"])
    assert [r["k"] for r in every_nth(df, "row_id", 25).orderBy("k").collect()] == [24, 49, 74, 99]
    with pytest.raises(ValueError):
        every_nth(df, "row_id", 0)


def test_model_params_cut_answers(spark):
    from rowsmith.config import ModelParams
    from rowsmith.functions import answers as A

    be = B.KeywordBackend(fields=("label", "secure"), params=ModelParams(max_tokens=2))
    df = _prompts(spark, ["a bolt", "nothing"])
    out = A.with_parsed_answer(M.call_model(df, be), "response", A.PURCHASE_SMALL).orderBy("id").collect()
    assert [r["stop_reason"] for r in out] == ["maxPredictedTokensReached"] * 2
    assert [r["answer"]["status"] for r in out] == ["invalid", "invalid"]  # cut JSON
    full = M.call_model(df, B.KeywordBackend(fields=("label", "secure"), params=ModelParams(max_tokens=200))).collect()
    assert all(r["stop_reason"] == "eosFound" for r in full)


def test_stats_message(spark):
    from rowsmith.operators.metrics import stats_message

    df = spark.createDataFrame([(0, 12.345, 7, "eosFound")], "i INT, tps DOUBLE, n INT, stop STRING")
    msg = df.select(stats_message(F.col("i") + 1, "tps", "n", "stop")).first()[0]
    assert msg == "[Row 1] Tokens/sec: 12.35 | Total tokens: 7 | Stop reason: eosFound"


def test_checkpointed_stage_calls_once(spark):
    from backends import Counting

    acc = spark.sparkContext.accumulator(0)
    out = M.call_model(_prompts(spark, [f"p{i}" for i in range(50)]), Counting(acc), checkpoint=True)
    assert acc.value == 50  # eager: ran once here
    assert out.count() == 50 and out.filter("response IS NULL").count() == 0
    assert acc.value == 50  # reading the checkpoint calls nothing again


def test_dedupe_calls_once_per_distinct_prompt(spark):
    from backends import Counting

    acc = spark.sparkContext.accumulator(0)
    items = [f"p{i % 7}" for i in range(100)] + [None, None]
    df = _prompts(spark, items)
    out = M.call_model(df, Counting(acc), dedupe=True)
    got = {r["id"]: r["response"] for r in out.collect()}
    assert acc.value == 7
    assert len(got) == 102 and got[100] is None and all(got[i] == items[i] for i in range(100))
    assert "prompt" not in out.columns


def test_dedupe_matches_null_request_columns(spark):
    from backends import EchoPair

    rows = [(1, "p", "x"), (2, "p", None), (3, "p", None), (4, "q", "x")]
    df = spark.createDataFrame(rows, "id INT, prompt STRING, extra STRING")
    plain = M.call_model(df, EchoPair(), request_cols=["extra"]).select("id", "response")
    once = M.call_model(df, EchoPair(), request_cols=["extra"], dedupe=True).select("id", "response")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, plain.collect()))
    assert once.filter("response IS NULL").count() == 0


def test_request_rows_bounds_calls(spark):
    from backends import MaxBatch

    out = M.call_model(_prompts(spark, [f"p{i}" for i in range(40)]).coalesce(1), MaxBatch(7), request_rows=7,
                       slots=None)
    assert out.filter("error IS NOT NULL").count() == 0 and out.count() == 40
    bad = M.call_model(_prompts(spark, [f"p{i}" for i in range(40)]).coalesce(1), MaxBatch(7), slots=None)
    # Without the cap the slice is too big; asked one by one, every row is answered.
    assert bad.filter("error IS NOT NULL").count() == 0


@pytest.mark.parametrize("every", [100, 2])
def test_failures_cost_at_most_two_calls_a_row(spark, every):
    from backends import CountingFaulty

    acc = spark.sparkContext.accumulator(0)
    n = 1000
    df = _prompts(spark, [f"#{i}" for i in range(n)])
    out = M.call_model(df, CountingFaulty(acc, every))
    failed = {r["id"] for r in out.filter("error IS NOT NULL").collect()}
    assert failed == {i for i in range(n) if i % every == 0}
    assert acc.value <= 2 * n


def test_backend_errors_cost_one_call_a_row(spark):
    df = _prompts(spark, [f"#{i} a bolt" for i in range(1, 300)])
    out = M.call_model(df, B.FaultyBackend(raise_every=10)).collect()
    assert {r["id"] + 1 for r in out if r["error"]} == set(range(10, 300, 10))
    raised = M.call_model(df, B.FaultyBackend(raise_every=10, raises=True)).select("id", "response")
    assert sorted((r["id"], r["response"]) for r in out) == sorted(map(tuple, raised.collect()))


def test_classify_simple_null_policies(spark):
    from rowsmith.plans import jobs as J

    df = spark.createDataFrame([(1, "a bolt"), (2, None)], "id LONG, text STRING")
    skip = {r["id"]: r for r in J.classify_simple(df, "text", "id", B.KeywordBackend()).collect()}
    assert skip[1]["klassificering"] == "Materialeindkøb" and skip[1]["error"] is None
    assert skip[2]["klassificering"] is None and skip[2]["status"] == "missing" and skip[2]["error"] is None
    sent = {r["id"]: r for r in J.classify_simple(df, "text", "id", B.KeywordBackend(), on_null="text").collect()}
    assert sent[2]["status"] == "ok" and sent[2]["klassificering"] == "Ukendt"  # "nan" was sent and answered


def test_response_log(spark):
    from rowsmith.operators.metrics import response_log

    df = spark.createDataFrame([(i, 10, 2.0, "eosFound") for i in range(10)] + [(10, None, None, None)],
                               "row_id LONG, n_tokens INT, seconds DOUBLE, stop_reason STRING")
    all_rows = response_log(df, "row_id").orderBy("row_id").collect()
    assert len(all_rows) == 10 and all_rows[0]["message"] == "[Row 1] Tokens/sec: 5.00 | Total tokens: 10 | Stop reason: eosFound"
    every = [r["row_id"] for r in response_log(df, "row_id", every=5).orderBy("row_id").collect()]
    assert every == [4, 9]
