"""Requests bounded by bytes and dealt by cost."""

import time

import numpy as np
import pyarrow as pa
import pytest
from backends import WorkerMemory
from pyspark.sql import functions as F

from rowsmith.operators import model as M
from rowsmith.operators.context import context_requests, invoice_groups
from rowsmith.functions import prompts as P


def test_cut():
    assert list(M.cut(np.array([5, 5, 50, 1, 1, 1]), 2, 10)) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    assert list(M.cut(np.zeros(0, int), 2, 10)) == []
    assert list(M.cut(np.array([0, 0, 0]), 2, 0)) == [(0, 2), (2, 3)]


def test_request_bytes():
    assert M.request_bytes(pa.array(["ab", None, "é"])).tolist() == [2, 0, 2]
    pages = pa.array([[b"123", None, b"4"], None, [], [b"55"]], pa.list_(pa.binary()))
    assert M.request_bytes(pages).tolist() == [4, 0, 0, 2]
    assert M.request_bytes(pages.slice(2)).tolist() == [0, 2]


def test_a_huge_invoice_is_sent_within_bounds(spark):
    n = 50_000
    lines = spark.range(n).select(F.lit("c").alias("c"), F.lit(1).alias("inv"), F.col("id").alias("no"), F.concat(F.lit("l"), F.col("id")).alias("t")).repartition(4)
    groups = invoice_groups(lines, ["c", "inv"], "no", {"t": "t"})
    parts = P.render_around("{all}\n{t}", "all", {"t": "t"})
    requests = context_requests(lines, ["c", "inv"], groups, parts, chunk_rows=1 << 13)
    answered = M.call_model_joined(requests.repartition(8), WorkerMemory())
    seen = answered.select("no", "error", F.split("response", " ").alias("r")).select("no", "error", *[F.col("r")[k].cast("long").alias(x) for k, x in enumerate(("chars", "rows", "peak"))])
    got = seen.agg(F.count("*").alias("n"), F.count("error").alias("errors"), F.count_distinct("no").alias("different"), F.min("chars").alias("chars"), F.max("rows").alias("rows"), F.max("peak").alias("peak")).first()
    assert (got.n, got.errors, got.different) == (n, 0, n)
    assert got.chars > 700_000 and got.rows <= M.REQUEST_BYTES // 700_000 and got.peak < 1000


@pytest.mark.parametrize("slots", [1, 5, 8])
def test_one_document_with_a_third_of_the_bytes(spark, slots):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 400, 3000)
    sizes[777] = sizes.sum() // 2  # a third of all
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "i INT, size LONG").repartition(6, "i").checkpoint()
    dealt = M.deal_by_cost(df, F.col("size"), slots)
    assert dealt.rdd.getNumPartitions() == slots and dealt.columns == ["i", "size"]
    parts = dealt.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("size").alias("m")).collect()
    assert sum(r.n for r in parts) == 3000 and sum(r.s for r in parts) == sizes.sum()
    share = sizes.sum() / slots
    for r in parts:
        assert r.s <= max(share, r.m) + 2 * 400  # a share, or one document of more
    others = sorted(r.s for r in parts if r.m < sizes.max())
    if others:
        assert others[-1] <= 2 * np.median(others)


def test_deal_nothing_and_no_costs(spark):
    empty = spark.createDataFrame([], "i INT, size LONG")
    assert M.deal_by_cost(empty, F.col("size"), 4).count() == 0
    free = spark.createDataFrame([(i, None if i % 2 else -5) for i in range(50)], "i INT, size LONG")
    assert sorted(r.i for r in M.deal_by_cost(free, F.col("size"), 4).collect()) == list(range(50))


def test_clashing_names(spark):
    df = spark.createDataFrame([(i, i, i) for i in range(20)], "size LONG, slot LONG, part LONG")
    assert M.deal_by_cost(df, F.col("size"), 3).agg(F.sum("slot")).first()[0] == 190


def _invoices(spark):
    rows = [("K", 1, i, f"bolt {i}", 1.0, 1.0) for i in range(300)] + [(f"k{i % 40}", i % 40, i, f"rod {i}", 2.0, float(i)) for i in range(200)]
    rows += [(None, 5, 1, "gear", 1.0, 1.0), ("K9", None, 1, "ring", 1.0, 1.0), ("K8", 8, 1, None, 1.0, 1.0)]
    return spark.createDataFrame(rows, "k STRING, f LONG, l INT, t STRING, q DOUBLE, p DOUBLE")


def test_context_lines_are_shuffled_once(spark):
    from rowsmith.operators.standins import KeywordBackend
    from rowsmith.plans import jobs as J

    out = J.classify_with_context(_invoices(spark), "k", "f", "l", "t", "q", "p", KeywordBackend())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k") == 1 and "RoundRobin" not in plan


@pytest.mark.parametrize("of_all", [False, True])
def test_context_of_large_and_usual_invoices(spark, of_all):
    from rowsmith.operators.standins import KeywordBackend
    from rowsmith.plans import jobs as J

    every = _invoices(spark)
    lines = every.filter("l % 3 > 0 or f is null or k is null or k = 'K'") if of_all else every
    job = lambda **more: sorted(map(str, J.classify_with_context(lines, "k", "f", "l", "t", "q", "p", KeywordBackend(), invoices=every if of_all else None, **more).collect()))
    assert job(chunk_rows=64) == job() == job(slots=None) and len(job()) == lines.count()


def test_written_gives_back_its_shuffles(spark):
    from rowsmith.session import written

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))

    before = shuffled()
    got = written(spark.range(100_000).groupBy((F.col("id") % 1009).alias("k")).count(), "freed")
    assert got.count() == 1009
    for _ in range(50):  # files go in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert spark.conf.get("spark.sql.shuffleDependency.fileCleanup.enabled") == "false"
