"""Plan-shape checks: pruning, pushdown, partial top-k, no single-task windows."""

import re

import pytest

import __spark_entry__ as E
from rowsmith.plans import catalogue

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_model_stage_reads_only_needed_columns(spark):
    plan = _plan(spark, "classify_structured")
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert "MapInArrow" in plan


def test_search_keeps_partial_top_k_before_shuffle(spark):
    plan = _plan(spark, "search_first_k")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def unpartitioned_windows(plan: str) -> list[str]:
    """Window nodes without partition keys: their second bracket, the order, closes the node."""
    return [m.group(0) for m in re.finditer(r"(?<!RunningWindowFunction )\bWindow \[.*?\](?:, \[[^\n]*?\])*", plan) if m.group(0).count("], [") < 2]


def test_unpartitioned_window_is_found(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("k", F.col("id") % 2)
    alone = df.withColumn("n", F.row_number().over(Window.orderBy("id")))
    keyed = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert unpartitioned_windows(plan(alone)) and not unpartitioned_windows(plan(keyed))


# One row per partition goes through these: the offsets of row_index over a whole table.
OFFSETS_ONLY = "_rs_pid"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_cartesian_or_unpartitioned_window(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for w in unpartitioned_windows(plan):
        assert OFFSETS_ONLY in w, f"window without partition keys in {name}: {w}"


def test_date_filter_reaches_the_scan(spark):
    from rowsmith.sources.readers import spread

    orders = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderdate < '1995-01-01'").select("o_orderkey")
    plan = spread(orders, 4)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in plan


def test_filter_pushed_to_scan(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderdate < '1995-01-01'").select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
