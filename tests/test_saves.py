"""Saved tables: schema growth, commits, progress, crashes."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.streaming import resume as RS
from rowsmith.streaming.saves import SavedTable, SchemaClash, merged, widened


def _ddl(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize(
    "a,b,wanted",
    [
        ("INT", "BIGINT", "bigint"), ("TINYINT", "SMALLINT", "smallint"), ("INT", "DOUBLE", "double"), ("FLOAT", "DOUBLE", "double"),
        ("DECIMAL(5,2)", "DECIMAL(8,1)", "decimal(9,2)"), ("VOID", "STRING", "string"), ("ARRAY<INT>", "ARRAY<BIGINT>", "array<bigint>"),
        ("STRUCT<x: INT>", "STRUCT<X: BIGINT, y: STRING>", "struct<x:bigint,y:string>"), ("MAP<STRING, INT>", "MAP<STRING, BIGINT>", "map<string,bigint>"),
    ],
)
def test_types_are_widened(spark, a, b, wanted):
    for x, y in ((a, b), (b, a)):
        got = widened(_ddl(f"c {x}")["c"].dataType, _ddl(f"c {y}")["c"].dataType, "c").simpleString()
        assert got.lower() == wanted


@pytest.mark.parametrize("a,b", [("BIGINT", "DOUBLE"), ("STRING", "INT"), ("DATE", "TIMESTAMP"), ("DECIMAL(38,0)", "DECIMAL(5,5)"), ("ARRAY<INT>", "INT")])
def test_types_that_clash_are_refused_by_name(spark, a, b):
    with pytest.raises(SchemaClash, match="column s.amount"):
        merged([_ddl(f"s STRUCT<amount: {a}>"), _ddl(f"s STRUCT<Amount: {b}>")])


def test_columns_of_all_runs_come_back(spark, tmp_dir):
    data = spark.range(30).select(F.col("id").alias("k"))
    path = os.path.join(tmp_dir, "t")
    one = lambda d: d.select("k", F.col("k").cast("int").alias("n"), F.lit("old").alias("old"), F.array(F.struct(F.lit(1).alias("x"))).alias("l"))
    two = lambda d: d.select("k", (F.col("k") * 10**10).alias("N"), F.lit(2.5).alias("new"), F.array(F.struct(F.lit("y").alias("y"))).alias("l"))
    RS.run_resumable(spark, data.where("k < 10"), ["k"], one, path, save_every=5)
    out = RS.run_resumable(spark, data, ["k"], two, path, save_every=7)
    assert out.columns == ["k", "N", "new", "l", "old"]
    rows = {r.k: r for r in out.collect()}
    assert len(rows) == 30 and rows[3].N == 3 and rows[3].old == "old" and rows[3].new is None and rows[3].l[0].asDict() == {"x": 1, "y": None}
    assert rows[20].N == 20 * 10**10 and rows[20].old is None and rows[20].l[0].asDict() == {"x": None, "y": "y"}
    # A third run that would write text where numbers are is refused, and nothing is done.
    calls = []

    def text(d):
        calls.append(1)
        return d.select("k", F.lit("text").alias("n"))

    with pytest.raises(SchemaClash, match="column n: "):
        RS.run_resumable(spark, spark.range(40).withColumnRenamed("id", "k"), ["k"], text, path)
    assert RS.read_done(spark, path).count() == 30 and len(calls) == 1  # for its schema alone


def test_a_folder_without_an_entry_is_no_save(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    table = SavedTable(spark, path)
    run = table.start()
    spark.range(5).write.parquet(f"{path}/save-{run}-000000")  # the run died before its entry
    assert table.read(_ddl("id LONG")).count() == 0 and RS.read_done(spark, path) is None
    table.save(spark.range(3), run, 0)
    table.save(spark.range(3), run, 0)  # a replay replaces
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2] and len(table.saves()) == 1


def test_progress_counts_rows_and_errors(spark, tmp_dir):
    data = spark.range(95).select(F.col("id").alias("k"))
    process = lambda d: d.select("k", F.when(F.col("k") % 10 == 0, "bad").alias("error"))
    path = os.path.join(tmp_dir, "t")
    seen = []

    def report(rows_done):  # while the run goes on
        seen.append([tuple(r) for r in SavedTable(spark, path).progress().collect()])

    RS.run_resumable(spark, data, ["k"], process, path, save_every=40, report=report)
    whole = [(40, 4, "Row: 40"), (80, 8, "Row: 80"), (95, 10, "Row: 95")]
    assert seen == [whole[:1], whole[:2], whole]
    every = SavedTable(spark, path).progress(every=30).orderBy("rows_done").collect()
    assert [tuple(r) for r in every] == [(30, 4, "Row: 30"), (60, 8, "Row: 60"), (90, 10, "Row: 90")]


def test_progress_does_not_depend_on_the_commits(spark, tmp_dir):
    """More steps than commits: each step has its own rows and errors, also where keys repeat or are null."""
    keys = [None] * 3 + [5] * 6 + list(range(10, 196))
    data = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k INT, i INT")
    bad = F.col("k").isNull() | (F.col("k") % 5 == 0)
    path = os.path.join(tmp_dir, "t")
    reported = []
    RS.run_resumable(spark, data, ["k"], lambda d: d.select("k", "i", F.when(bad, "bad").alias("error")), path, save_every=4, report=reported.append)
    assert len(SavedTable(spark, path).saves()) <= RS.MAX_COMMITS
    errors = [sum(k is None or k % 5 == 0 for k in keys[:n]) for n in range(len(keys) + 1)]
    ends = [*range(4, 195, 4), 195]
    got = sorted(tuple(r) for r in SavedTable(spark, path).progress().collect())
    assert got == [(n, errors[n], f"Row: {n}") for n in ends] and reported == ends
    every = sorted(tuple(r)[:2] for r in SavedTable(spark, path).progress(every=10).collect())
    assert every == [(n, errors[min(-(-n // 4) * 4, 195)]) for n in range(10, 196, 10)]


def _jobs(spark):
    """Number of the last job so far."""
    sc = spark.sparkContext
    sc.setJobGroup("probe", "probe")
    spark.range(1).collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return max(sc.statusTracker().getJobIdsForGroup("probe"))


def test_a_million_rows_at_the_default(spark, tmp_dir):
    n = 1_000_000
    data = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    dying = lambda d: d.select("k", F.when(F.col("k") == 700_000, F.raise_error(F.lit("dead"))).otherwise(F.col("v") * 2).alias("v2"))
    path = os.path.join(tmp_dir, "t")
    before = _jobs(spark)
    with pytest.raises(Exception, match="dead"):
        RS.run_resumable(spark, data, ["k"], dying, path, save_every=100)
    assert _jobs(spark) - before < 100
    kept = RS.read_done(spark, path).agg(F.max("k"), F.count("*")).first()
    assert 600_000 < kept[1] <= 700_000 and kept[0] == kept[1] - 1  # all commits before the one that died, in key order
    before = _jobs(spark)
    out = RS.run_resumable(spark, data, ["k"], lambda d: d.select("k", (F.col("v") * 2).alias("v2")), path, save_every=100)
    assert _jobs(spark) - before < 100
    got = out.agg(F.count("*"), F.count_distinct("k"), F.sum("v2")).first()
    assert got[0] == got[1] == n and got[2] == 2 * sum(i % 7 for i in range(n))


def test_one_key_with_a_third_of_the_rows_and_null_keys(spark, tmp_dir):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(90)] + [(None, 90), (None, 91)]
    data = spark.createDataFrame(rows, "k INT, i INT")
    out = RS.run_resumable(spark, data, ["k"], lambda d: d.select("k", "i"), os.path.join(tmp_dir, "t"), save_every=4)
    assert sorted(r.i for r in out.collect()) == list(range(92))


def test_files_are_ordered_by_part_and_number(spark, tmp_dir):
    """Also where a piece of the write's id looks like a file's number."""
    names = [f"part-{p:05d}-0a1b2c3d-c123-4e5f-8a9b-0123456789ab-c{c:03d}.snappy.parquet" for p in range(3) for c in range(20)]
    for name in reversed(names):
        open(os.path.join(tmp_dir, name), "w").close()
    RS._order_by_name(spark, tmp_dir)
    assert sorted(names, key=lambda n: os.stat(os.path.join(tmp_dir, n)).st_mtime) == names


def test_the_work_list_moves_rows_twice_and_keeps_no_checkpoint(spark, tmp_dir):
    from rowsmith.operators.ordering import row_index

    data = spark.range(1000, numPartitions=4).select((F.col("id") * 7 % 1000).alias("k"))
    path = os.path.join(tmp_dir, "sorted")
    got = row_index(data, ["k"], name="at", path=path)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert os.path.isdir(path) and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.filter("k <> at").count() == 0 and got.count() == 1000
    work, sizes = RS.work_list(data, ["k"], 30)
    assert not [f for f in os.listdir(os.path.dirname(work)) if f.startswith("work-order")]
    assert sum(map(sum, sizes)) == 1000 == spark.read.parquet(work).count()
