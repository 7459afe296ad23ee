"""Label tables, the page index, answers as VARIANT, file order."""

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import text as X
from rowsmith.functions import variants as V
from rowsmith.operators import search as S
from rowsmith.operators.labels import labels_from_table
from rowsmith.operators.ordering import file_ordered, file_ordered_union
from rowsmith.operators.page_index import PageIndex


# --- labels -----------------------------------------------------------------


def test_label_table_equals_the_small_form(spark):
    labels = ["Materialeindkøb", "tjeneste-ydelse", "Tjenesteydelse!", "a b", "x", "Ærø_1"]
    texts = ["**materialeindkøb** og x", "x materialeindkøb", "<think>x</think> TJENESTEYDELSE.", "ærø_1x Ærø_1", "intet", "", None, "a b ab", "x\x1cy", "!!! x"]
    texts += texts[:4] + ["x " * 5000 + "materialeindkøb"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i INT, t STRING, label STRING")
    table = spark.createDataFrame(list(enumerate(labels)), "o INT, name STRING")
    for thinking in (True, False):
        got = {r.i: r.label for r in labels_from_table(df, "t", table, "name", "o", remove_thinking=thinking).collect()}
        small = {r.i: r.l for r in df.select("i", X.extract_label("t", labels, thinking).alias("l")).collect()}
        assert got == small and len(got) == len(texts)


def test_many_labels_and_a_word_in_every_answer(spark):
    labels = spark.range(100_000).select(F.concat(F.lit("Label-"), F.col("id")).alias("label"))
    answers = spark.range(5000).select("id", F.concat(F.lit("everywhere label7 Label"), F.col("id") * 21, F.lit(". label3")).alias("t"))
    out = labels_from_table(answers, "t", labels.unionByName(spark.createDataFrame([("Everywhere",)], "label STRING")))
    assert out.groupBy("label").count().collect() == [("Everywhere", 5000)]
    out = labels_from_table(answers.withColumn("t", F.regexp_replace("t", "everywhere label7 ", "")), "t", labels)
    wrong = out.filter(F.col("label") != F.when(F.col("id") * 21 < 100_000, F.concat(F.lit("Label-"), F.col("id") * 21)).otherwise(F.lit("Label-3")))
    assert wrong.count() == 0 and out.count() == 5000


def test_label_table_of_nothing(spark):
    answers = spark.createDataFrame([(1, "x")], "i INT, t STRING")
    none = spark.createDataFrame([], "label STRING")
    assert labels_from_table(answers, "t", none).collect() == [(1, "x", None)]
    assert labels_from_table(answers.limit(0), "t", spark.createDataFrame([("x",), (None,), ("--",)], "label STRING")).count() == 0


# --- page index ---------------------------------------------------------------


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")


def _ranked(df):
    return sorted((r.query_id, r["rank"], r.page_id, r.score) for r in df.collect())


def test_index_gives_what_a_scan_gives(spark, tmp_dir):
    pages = _pages(spark, [(i, f"u{i}", f"<p>common word{i % 7} {'rare' if i % 50 == 0 else ''} Blå{i % 3}</p>") for i in range(500)] + [(None, "u", "common"), (900, "e", ""), (901, "n", None)])
    queries = spark.createDataFrame([(1, "common rare"), (2, "BLÅ1 word3 word3"), (3, "nothing here"), (4, "")], "query_id INT, query STRING")
    index = PageIndex(spark, f"{tmp_dir}/ix")
    assert index.search(queries).count() == 0  # nothing indexed yet
    index.add(pages.filter("page_id < 200"))
    index.add(pages)
    index.add(pages)  # nothing new
    wanted = _ranked(S.search_candidates(pages.filter("page_id is not null"), queries, 20))
    assert _ranked(index.search(queries, 20)) == wanted and wanted


def _files_read(df):
    """Files that the scans of an executed plan read."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        metric = node.metrics().get("numFiles")
        if metric.isDefined():
            total += metric.get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_search_reads_the_buckets_of_its_words(spark, tmp_dir):
    index = PageIndex(spark, f"{tmp_dir}/ix", buckets=32)
    index.add(_pages(spark, [(i, "u", "needle alpha") for i in range(100)]))
    queries = spark.createDataFrame([(1, "needle")], "query_id INT, query STRING")
    words = S.query_words(queries)
    before = _files_read(index.postings(words))
    mine = words.select(index._bucket(F.col("word"))).first()[0]
    others = spark.range(500).select(F.concat(F.lit("w"), F.col("id")).alias("w")).filter(index._bucket(F.col("w")) != mine)
    other = [r.w for r in others.limit(60).collect()]
    index.add(_pages(spark, [(1000 + i, "u", " ".join(other)) for i in range(300)]))
    assert _files_read(index.postings(words)) == before > 0  # pages without the word are not read
    assert index.search(queries, 200).count() == 100


def test_a_word_on_every_page_is_many_rows(spark, tmp_dir, monkeypatch):
    from rowsmith.operators import page_index

    monkeypatch.setattr(page_index, "BLOCK_PAGES", 64)
    index = PageIndex(spark, f"{tmp_dir}/ix")
    index.add(_pages(spark, [(i, "u", "hot hot") for i in range(1000)]).coalesce(1))
    rows = index.postings(spark.createDataFrame([("hot",)], "word STRING")).collect()
    assert sum(len(r.ids) for r in rows) == 1000 and max(len(r.ids) for r in rows) <= 64 and {c for r in rows for c in r.counts} == {2}


# --- VARIANT ------------------------------------------------------------------


def test_five_kinds_of_fields(spark):
    rows = [
        '{"a": "x", "n": 3, "d": 1.5, "b": true}', '{"a": null, "n": null}', "{}", '{"a": 5, "n": "3", "d": "1", "b": 1}', '{"a": ["x"], "n": 3.5, "d": 2, "b": null}',
        '{"n": 99999999999}', '{"a": "x"', "[1]", '"text"', "", "  ", None, "null", '{"a": {"b": 1}, "n": -7, "d": 1e300}', "{'a': 1}",
    ]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(rows)], "i INT, t STRING, status STRING")
    out = V.with_variant_answer(df, "t", {"a": "string", "n": "int", "d": "double", "b": "boolean"}, required=("a",))
    got = {r.i: r for r in out.collect()}
    assert [got[i].status for i in range(len(rows))] == ["ok"] * 6 + ["bad json", "no object", "no object", "empty", "empty", "missing", "no object", "ok", "bad json"]
    assert (got[0].a, got[0].n, got[0].d, got[0].b) == ("x", 3, 1.5, True) and got[0].violations == []
    assert (got[1].a_state, got[1].n_state, got[1].d_state) == ("null", "null", "absent") and got[1].violations == ["a: null"]
    assert got[2].violations == ["a: absent"] and got[2].n_state == "absent"
    assert [got[3][f"{k}_state"] for k in "andb"] == ["wrong type"] * 4 and (got[3].a, got[3].n, got[3].d, got[3].b) == (None,) * 4
    assert got[4].a_state == "wrong type" and got[4].n_state == "wrong type" and got[4].d == 2.0 and got[4].b_state == "null"
    assert got[5].n_state == "wrong type" and got[13].n == -7 and got[13].d == 1e300 and got[13].a_state == "wrong type"
    assert got[6].a_state is None and got[11].violations == []


# --- file order ---------------------------------------------------------------


def test_rows_are_numbered_as_they_lie(spark, tmp_dir):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("row_id"))
    rows.repartitionByRange(4, F.col("k").desc()).sortWithinPartitions(F.col("k").desc()).write.option("maxRecordsPerFile", 90).parquet(f"{tmp_dir}/a")
    got = file_ordered(spark, f"{tmp_dir}/a")
    assert got.columns == ["k", "row_id"]
    assert [(r.k, r.row_id) for r in got.orderBy("row_id").collect()] == [(999 - i, i) for i in range(1000)]
    # A filter above, and another number of partitions, change no number.
    assert file_ordered(spark, f"{tmp_dir}/a").filter("k = 0").first().row_id == 999


@pytest.mark.parametrize("empty", [False, True])
def test_union_goes_on_counting(spark, tmp_dir, empty):
    spark.range(0 if empty else 30).select(F.col("id").alias("a")).coalesce(1).write.parquet(f"{tmp_dir}/one")
    spark.range(20).select((F.col("id") * 2).alias("b"), F.col("id").cast("string").alias("a")).coalesce(1).write.parquet(f"{tmp_dir}/two")
    out = file_ordered_union(spark, {"one": f"{tmp_dir}/one", "two": f"{tmp_dir}/two"}).orderBy("row_id").collect()
    n = 0 if empty else 30
    assert [r.row_id for r in out] == list(range(n + 20)) and [r.b for r in out[n:]] == [2 * i for i in range(20)]
    assert [r.source_name for r in out] == ["one"] * n + ["two"] * 20
