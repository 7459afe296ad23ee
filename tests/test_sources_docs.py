"""S1-S7, U1, P5, J2, F11 edge cases."""

import os

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import documents as D
from rowsmith.operators.explode import base_name
from rowsmith.sources import readers as R


def test_format_dispatch():
    assert R.format_of("/a/b/x.PARQUET") == "parquet"
    assert R.format_of("x.Csv") == "csv"
    assert R.format_of("x.jsonl") == "json"
    with pytest.raises(ValueError):
        R.format_of("x.xlsx")
    with pytest.raises(ValueError):
        R.format_of("/a/noext")


@pytest.mark.parametrize("suffix", ["parquet", "csv", "json"])
def test_roundtrip(spark, tmp_dir, suffix):
    df = spark.createDataFrame([(1, "a, \"quoted\"\nnew line", 1.5), (2, None, None)], "id INT, s STRING, d DOUBLE")
    path = os.path.join(tmp_dir, f"t.{suffix}")
    R.write_table(df, path, multi_line=True)
    back = R.load_table(spark, path, schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_csv_is_read_line_by_line(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"cell {i}, \"q\"") for i in range(2000)], "id INT, s STRING").coalesce(1)
    path = R.write_table(df, os.path.join(tmp_dir, "t.csv"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        back = R.load_table(spark, path, schema=df.schema)
        assert back.rdd.getNumPartitions() > 1  # one file, many tasks
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    broken = spark.createDataFrame([(1, "two\nlines")], "id INT, s STRING")
    with pytest.raises(Exception, match="line break"):
        R.write_table(broken, os.path.join(tmp_dir, "b.csv"))


def test_union_named_inputs(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, a STRING")
    b = spark.createDataFrame([("7", 2.0)], "id STRING, b DOUBLE")  # INT / STRING clash on id
    c = spark.createDataFrame([(3,)], "c INT")
    out = R.union_named_inputs({"a": a, "b": b, "c": c}, exclude=["c"])
    assert dict(out.dtypes)["id"] == "string"
    got = sorted(tuple(r) for r in out.select("id", "a", "b", "source_name", "source_ordinal").collect())
    assert got == [("1", "x", None, "a", 0), ("7", None, 2.0, "b", 1)]
    with pytest.raises(ValueError):
        R.union_named_inputs({"a": a}, exclude=["a"])


def test_align_columns(spark):
    a = spark.createDataFrame([(1,)], "x INT")
    b = spark.createDataFrame([("s", 2.0)], "y STRING, X DOUBLE")
    out = R.align_columns(a, b)
    assert out.columns == ["x", "y"]  # X exists (names are case-insensitive)
    assert dict(out.dtypes)["y"] == "string"


def test_base_name(spark):
    paths = ["/r/a/10.PDF", "/r/a.b.pdf", "noext", "/r/dir/", "x.tar.gz"]
    df = spark.createDataFrame([(p,) for p in paths], "p STRING")
    assert [r[0] for r in df.select(base_name("p")).collect()] == ["10", "a.b", "noext", "", "x.tar"]


def _tree(root):
    files = {"a/10.PDF": b"A10", "b/10.pdf": b"B10", "b/11.pdf": b"B11", "c/x.b.pdf": b"XB", "c/12.txt": b"no"}
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(data)


def test_doc_scan_and_lookup(spark, tmp_dir):
    _tree(tmp_dir)
    files = D.scan_documents(spark, tmp_dir, with_content=True)
    names = sorted(os.path.relpath(r["path"].replace("file:", ""), tmp_dir) for r in files.collect())
    assert names == ["a/10.PDF", "b/10.pdf", "b/11.pdf", "c/x.b.pdf"]  # .PDF found, .txt not
    reg = spark.createDataFrame([(10,), (11,), (13,), (None,)], "fakt_id LONG")
    out = D.lookup_documents(reg, "fakt_id", files.select("path", "content"))
    got = {r["fakt_id"]: (r["doc_path"], r["doc_content"]) for r in out.collect()}
    assert got[10][0].endswith("a/10.PDF") and bytes(got[10][1]) == b"A10"  # first by path
    assert bytes(got[11][1]) == b"B11"
    assert got[13] == (None, None)
    assert got[None] == (None, None)
    assert out.count() == 4
    named = D.first_by_base_name(files.select("path"))
    assert "x.b" in [r["base_name"] for r in named.collect()]


def test_spread(spark):
    df = spark.range(100).coalesce(1)
    assert R.spread(df, 4).rdd.getNumPartitions() == 4
    big = spark.range(100).repartition(10)
    assert R.spread(big, 4).rdd.getNumPartitions() == 10
    assert F is not None


def test_pages_go_back_together(spark):
    rows = [("a", 2, b"2"), ("a", 1, b"1"), ("b", 1, None), ("a", 3, None)]
    df = spark.createDataFrame(rows, "doc STRING, page_no INT, content BINARY").repartition(3)
    got = {r["doc"]: [None if p is None else bytes(p) for p in r["pages"]] for r in D.pages_of(df, "doc").collect()}
    assert got == {"a": [b"1", b"2", None], "b": [None]}


def test_reader_job_keeps_failed_documents(spark):
    from backends import BrokenWriter
    from rowsmith.operators import standins as B
    from rowsmith.plans import jobs as J

    rows = [(1, "ok", [b"x"], "n1"), (2, "cut", [b"x"], "n2"), (3, "empty", [b"x"], "n3"), (4, "none", [b"x"], "n4"),
            (5, "raise", [b"x"], "n5"), (6, "ok", [], "n6"), (7, "ok", None, "n7"), (8, "nolines", [b"x"], "n8"), (9, "ok", [None], "n9")]
    df = spark.createDataFrame(rows, "id INT, cred STRING, pages ARRAY<BINARY>, note STRING")
    out = {r["id"]: r for r in J.read_documents(df, "cred", "pages", B.PageReaderBackend(), BrokenWriter()).collect()}
    assert set(out) == {1, 2, 3, 4, 5, 6, 7, 9}  # a sound answer without lines gives no row
    assert (out[1]["status"], out[1]["error"], out[1]["antal"], out[1]["linjenummer"], out[1]["note"]) == ("ok", None, 2, 1, "n1")
    assert {i: out[i]["status"] for i in (2, 3, 4, 5, 6, 7, 9)} == {2: "invalid", 3: "empty", 4: "missing", 5: "missing", 6: "missing", 7: "missing", 9: "missing"}
    assert all(out[i]["error"] for i in (2, 3, 4, 5, 6, 7, 9)) and "writer down" in out[5]["error"]
    assert out[6]["error"] == "no readable page" and out[6]["note"] == "n6" and out[6]["antal"] is None
    with pytest.raises(TypeError):
        J.read_documents(df, "cred", "pages")  # no stand-in steps in for a missing model


def test_containers(spark, tmp_dir):
    rows = [("a/b.PDF", b"12345"), ("x.y.pdf", b""), ("no suffix", None), ("a/b.PDF", b"again")]
    docs = spark.createDataFrame(rows, "n STRING, c BINARY").coalesce(1)
    D.write_containers(docs, F.col("n"), F.col("c"), f"{tmp_dir}/c", rows_per_file=2)
    names = D.scan_containers(spark, f"{tmp_dir}/c")
    assert "content" not in names._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    got = {(r.path.split(D.MEMBER)[1], r.length) for r in names.collect()}
    assert got == {("a/b.PDF", 5), ("x.y.pdf", 0), ("no suffix", None)}
    assert len({r.path.split(D.MEMBER)[0] for r in names.collect()}) == 2
    whole = D.scan_containers(spark, f"{tmp_dir}/c", with_content=True)
    assert sorted(bytes(r.content or b"") for r in whole.collect()) == [b"", b"", b"12345", b"again"]
    found = D.lookup_documents(spark.createDataFrame([("b",), ("x.y",), ("z",), (None,)], "id STRING"), "id", names.select("path"))
    assert {r.id: r.doc_path is not None for r in found.collect()} == {"b": True, "x.y": True, "z": False, None: False}
    D.write_containers(docs.limit(0), F.col("n"), F.col("c"), f"{tmp_dir}/e")
    assert D.scan_containers(spark, f"{tmp_dir}/e").count() == 0
