"""P7, T1 parameter resolution, S10 clean-up, P9 defaults."""

import os

from pyspark.sql import functions as F

from rowsmith.config import JobConfig, resolve_column, resolve_every
from rowsmith.operators.explode import explode_answer
from rowsmith.streaming.resume import delete_results


def test_resolve_column():
    assert resolve_column(None) == "Fakturabeskrivelse"
    assert resolve_column("NULL") == "Fakturabeskrivelse"
    assert resolve_column("Tekst") == "Tekst"


def test_resolve_every():
    assert resolve_every(5, 10) == 5
    assert resolve_every(None, 10) == 10
    assert resolve_every(0, 0) == 100
    cfg = JobConfig("in.parquet", "out.parquet", input_col="null", save_every=25)
    assert cfg.text_col == "Fakturabeskrivelse"
    assert cfg.rows_between_saves() == 25 and cfg.rows_between_saves(3) == 3
    assert cfg.rows_between_progress() == 500


def test_delete_results(spark, tmp_dir):
    path = os.path.join(tmp_dir, "res")
    spark.range(3).write.parquet(path)
    assert delete_results(spark, path) is True
    assert not os.path.exists(path)
    assert delete_results(spark, path) is False


def test_explode_defaults(spark):
    df = spark.createDataFrame([(1, (None, [(1,)]))], "id INT, a STRUCT<kreditor: STRING, l: ARRAY<STRUCT<x: INT>>>")
    out = explode_answer(df, "a", "l", keep=["id"], scalar_fields=["kreditor"], defaults={"kreditor": ""})
    assert out.select("answer_kreditor").first()[0] == ""
    assert F is not None


def test_load_template_and_observe(spark, tmp_dir):
    from rowsmith.functions.prompts import load_template
    from rowsmith.operators.metrics import observed_progress

    path = os.path.join(tmp_dir, "t.txt")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("Linje: {x}\n")
    assert load_template(path) == "Linje: {x}\n"
    df = spark.createDataFrame([(1, None), (2, "boom")], "id INT, error STRING")
    obs_df, seen = observed_progress(df)
    obs_df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "errors": 1}
