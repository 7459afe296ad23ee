"""J4/W4/O2/O3/P8 search, and J3/T1/S8-S11 resume, T2/T3 streaming."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import metrics as MT
from rowsmith.operators import search as S
from rowsmith.streaming import resume as RS
from rowsmith.streaming.tokens import ProgressTable, run_token_windows


def _page(title, body):
    t = f"<title>{title}</title>" if title is not None else ""
    return f"<html><head>{t}<script>var x='alpha';</script></head><body><article><p>{body}</p></article></body></html>"


def test_search_first_pages(spark):
    # 12 candidates for "alpha beta": pages 1-12 all hit both words; 1 and 2 lack a link.
    pages = [(i, "" if i in (1, 2) else f"http://h/{i}", None if i in (1, 2) else f"http://h/{i}",
              _page("T&amp;%d" % i if i != 3 else None, "alpha beta gamma")) for i in range(1, 13)]
    pages.append((50, "http://h/50", None, _page("x", "alpha only")))
    df = spark.createDataFrame(pages, "page_id LONG, url STRING, href STRING, html STRING")
    q = spark.createDataFrame([(1, "Alpha BETA"), (2, "nothing-matches")], "query_id INT, query STRING")
    out = S.first_pages(df, q, href_col="href").orderBy("query_id", "position").collect()
    assert [(r["query_id"], r["position"], r["page_id"]) for r in out] == [(1, 1, 3), (1, 2, 4), (1, 3, 5)]
    assert out[0]["title"] == S.NO_TITLE  # page 3 has no title
    assert out[1]["title"] == "T&4"
    assert out[0]["text"] == "alpha beta gamma"  # script dropped, article kept
    # Only 10 candidates are asked for: with 11 and 12 outside, links are
    # dropped after the cut, so a query never reaches past candidate 10.
    cand = S.search_candidates(df, q).collect()
    assert sorted(r["page_id"] for r in cand) == list(range(1, 11))
    d = S.digest(S.first_pages(df, q, href_col="href")).collect()
    assert len(d) == 1 and d[0]["n_pages"] == 3
    assert d[0]["digest"].startswith("SIDE 1:\nTitel: Ingen titel\nURL: http://h/3\nUddrag:\nalpha beta gamma\n\n\nSIDE 2:")


def test_nested_articles_are_kept_whole(spark):
    from rowsmith.functions import html as H

    rows = [
        (1, "<p>menu</p><article>post <ARTICLE class='c'>comment <article>reply</article> more</ARTICLE> end\n of post</article><p>foot</p><article>next</article>x"),
        (2, "a</article>b<article>c</article>d"),
        (3, "<article>never closed"),
        (4, "<article>one</article>two<article>never closed"),
        (5, "<articles>no</articles>"),
    ]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, "id INT, html STRING").select("id", H.html_to_text("html")).collect()}
    assert got == {1: "post comment reply more end of post next", 2: "c", 3: "never closed", 4: "one", 5: "no"}


def test_several_articles_are_not_run_together(spark):
    from rowsmith.functions.html import html_to_text

    page = "<p>menu</p><article class='a'><p>one &amp; two</p></article><p>advert</p><ARTICLE>three\n</ARTICLE><p>foot</p>"
    rows = [(1, page), (2, "<p>no article</p>"), (3, "<article></article><p>empty one</p>"), (4, None), (5, "")]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, "i INT, h STRING").select("i", html_to_text("h")).collect()}
    assert got == {1: "one & two three", 2: "no article", 3: "empty one", 4: None, 5: ""}


def _classify(df):
    return df.select("k", (F.col("v") * 2).alias("v2"))


def test_resume_antijoin(spark, tmp_dir):
    data = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    path = os.path.join(tmp_dir, "res")
    assert RS.pending(data, RS.read_done(spark, path), ["k"]).count() == 100  # nothing done
    RS.run_resumable(spark, data.filter("k < 30"), ["k"], _classify, path)
    assert RS.pending(data, RS.read_done(spark, path), ["k"]).count() == 70  # part done
    out = RS.run_resumable(spark, data, ["k"], _classify, path, save_every=30)
    assert out.count() == 100 and out.select("k").distinct().count() == 100
    assert RS.pending(data, RS.read_done(spark, path), ["k"]).count() == 0  # all done
    again = RS.run_resumable(spark, data, ["k"], _classify, path)
    assert again.count() == 100  # rerun adds nothing


def test_resume_exploded_records_empty_inputs(spark, tmp_dir):
    rows = [(1, [10, 11]), (2, []), (3, None), (4, [40])]
    data = spark.createDataFrame(rows, "k INT, xs ARRAY<INT>")

    def process(df):
        return df.select("k", F.transform("xs", lambda x: F.struct(x.alias("x"))).alias("items"))

    path = os.path.join(tmp_dir, "exp")
    first = RS.run_resumable_exploded(spark, data.filter("k <= 2"), ["k"], process, "items", path)
    assert sorted((r["k"], r["x"], r["position"]) for r in first.collect()) == [(1, 10, 1), (1, 11, 2)]
    # k=2 produced no rows but is done: the rerun only processes 3 and 4.
    done = RS.read_done(spark, path)
    assert sorted(r["k"] for r in RS.pending(data, done, ["k"]).collect()) == [3, 4]
    out = RS.run_resumable_exploded(spark, data, ["k"], process, "items", path)
    assert sorted((r["k"], r["x"], r["position"]) for r in out.collect()) == [(1, 10, 1), (1, 11, 2), (4, 40, 1)]


def test_stream_resume_and_replay(spark, tmp_dir):
    landing, result, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "result", "ckpt"))
    schema = "k LONG, v LONG"
    spark.range(0, 40).select(F.col("id").alias("k"), F.col("id").alias("v")).repartition(4).write.parquet(f"{landing}/a")
    out = RS.run_stream(spark, landing, schema, _classify, result, ckpt, max_files_per_trigger=2)
    assert out.count() == 40
    spark.range(40, 60).select(F.col("id").alias("k"), F.col("id").alias("v")).repartition(2).write.parquet(f"{landing}/b")
    # Lose the last commit: the restarted query replays that batch.
    commits = sorted(glob.glob(os.path.join(ckpt, "commits", "[0-9]*")), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = os.path.join(os.path.dirname(commits[-1]), "." + os.path.basename(commits[-1]) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    out = RS.run_stream(spark, landing, schema, _classify, result, ckpt, max_files_per_trigger=2)
    assert out.count() == 60 and out.select("k").distinct().count() == 60


_TOKENS = "s LONG, i LONG, us LONG, tok STRING"


def _land(spark, rows, path, part):
    df = spark.createDataFrame(rows, _TOKENS)
    df.select("s", "i", F.timestamp_micros("us").alias("ts"), "tok").coalesce(1).write.parquet(f"{path}/part={part}")


def _run_tokens(spark, path, **kw):
    schema = "s LONG, i LONG, ts TIMESTAMP, tok STRING"
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/in")
    return run_token_windows(stream, ["s"], "ts", "i", "tok", f"{path}/out", f"{path}/ckpt", size=50, **kw)


def _windows(df):
    return sorted((r["s"], r["window_no"], r["n_tokens"], r["text"], r["elapsed_us"], r["tokens_per_sec"]) for r in df.collect())


def test_token_windows_go_on_after_a_pause(spark, tmp_dir):
    start = 1_700_000_000_000_000
    rows = [(i % 2, i, start + i * 1000, f"t{i}") for i in range(230)]
    _land(spark, rows[:90], f"{tmp_dir}/in", 0)
    first = _windows(_run_tokens(spark, tmp_dir).result())
    assert [w[:3] for w in first] == [(0, 0, 45), (1, 0, 45)]  # partial windows are shown
    # An hour later the responses go on: same windows as in one go.
    later = rows[:90] + [(s, i, us + 3_600_000_000, t) for s, i, us, t in rows[90:]]
    _land(spark, later[90:], f"{tmp_dir}/in", 1)
    run = _run_tokens(spark, tmp_dir)
    whole = spark.createDataFrame(later, _TOKENS).select("s", "i", F.timestamp_micros("us").alias("ts"), "tok")
    assert _windows(run.result()) == _windows(MT.count_windows(whole, ["s"], ["ts", "i"], "ts", "tok", 50))
    assert run.read("late").count() == 0
    # Nothing new: the next run changes nothing.
    assert _windows(_run_tokens(spark, tmp_dir).result()) == _windows(run.result())


def test_late_tokens_go_to_the_side(spark, tmp_dir):
    start = 1_700_000_000_000_000
    rows = [(1, i, start + i * 1000, f"t{i}") for i in range(60)]
    _land(spark, rows[30:], f"{tmp_dir}/in", 0)  # 30 rows: pending
    _run_tokens(spark, tmp_dir)
    _land(spark, rows[20:30], f"{tmp_dir}/in", 1)  # older than the pending ones: placed before them
    _run_tokens(spark, tmp_dir)
    _land(spark, [(1, 100 + i, start + (100 + i) * 1000, "n") for i in range(20)], f"{tmp_dir}/in", 2)
    run = _run_tokens(spark, tmp_dir)
    full = [w for w in _windows(run.result()) if w[2] == 50]
    assert len(full) == 1 and full[0][3].startswith("t20t21")
    _land(spark, rows[:20], f"{tmp_dir}/in", 3)  # before the end of a full window: cannot be placed
    run = _run_tokens(spark, tmp_dir)
    assert sorted(r["_tok"] for r in run.read("late").collect()) == sorted(f"t{i}" for i in range(20))
    assert sum(w[2] for w in _windows(run.result())) == 60


def test_a_response_ends(spark, tmp_dir):
    start, hour = 1_700_000_000_000_000, 3_600_000_000
    _land(spark, [(1, i, start + i, "a") for i in range(100)] + [(2, i, start + i, "b") for i in range(70)], f"{tmp_dir}/in", 0)
    _run_tokens(spark, tmp_dir, lifetime_us=hour)
    _land(spark, [(3, i, start + 3 * hour + i, "c") for i in range(5)], f"{tmp_dir}/in", 1)
    _run_tokens(spark, tmp_dir, lifetime_us=hour)
    _land(spark, [(2, 900, start + 4 * hour, "b")], f"{tmp_dir}/in", 2)  # the response was over
    run = _run_tokens(spark, tmp_dir, lifetime_us=hour)
    assert [(w[0], w[1], w[2]) for w in _windows(run.result())] == [(1, 0, 50), (1, 1, 50), (2, 0, 50), (2, 1, 20), (3, 0, 5)]
    assert [r["s"] for r in run.read("late").collect()] == [2]
    assert {r["s"] for r in run.read("pending", run._last_batch()).collect()} <= {3}


def test_progress_table(spark, tmp_dir):
    import time

    listener = ProgressTable(spark, f"{tmp_dir}/progress")
    spark.streams.addListener(listener)
    try:
        _land(spark, [(1, i, i, "x") for i in range(12)], f"{tmp_dir}/in", 0)
        _run_tokens(spark, tmp_dir)
        for _ in range(50):
            if RS.has_data(spark, f"{tmp_dir}/progress"):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(f"{tmp_dir}/progress").agg(F.sum("input_rows")).first()[0] == 12


def _dying(key):
    """Process that raises out of the stage on one key."""
    return lambda df: df.select("k", F.when(F.col("k") == key, F.raise_error(F.lit("dead"))).otherwise(F.col("v") * 2).alias("v2"))


@pytest.mark.parametrize("save_every", [None, 10])
def test_resume_after_a_crash(spark, tmp_dir, save_every):
    data = spark.range(60).select(F.col("id").alias("k"), F.col("id").alias("v"))
    path = os.path.join(tmp_dir, "crash")
    for key in (0, 55):  # in the first chunk, then in the last
        with pytest.raises(Exception, match="dead"):
            RS.run_resumable(spark, data, ["k"], _dying(key), path, save_every=save_every)
    done = RS.read_done(spark, path)
    assert (0 if done is None else done.count()) == (50 if save_every else 0)
    reported = []
    out = RS.run_resumable(spark, data, ["k"], _classify, path, save_every=save_every, report=reported.append)
    assert sorted((r["k"], r["v2"]) for r in out.collect()) == [(i, 2 * i) for i in range(60)]
    if save_every:
        assert reported == [10]  # the last chunk alone was left to do


def test_resume_of_nothing(spark, tmp_dir):
    empty = spark.createDataFrame([], "k LONG, v LONG")
    for every in (None, 5):
        out = RS.run_resumable(spark, empty, ["k"], _classify, os.path.join(tmp_dir, f"e{every}"), save_every=every)
        assert out.count() == 0 and out.columns == ["k", "v2"]
    os.makedirs(os.path.join(tmp_dir, "landing"))
    got = RS.run_stream(spark, os.path.join(tmp_dir, "landing"), empty.schema, _classify, f"{tmp_dir}/r", f"{tmp_dir}/c")
    assert got.count() == 0 and got.columns == ["k", "v2", "batch_id"]


def test_resume_calls_each_row_once(spark, tmp_dir):
    from backends import Counting
    from rowsmith.operators import model as M

    acc = spark.sparkContext.accumulator(0)
    backend = Counting(acc)
    data = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))

    def process(df):
        return M.call_model(df, backend).select("k", "response")

    path = os.path.join(tmp_dir, "calls")
    RS.run_resumable(spark, data.filter("k < 70"), ["k"], process, path)
    assert acc.value == 70
    out = RS.run_resumable(spark, data, ["k"], process, path, save_every=40)
    assert acc.value == 200  # the second run sent only the 130 rows not done
    assert out.count() == 200 and out.select("k").distinct().count() == 200
