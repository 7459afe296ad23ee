"""Token windows on keyed state."""

from pyspark.sql import functions as F

from rowsmith.operators import metrics as MT
from rowsmith.streaming.keyed_tokens import run_keyed_token_windows

_TOKENS = "s LONG, i LONG, us LONG, tok STRING"
START, HOUR = 1_700_000_000_000_000, 3_600_000_000


def _land(spark, rows, path, part):
    df = spark.createDataFrame(rows, _TOKENS)
    df.select("s", "i", F.timestamp_micros("us").alias("ts"), "tok").coalesce(1).write.parquet(f"{path}/in/part={part}")


def _run(spark, path, **kw):
    schema = "s LONG, i LONG, ts TIMESTAMP, tok STRING"
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/in")
    return run_keyed_token_windows(stream, ["s"], "ts", "i", "tok", f"{path}/out", f"{path}/ckpt", size=50, **kw)


def _windows(df):
    return sorted(((r["s"], r["window_no"], r["n_tokens"], r["text"], r["elapsed_us"], r["tokens_per_sec"]) for r in df.collect()), key=repr)


def test_windows_go_on_after_a_pause(spark, tmp_dir):
    rows = [(None if i % 3 == 0 else i % 2, i, START + i * 1000, f"t{i}") for i in range(230)]  # a null key is a key
    _land(spark, rows[:90], tmp_dir, 0)
    assert sum(w[2] for w in _windows(_run(spark, tmp_dir).result())) == 90
    later = rows[:90] + [(s, i, us + HOUR, t) for s, i, us, t in rows[90:]]
    _land(spark, later[90:], tmp_dir, 1)
    run = _run(spark, tmp_dir)
    whole = spark.createDataFrame(later, _TOKENS).select("s", "i", F.timestamp_micros("us").alias("ts"), "tok")
    assert _windows(run.result()) == _windows(MT.count_windows(whole, ["s"], ["ts", "i"], "ts", "tok", 50))
    assert run.late().count() == 0
    assert _windows(_run(spark, tmp_dir).result()) == _windows(run.result())  # nothing new


def test_responses_end_and_leave_no_state(spark, tmp_dir):
    sizes = []
    for part in range(3):  # forty responses a batch, each batch two hours after the one before
        base = START + part * 2 * HOUR
        _land(spark, [(100 * part + s, i, base + i, "x") for s in range(40) for i in range(70)], tmp_dir, part)
        run = _run(spark, tmp_dir, lifetime_us=HOUR)
        sizes.append((run.state("head").count(), run.state("pending").count()))
    assert sizes == [(40, 800)] * 3  # those of the last batch alone, however many have ended
    ended = [w for w in _windows(run.windows()) if w[0] < 200]
    assert sorted((w[1], w[2]) for w in ended) == [(0, 50)] * 80 + [(1, 20)] * 80
    # Late: of a response that has ended, and before the end of a written window.
    _land(spark, [(7, 500, START + 100, "old"), (201, 0, START + 4 * HOUR, "behind"), (202, 900, START + 4 * HOUR + 900, "on")], tmp_dir, 3)
    run = _run(spark, tmp_dir, lifetime_us=HOUR)
    assert sorted((r.s, r.frag_tok) for r in run.late().collect()) == [(7, "old"), (201, "behind")]
    assert run.state("pending").where("s = 202").count() == 21 and run.state("head").where("s = 7").count() == 0


def test_one_response_with_most_rows_and_an_empty_stream(spark, tmp_dir):
    rows = [(1, i, START + i // 7, None if i % 11 == 0 else f"{i} ") for i in range(20_000)] + [(2, i, START + i, "b") for i in range(30)]
    _land(spark, rows, tmp_dir, 0)
    whole = spark.createDataFrame(rows, _TOKENS).select("s", "i", F.timestamp_micros("us").alias("ts"), "tok")
    assert _windows(_run(spark, tmp_dir).result()) == _windows(MT.count_windows(whole, ["s"], ["ts", "i"], "ts", "tok", 50))
    none = f"{tmp_dir}/none"
    spark.createDataFrame([], "s LONG, i LONG, ts TIMESTAMP, tok STRING").write.parquet(f"{none}/in/part=0")
    run = _run(spark, none)
    assert run.windows().count() == 0 and run.late().count() == 0
