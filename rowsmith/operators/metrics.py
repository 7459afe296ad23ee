"""Throughput, response statistics and progress.

Count windows are computed from a distributed row index (no single-task window
per stream) and one partial ``groupBy``; the previous window's end reaches each
window through a copy of its last fragment, instead of a ``lag`` over the whole
stream or a self-join that would run the whole plan twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .ordering import every_nth, row_index


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(df: DataFrame, ts_col: str) -> Column:
    """Micro-seconds since the epoch, independent of the session time zone.

    A ``TIMESTAMP_NTZ`` is a wall-clock value: casting it to ``TIMESTAMP`` would
    read it in the session zone (and shift across daylight-saving changes), so
    it is measured against the NTZ epoch instead.
    """
    if df.schema[ts_col].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts_col}`)")
    return F.unix_micros(F.col(ts_col))


def count_windows(
    tokens: DataFrame,
    stream_cols: Sequence[str],
    order_by: Sequence[str],
    ts_col: str,
    token: Column | str,
    size: int = 50,
) -> DataFrame:
    """W3 + A3: tumbling windows of ``size`` fragments per stream.

    Per window: number of fragments, concatenated text (in order), first and
    last time stamp, elapsed micro-seconds since the previous window's end (the
    first window starts at its own first fragment) and fragments per second
    (0 when no time passed). A last partial window uses its own length.
    """
    # Only what the windows need is ranked: the rest would go through the checkpoint.
    slim = tokens.select(
        *stream_cols, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], epoch_micros(tokens, ts_col).alias("_us"), _c(token).cast("string").alias("_tok")
    )
    idx = row_index(slim, [f"_o{i}" for i in range(len(order_by))], stream_cols, name="_tok_idx")
    return paced(windows_of(idx, stream_cols, size), stream_cols)


def windows_of(idx: DataFrame, stream_cols: Sequence[str], size: int) -> DataFrame:
    """Windows of ranked fragments (``_tok_idx, _us, _tok``): number, size, text and times.

    ``_prev_end_us`` is the end of the window before, null for a stream's first.
    """
    us = F.col("_us")
    win = F.floor(F.col("_tok_idx") / F.lit(size)).cast("long")
    own = F.struct(win.alias("w"), F.lit(True).alias("real"), F.col("_tok_idx").alias("i"), us.alias("us"), F.col("_tok").alias("tok"))
    # The last fragment of a window also travels to the next window as that
    # window's start, so one aggregation (no self-join, no lag) gives both.
    carry = F.struct((win + F.lit(1)).alias("w"), F.lit(False).alias("real"), F.col("_tok_idx").alias("i"),
                     us.alias("us"), F.lit(None).cast("string").alias("tok"))
    is_last = (F.col("_tok_idx") % F.lit(size)) == F.lit(size - 1)
    entries = F.when(is_last, F.array(own, carry)).otherwise(F.array(own))
    e = idx.select(*stream_cols, F.explode(entries).alias("e"))
    real = F.col("e.real")
    return e.groupBy(*stream_cols, F.col("e.w").alias("window_no")).agg(
        F.count(F.when(real, F.lit(1))).alias("n_tokens"),
        F.min(F.when(real, F.col("e.us"))).alias("_first_us"),
        F.max(F.when(real, F.col("e.us"))).alias("_last_us"),
        F.max(F.when(~real, F.col("e.us"))).alias("_prev_end_us"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(real, F.struct(F.col("e.i"), F.col("e.tok"))))), lambda x: x["tok"]
            ),
            "",
        ).alias("text"),
    ).filter(F.col("n_tokens") > 0)


def paced(windows: DataFrame, stream_cols: Sequence[str]) -> DataFrame:
    """Elapsed time and rate of :func:`windows_of`'s rows."""
    elapsed = F.col("_last_us") - F.coalesce(F.col("_prev_end_us"), F.col("_first_us"))
    rate = F.when(elapsed > 0, F.col("n_tokens") / (elapsed / F.lit(1000000.0))).otherwise(F.lit(0.0))
    return windows.select(*stream_cols, "window_no", "n_tokens", "text", elapsed.alias("elapsed_us"), rate.alias("tokens_per_sec"))


def response_stats(staged: DataFrame) -> DataFrame:
    """A4: roll up model-stage statistics by stop reason."""
    return staged.groupBy("stop_reason").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("response").alias("n_answers"),
        F.count("error").alias("n_errors"),
        F.sum("n_tokens").cast("long").alias("sum_tokens"),
        F.max("n_tokens").alias("max_tokens"),
    )


def stats_message(row_no: Column | str, tokens_per_sec: Column | str, n_tokens: Column | str,
                  stop_reason: Column | str) -> Column:
    """F16: the per-row statistics log line, as a column."""
    # The reference's stats line format.
    return F.format_string(
        "[Row %d] Tokens/sec: %.2f | Total tokens: %d | Stop reason: %s",
        _c(row_no), _c(tokens_per_sec), _c(n_tokens), _c(stop_reason),
    )


def progress_rows(df: DataFrame, order_by: Sequence[str], every: int, message: str = "Row: %d") -> DataFrame:
    """A5 + T2: one progress row per ``every`` processed rows, in row order."""
    idx = row_index(df.select(*order_by), order_by, name="_row")
    n = F.col("_row") + F.lit(1)
    return every_nth(idx, "_row", every).select(
        *order_by, n.alias("rows_done"), F.format_string(message, n).alias("message")
    )


def observed_progress(df: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """A5 for batch jobs: row and error counters collected by ``observe``.

    Read them after the action from the Observation's ``get``.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count("error").alias("errors")), obs


def response_log(staged: DataFrame, row_col: str, every: int | None = None) -> DataFrame:
    """A4 + F16: the per-response statistics lines of a model stage.

    Free-text jobs log every row (``every=None``); structured jobs every n-th
    row by 0-based position ``row_col``. Rows without statistics (failed calls)
    are left out, as the source only warns for them.
    """
    rows = staged if not every else every_nth(staged, row_col, every)
    rate = F.when(F.col("seconds") > 0, F.col("n_tokens") / F.col("seconds")).otherwise(F.lit(0.0))
    ok = rows.filter(F.col("n_tokens").isNotNull() & F.col("stop_reason").isNotNull())
    return ok.select(
        F.col(row_col),
        stats_message(F.col(row_col) + F.lit(1), rate, "n_tokens", "stop_reason").alias("message"),
    )
