"""Token windows of a stream on keyed state (T3): ``transformWithState`` with list state and event timers.

Every ``size`` fragments of a response become one window row, as in
``metrics.count_windows``. What a response needs from one micro-batch to the next lies in
the state store: the fragments of its window that is not full yet (list state, fewer than
``size``) and a head (the next window's number, where the last one ended, its newest
fragment). Nothing written is read again and no table of all responses is kept.

A response lives for ``lifetime_us`` after its newest fragment, by the stream's own clock
(the newest fragment of all up to the batch before). Then a timer ends it: its partial
window is written, its state goes, and nothing of it stays. A fragment that comes when
its response must be over, or that is older than the end of a window written, is late and
goes to the side table; none is dropped. A response that speaks on after its end starts
anew. Without a lifetime responses never end.

Windows and late rows of a micro-batch go to ``windows/batch_id=N`` and ``late/batch_id=N``
in overwrite mode, so a replayed batch replaces itself. The rows of one response in one
micro-batch meet in one task: set ``maxFilesPerTrigger`` on the source to bound them. The
state lies in RocksDB, so a task holds one response at a time.

Spark drops rows behind its watermark before they reach the state, and fires timers by the
same watermark. So that late rows are kept, the watermark follows ``BEHIND`` after the
newest fragment and timers are set as much earlier; only a fragment older than that
(ten years) would be lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.metrics import epoch_micros
from ..session import checkpoint_root
from .resume import read_result

#: Days that the watermark stays behind the newest fragment.
BEHIND_DAYS = 3650
_BEHIND_US = BEHIND_DAYS * 86_400_000_000

# Names that Python takes as field names, as Spark hands rows to the processor as named tuples.
_FRAGMENT = "frag_us LONG, frag_ord LONG, frag_tok STRING"
_WINDOW = "window_no LONG, n_tokens LONG, text STRING, elapsed_us LONG, tokens_per_sec DOUBLE"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def window_rows(fragments: pd.DataFrame, size: int, number: int, end_us: int | None) -> pd.DataFrame:
    """Windows of sorted fragments, numbered from ``number``; ``end_us`` is the end of the window before."""
    starts = np.arange(0, len(fragments), size)
    us, tokens = fragments["frag_us"].to_numpy(), fragments["frag_tok"].tolist()
    last = us[np.minimum(starts + size, len(us)) - 1]
    before = np.concatenate([[us[0] if end_us is None else end_us], last[:-1]])
    n = np.minimum(size, len(us) - starts)
    elapsed = last - before
    rate = np.where(elapsed > 0, n / (np.maximum(elapsed, 1) / 1e6), 0.0)
    text = ["".join(t for t in tokens[a : a + size] if t is not None) for a in starts.tolist()]
    return pd.DataFrame({"window_no": number + np.arange(len(starts)), "n_tokens": n, "text": text, "elapsed_us": elapsed, "tokens_per_sec": rate})


class TokenWindowProcessor(StatefulProcessor):
    """State of one response."""

    def __init__(self, keys: list[str], columns: list[str], size: int, lifetime_us: int | None):
        self.keys, self.columns, self.size, self.lifetime = keys, columns, size, lifetime_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", _FRAGMENT)
        self.head = handle.getValueState("head", "next_window LONG, end_us LONG, end_ord LONG, newest_us LONG")

    def _out(self, key: tuple, rows: pd.DataFrame, late: bool) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        for name, value in zip(self.keys, key):
            rows[name] = value
        rows["late"] = late
        for name in set(self.columns) - set(rows.columns):
            rows[name] = pd.Series([None] * len(rows), dtype=object)  # NaN would be no text for Arrow
        return rows[self.columns]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802 - Spark's API
        new = pd.concat([r[["frag_us", "frag_ord", "frag_tok"]] for r in rows], ignore_index=True)
        known = self.head.get() if self.head.exists() else None
        number, end_us, end_ord, newest = known if known is not None else (0, None, None, None)
        late = np.zeros(len(new), bool)
        if self.lifetime is not None:
            clock = timerValues.getCurrentWatermarkInMs() * 1000 + _BEHIND_US
            # A response that the clock has ended gets nothing more, whether it is known still or not.
            over = newest + self.lifetime < clock if newest is not None else False
            late |= ((new["frag_us"] + self.lifetime < clock) & ((newest is None) | over)).to_numpy()
        if end_us is not None:
            late |= ((new["frag_us"] < end_us) | ((new["frag_us"] == end_us) & (new["frag_ord"] <= end_ord))).to_numpy()
        if late.any():
            yield self._out(key, new[late], True)
            new = new[~late]
            if not len(new):
                return
        held = pd.DataFrame(list(self.pending.get()), columns=["frag_us", "frag_ord", "frag_tok"]) if known is not None else new[:0]
        rows_now = (pd.concat([held, new], ignore_index=True) if len(held) else new).sort_values(["frag_us", "frag_ord", "frag_tok"], kind="stable")
        full = len(rows_now) // self.size * self.size
        newest = int(max(rows_now["frag_us"].max(), newest if newest is not None else rows_now["frag_us"].max()))
        if full:
            done = rows_now.iloc[:full]
            yield self._out(key, window_rows(done, self.size, number, end_us), False)
            number, end_us, end_ord = number + full // self.size, int(done["frag_us"].iloc[-1]), int(done["frag_ord"].iloc[-1])
        rest = rows_now.iloc[full:]
        self.pending.clear()
        if len(rest):
            self.pending.put([(int(u), int(o), t) for u, o, t in rest.itertuples(index=False, name=None)])
        self.head.update((number, end_us, end_ord, newest))
        if self.lifetime is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # Fires once the clock has passed the end of the response's life.
            self.handle.registerTimer(int((newest + self.lifetime - _BEHIND_US) // 1000 + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        number, end_us, _, _ = self.head.get()
        held = list(self.pending.get())
        self.pending.clear()
        self.head.clear()
        if held:
            yield self._out(key, window_rows(pd.DataFrame(held, columns=["frag_us", "frag_ord", "frag_tok"]), self.size, number, end_us), False)

    def close(self) -> None:
        pass


class KeyedTokenWindows:
    """What a token stream has written under ``base_path``, and the state of its open responses."""

    def __init__(self, spark: SparkSession, base_path: str, checkpoint_path: str, keys: T.StructType, size: int):
        self.spark, self.base, self.checkpoint, self.keys, self.size = spark, base_path, checkpoint_path, keys, size

    def _read(self, table: str, ddl: str) -> DataFrame:
        schema = T.StructType([*self.keys.fields, *T.StructType.fromDDL(ddl).fields])
        return read_result(self.spark, f"{self.base}/{table}", schema).select(*schema.names)

    def windows(self) -> DataFrame:
        """Full windows, and the partial last ones of responses that have ended."""
        return self._read("windows", _WINDOW)

    def late(self) -> DataFrame:
        return self._read("late", _FRAGMENT)

    def state(self, name: str) -> DataFrame:
        """The rows of a state variable (``head``, ``pending``), by key."""
        reader = self.spark.read.format("statestore").option("stateVarName", name)
        found = reader.load(self.checkpoint)
        value = "list_element" if name == "pending" else "value"
        return found.select(*[F.col(f"key.{k}").alias(k) for k in self.keys.names], f"{value}.*")

    def result(self) -> DataFrame:
        """All windows so far, the partial ones of open responses (from the state) included."""
        held, head = self.state("pending"), self.state("head")
        keys = self.keys.names
        right = head.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "next_window", "end_us")
        items = held.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("frag_us", "frag_ord", "frag_tok"))).alias("f"))  # fewer than ``size``
        met = items.join(right, [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)])
        n, last = F.size("f").cast("long"), F.element_at("f", -1)["frag_us"]
        elapsed = last - F.coalesce("end_us", F.element_at("f", 1)["frag_us"])
        rate = F.when(elapsed > 0, n / (elapsed / F.lit(1000000.0))).otherwise(F.lit(0.0))
        text = F.array_join(F.transform("f", lambda x: x["frag_tok"]), "")
        partial = met.select(*keys, F.col("next_window").alias("window_no"), n.alias("n_tokens"), text.alias("text"), elapsed.alias("elapsed_us"), rate.alias("tokens_per_sec"))
        return self.windows().unionByName(partial)


def run_keyed_token_windows(
    stream: DataFrame,
    stream_cols: Sequence[str],
    ts_col: str,
    order_col: str,
    token_col: str,
    base_path: str,
    checkpoint_path: str,
    size: int = 50,
    lifetime_us: int | None = None,
) -> KeyedTokenWindows:
    """Count windows over everything the stream holds now; a later run with the same checkpoint goes on."""
    from ..session import ship_package

    spark = stream.sparkSession
    checkpoint_root(spark)
    ship_package(spark)
    keys = T.StructType([stream.schema[k] for k in stream_cols])
    rows = stream.select(
        *stream_cols, epoch_micros(stream, ts_col).alias("frag_us"), F.col(order_col).cast("long").alias("frag_ord"), F.col(token_col).cast("string").alias("frag_tok")
    )
    if lifetime_us is not None:
        rows = rows.withColumn("frag_at", F.timestamp_micros("frag_us")).withWatermark("frag_at", f"{BEHIND_DAYS} days")
    out = T.StructType([*keys.fields, *T.StructType.fromDDL(f"{_WINDOW}, {_FRAGMENT}, late BOOLEAN").fields])
    processor = TokenWindowProcessor(list(keys.names), out.names, size, lifetime_us)
    placed = rows.groupBy(*stream_cols).transformWithStateInPandas(processor, out, "Append", "none" if lifetime_us is None else "eventTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for table, ddl, kind in (("windows", _WINDOW, ~F.col("late")), ("late", _FRAGMENT, F.col("late"))):
            names = [*keys.names, *T.StructType.fromDDL(ddl).names]
            batch.filter(kind).select(*names).write.mode("overwrite").parquet(f"{base_path}/{table}/batch_id={batch_id}")
        batch.unpersist()

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = placed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return KeyedTokenWindows(spark, base_path, checkpoint_path, keys, size)
