"""Token streams and stream progress.

``run_token_windows`` is the streaming form of ``metrics.count_windows``: every
``size`` fragments of a response become one window row. Each micro-batch is a plain
DataFrame job: pending fragments of earlier batches and the new ones are ranked
together (``row_index``, so a hot response is spread over many tasks), full windows
are written, and what is left is pending again. Tables under ``base_path`` hold it
all, one folder per micro-batch, written in overwrite mode, so a replayed batch
replaces itself:

* ``arrived``: the fragments of each micro-batch;
* ``windows``: full windows;
* ``heads``: per response the next window's number, the end of the last window,
  its newest fragment and whether it is closed;
* ``pending``: fragments of windows not yet full, fewer than ``size`` per response;
* ``late``: fragments that came too late to be placed.

A response lives for ``lifetime`` of event time after its newest fragment (for ever
without one). Until then a pause of any length changes nothing: its windows go on
in number, and the last, partial window is shown from ``pending`` and grows. When
its life is over the partial window is written for good and the response is closed;
only its row in ``heads`` stays. A fragment older than the last full window, or of
a closed response, goes to ``late``; none is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.metrics import epoch_micros, paced, windows_of
from ..operators.ordering import row_index
from ..session import checkpoint_root
from .resume import read_result

_FRAGMENT = "_us LONG, _ord LONG, _tok STRING"
_HEAD = "next_window LONG, end_us LONG, end_ord LONG, newest_us LONG, closed BOOLEAN"
_WINDOW = "window_no LONG, n_tokens LONG, text STRING, elapsed_us LONG, tokens_per_sec DOUBLE"


class TokenWindows:
    """Tables of one token stream under ``base_path``."""

    def __init__(self, spark: SparkSession, base_path: str, keys: T.StructType, size: int):
        self.spark, self.base, self.size = spark, base_path, size
        self.keys = keys.names
        schema = lambda ddl: T.StructType([*keys.fields, *T.StructType.fromDDL(ddl).fields])
        self.schema = {"arrived": schema(_FRAGMENT), "windows": schema(_WINDOW), "heads": schema(_HEAD), "pending": schema(_FRAGMENT), "late": schema(_FRAGMENT)}

    def read(self, table: str, batch_id: int | None = None) -> DataFrame:
        path = f"{self.base}/{table}" + ("" if batch_id is None else f"/batch_id={batch_id}")
        return read_result(self.spark, path, self.schema[table]).select(*self.schema[table].names)

    def write(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.select(*self.schema[table].names).write.mode("overwrite").parquet(f"{self.base}/{table}/batch_id={batch_id}")

    def _with_heads(self, df: DataFrame, heads: DataFrame) -> DataFrame:
        right = heads.select(*[F.col(k).alias(f"_h_{k}") for k in self.keys], *T.StructType.fromDDL(_HEAD).names)
        cond = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in self.keys]
        return df.join(right, on=cond, how="left").drop(*[f"_h_{k}" for k in self.keys])

    def _numbered(self, fragments: DataFrame, heads: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Ranked fragments, and the windows they make, numbered on from the heads."""
        idx = row_index(fragments, ["_us", "_ord", "_tok"], self.keys, name="_tok_idx")
        found = self._with_heads(windows_of(idx, self.keys, self.size), heads)
        number = F.col("window_no") + F.coalesce("next_window", F.lit(0))
        # The first window here starts where the response's last one ended.
        return idx, found.withColumn("window_no", number).withColumn("_prev_end_us", F.coalesce("_prev_end_us", "end_us"))

    def add(self, new: DataFrame, batch_id: int, lifetime_us: int | None) -> None:
        """One micro-batch of fragments (keys, ``_us, _ord, _tok``)."""
        self.write(new, "arrived", batch_id)  # the source is read once
        new = self.read("arrived", batch_id)
        heads, pending = self.read("heads", batch_id - 1), self.read("pending", batch_id - 1)
        known = self._with_heads(new, heads)
        too_late = F.coalesce(F.col("closed") | (F.struct("_us", "_ord") <= F.struct("end_us", "end_ord")), F.lit(False))
        self.write(known.filter(too_late), "late", batch_id)
        fragments = known.filter(~too_late).select(*pending.columns).unionByName(pending)
        idx, windows = self._numbered(fragments, heads)
        each = idx.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_us").alias("_newest"))
        over = F.lit(False)
        if lifetime_us is not None:
            now = new.agg(F.max("_us")).first()[0]  # one number
            over = F.col("_newest") < F.lit((now or 0) - lifetime_us)
        each = each.withColumn("_over", over)
        right = each.select(*[F.col(k).alias(f"_e_{k}") for k in self.keys], "_n", "_newest", "_over")
        same = [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in self.keys]
        full = F.floor(F.col("_n") / self.size) * self.size
        placed = idx.join(right, on=same, how="inner")
        self.write(placed.filter((F.col("_tok_idx") >= full) & ~F.col("_over")), "pending", batch_id)
        done = windows.join(right, on=same, how="inner").filter((F.col("n_tokens") == self.size) | F.col("_over"))
        self.write(paced(done, self.keys), "windows", batch_id)
        # New heads: numbers and ends move on with the windows written.
        last = placed.filter((F.col("_tok_idx") < full) | F.col("_over")).groupBy(*self.keys).agg(F.max(F.struct("_us", "_ord")).alias("_end"))
        ends = last.select(*[F.col(k).alias(f"_l_{k}") for k in self.keys], "_end")
        moved = self._with_heads(each, heads).join(ends, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in self.keys], "left")
        written = F.when(F.col("_over"), F.ceil(F.col("_n") / self.size)).otherwise(F.floor(F.col("_n") / self.size))
        moved = moved.select(
            *self.keys, (F.coalesce("next_window", F.lit(0)) + written).alias("next_window"), F.coalesce("_end._us", "end_us").alias("end_us"),
            F.coalesce("_end._ord", "end_ord").alias("end_ord"), F.greatest("_newest", "newest_us").alias("newest_us"), F.col("_over").alias("closed"),
        )
        quiet = heads.join(right, [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in self.keys], "left_anti")
        self.write(moved.unionByName(quiet), "heads", batch_id)

    def result(self) -> DataFrame:
        """All windows so far, the partial ones at the end of open responses included."""
        last = self._last_batch()
        if last is None:
            return self.read("windows")
        _, partial = self._numbered(self.read("pending", last), self.read("heads", last))
        return self.read("windows").unionByName(paced(partial, self.keys))

    def _last_batch(self) -> int | None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/heads")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return max((int(n.partition("=")[2]) for n in names if n.startswith("batch_id=")), default=None)


def run_token_windows(
    stream: DataFrame,
    stream_cols: Sequence[str],
    ts_col: str,
    order_col: str,
    token_col: str,
    base_path: str,
    checkpoint_path: str,
    size: int = 50,
    lifetime_us: int | None = None,
) -> TokenWindows:
    """Count windows over everything the stream holds now; a later run goes on.

    Fragments of one response must come in time order from micro-batch to
    micro-batch; within one they are sorted.
    """
    spark = stream.sparkSession
    checkpoint_root(spark)
    keys = T.StructType([stream.schema[k] for k in stream_cols])
    tables = TokenWindows(spark, base_path, keys, size)
    rows = stream.select(
        *stream_cols, epoch_micros(stream, ts_col).alias("_us"), F.col(order_col).cast("long").alias("_ord"), F.col(token_col).cast("string").alias("_tok")
    )
    query = (
        rows.writeStream.foreachBatch(lambda batch, batch_id: tables.add(batch, batch_id, lifetime_us))
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return tables


class ProgressTable(StreamingQueryListener):
    """Progress of streaming queries as rows of a table (no outgoing HTTP).

    Register with ``spark.streams.addListener``. Each finished micro-batch is one
    row appended to the Parquet table at ``path``: query name, batch id, input rows,
    rows per second. Nothing is kept on the driver.
    """

    SCHEMA = "query STRING, batch_id LONG, input_rows LONG, rows_per_sec DOUBLE"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark_session, self.path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's listener API
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = [(p.name, p.batchId, p.numInputRows, float(p.processedRowsPerSecond or 0.0))]
        self.spark_session.createDataFrame(row, self.SCHEMA).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
