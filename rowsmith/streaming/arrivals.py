"""Documents as they arrive (S7, J2): a stream of files against a register.

A register row waits until a file with its id as base name comes. Every micro-batch of
files meets the rows still waiting, what is found is processed, and the results are one
save of the batch's own number (``saves.SavedTable``); so a document is read once, a
replayed batch replaces itself, and a file without a register row, or for a row already
read, is passed over. A later run with the same checkpoint reads the files that came since.

A file that comes before its register row is passed over as well: register first, or run
the missing rows over the folder with ``jobs.read_register``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.documents import first_by_base_name
from .resume import pending
from .saves import SavedTable


class Arrivals:
    """Results so far under ``path``, and what of the register still waits."""

    def __init__(self, spark: SparkSession, path: str, id_col: str, schema: T.StructType):
        self.table, self.id_col, self.schema = SavedTable(spark, path), id_col, schema

    def results(self) -> DataFrame:
        return self.table.read(self.schema)

    def waiting(self, register: DataFrame) -> DataFrame:
        """Register rows no file has come for; rows without an id wait for ever."""
        return pending(register, self.results(), [self.id_col])


def run_arrivals(
    register: DataFrame,
    id_col: str,
    files: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    result_path: str,
    checkpoint_path: str,
) -> Arrivals:
    """Everything that has arrived by now. ``files`` is a stream of ``path`` and ``content`` (``documents.stream_documents``).

    ``process`` gets register rows with ``doc_path`` and ``content`` and returns rows that
    keep ``id_col``; a row may become many, but not none, for then its document would
    count as not read. Of files with one base name in a batch the least path counts, of
    batches the first.
    """
    spark = register.sparkSession
    found_schema = T.StructType([*register.schema.fields, T.StructField("doc_path", T.StringType()), T.StructField("content", T.BinaryType())])
    out = Arrivals(spark, result_path, id_col, process(spark.createDataFrame([], found_schema)).schema)
    # The run is the checkpoint's, so that a batch that is replayed has the number it had.
    run = out.table.start(hashlib.sha1(checkpoint_path.encode()).hexdigest()[:12])

    def read(batch: DataFrame, number: int) -> None:
        done = out.table.read(out.schema, without=SavedTable.folder(run, number))
        first = first_by_base_name(batch.select("path"))  # names alone are grouped; contents follow by path
        waiting = pending(register, done, [id_col])
        named = waiting.join(first.withColumnRenamed("path", "doc_path"), waiting[id_col].cast("string") == first["base_name"]).drop("base_name")
        met = named.join(batch.select("path", "content"), F.col("doc_path") == F.col("path")).drop("path")
        out.table.save(process(met.select(*register.columns, "doc_path", "content")), run, number)

    query = files.writeStream.foreachBatch(read).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return out
