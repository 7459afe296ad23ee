"""Resumable runs.

The reference rewrites the whole finished prefix of the table every n rows and
resumes by row position. Here results are keyed, append-only and committed in
units Spark already makes atomic:

* keyed form (``run_resumable``): the work list is the input anti-joined with
  the keys already in the result table (``saves.SavedTable``); it is written as
  files of whole saves and read back by one Structured Streaming query, whose
  micro-batches are the commits, so a crash loses at most the one in flight and
  never writes a row twice;
* stream form (``run_stream``): Structured Streaming over a landing folder;
  each micro-batch goes through ``foreachBatch`` into its own ``batch_id=N``
  folder in overwrite mode, so a replayed batch (after a crash between write
  and checkpoint commit) replaces itself instead of duplicating;
* exploded results (one input row -> many or zero output rows) keep a marker
  row for an input without output rows, so the result table itself records
  every processed input key in the same atomic write.

All paths live under the shared checkpoint folder (``session.scratch_path``),
never on a machine-local disk.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import row_index
from ..session import scratch_path, shuffles_freed
from .saves import PLACE, SavedTable

Process = Callable[[DataFrame], DataFrame]


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a committed data file lies under ``path``.

    A run that died in its first write leaves the folder with ``_temporary`` in it:
    that is no result yet.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if not status.isDirectory() or has_data(spark, status.getPath().toString()):
            return True
    return False


def read_done(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The result table written so far, or None when nothing is committed.

    A table of saves comes with the columns of all of them, those of ``schema`` first;
    a plain Parquet folder is read as it is.
    """
    table = SavedTable(spark, path)
    if table.exists():
        return table.read(*([schema] if schema is not None else [])) if table.saves() else None
    if not has_data(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The result table; an empty one when there is nothing."""
    done = read_done(spark, path, schema)
    return spark.createDataFrame([], schema) if done is None else done


def pending(input_df: DataFrame, done: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Input rows whose key is not in ``done`` (left anti join on the keys)."""
    if done is None:
        return input_df
    return input_df.join(done.select(*keys), on=list(keys), how="left_anti")


def run_resumable(
    spark: SparkSession,
    input_df: DataFrame,
    keys: Sequence[str],
    process: Process,
    result_path: str,
    save_every: int | None = None,
    report: Callable[[int], None] | None = None,
) -> DataFrame:
    """S8 + S9 + J3 + U2: process what is not yet in ``result_path``, append it.

    ``save_every`` is how many rows may be lost at least before a save (the "save every
    n rows" of the reference, without rewriting earlier rows); without it the work is one
    save. The work list is cut in key order into runs of so many rows and read as a
    stream, a micro-batch for each run or, of very many, for several together: at most
    ``MAX_COMMITS`` micro-batches, each one job over all cores, however small ``save_every``
    is. Progress is kept for each ``save_every`` rows all the same, with their errors.
    ``report`` is called with the rows of this run done so far, for each ``save_every`` of
    them, after their commit.

    The result keeps every column of every run (``SavedTable``): a column that this run's
    stage has and earlier ones had not is null in their rows, and the other way round;
    types are widened, or refused by name before any work is done. Returns the whole
    result table, an empty one for an empty input. One writer per result path: two runs
    at the same time would both see the same work list.
    """
    result_schema = process(input_df.limit(0)).schema
    saved = SavedTable(spark, result_path)
    saved.schema(result_schema)  # raises on a clash
    todo = pending(input_df, read_done(spark, result_path, result_schema), keys)
    run = saved.start()
    done = [0]

    def save(part: DataFrame, number: int, rows: int | None = None, places: DataFrame | None = None) -> None:
        before, done[0] = done[0], saved.save(process(part), run, number, done[0], rows, save_every, places).rows_done
        if report is not None:
            for passed in range(before + (save_every or 0), done[0], save_every) if places is not None else ():
                report(passed)
            report(done[0])

    def commit(part: DataFrame, number: int) -> None:
        save(part.drop(PLACE), number, sum(sizes[number]), part.select(*keys, PLACE))

    if not save_every:
        save(todo, 0)
        return saved.read(result_schema)
    work = work_list(todo, keys, save_every)
    if work is None:
        return saved.read(result_schema)
    path, sizes = work
    schema = T.StructType([*todo.schema.fields, T.StructField(PLACE, T.LongType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", len(sizes[0])).parquet(path)
    query = (
        stream.writeStream.foreachBatch(commit)
        .option("checkpointLocation", f"{path}-offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"run failed: {query.exception()}")
    delete_results(spark, path)
    delete_results(spark, f"{path}-offsets")
    return saved.read(result_schema)


#: Most commits of one run.
MAX_COMMITS = 12


def work_list(todo: DataFrame, keys: Sequence[str], save_every: int) -> tuple[str, list[list[int]]] | None:
    """The rows to do as files in key order; the folder, and the rows of each file by commit. None: nothing to do.

    A commit is ``save_every`` rows, or so many times that as keeps the run within
    ``MAX_COMMITS``. Its rows are dealt over up to as many files as there are cores, each
    of whole saves. All files but the last have the same number of rows. A file source
    reads files by their time, so times are set in the order of the keys, where the file
    system lets them be set; elsewhere commits are the same rows in another order.
    """
    spark = todo.sparkSession
    path = scratch_path(spark, "work-list")
    sorted_at = scratch_path(spark, "work-order")
    numbered = row_index(todo, list(keys), name=PLACE, path=sorted_at)  # kept there, so it is read twice at no cost
    total = spark.read.parquet(sorted_at).count()  # from the footers
    if not total:
        return None
    saves = -(-total // save_every)
    together = -(-saves // MAX_COMMITS)
    per_file = save_every * -(-together // spark.sparkContext.defaultParallelism)
    files_a_commit = -(-together * save_every // per_file)
    files = -(-total // per_file)
    width = min(files, max(1, spark.sparkContext.defaultParallelism))
    # Whole files go to a task, the same number to each but for one, in the order of the keys.
    task = F.floor(F.floor(F.col(PLACE) / per_file) * width / files).cast("int")
    dealt = numbered.withColumn("_task", task).repartitionById(width, "_task").drop("_task").sortWithinPartitions(PLACE)
    with shuffles_freed(spark):
        dealt.write.option("maxRecordsPerFile", per_file).parquet(path)
    delete_results(spark, sorted_at)
    _order_by_name(spark, path)
    sizes = [min(per_file, total - k * per_file) for k in range(files)]
    return path, [sizes[k : k + files_a_commit] for k in range(0, files, files_a_commit)]


def _order_by_name(spark: SparkSession, path: str) -> None:
    """Sets the times of the files under ``path`` a second apart, by part and number."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]

    def place(p) -> tuple[int, int]:
        found = re.match(r"part-(\d+)-.*-c(\d+)", p.getName())  # greedy: the id between may hold such a piece itself
        return int(found[1]), int(found[2])

    start = int(time.time() * 1000) - 1000 * len(files)
    for k, p in enumerate(sorted(files, key=place)):
        fs.setTimes(p, start + 1000 * k, -1)


def run_resumable_exploded(
    spark: SparkSession,
    input_df: DataFrame,
    keys: Sequence[str],
    process: Process,
    list_col: str,
    result_path: str,
    position: str = "position",
    save_every: int | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """``run_resumable`` for one-to-many results.

    ``process`` returns one row per input row with the answers in the array
    ``list_col``. The explode happens here with ``posexplode_outer``, so an input
    row with an empty or null list still writes one marker row (null position):
    output rows and done keys land in the same atomic append, and the work list
    of the next run is the input anti-joined with every key in the table.
    Returns the exploded rows, positions from 1; of the markers only those that ``keep``
    holds for (failed inputs, say).
    """

    def exploded(part: DataFrame) -> DataFrame:
        nested = process(part)
        other = [c for c in nested.columns if c != list_col]
        flat = nested.select(*other, F.posexplode_outer(list_col).alias("_pos", "_el"))
        el_type = nested.schema[list_col].dataType.elementType
        return flat.select(
            *other,
            *[F.col("_el")[f.name].alias(f.name) for f in el_type.fields],
            (F.col("_pos") + F.lit(1)).cast("int").alias(position),
        )

    shown = F.col(position).isNotNull() if keep is None else F.col(position).isNotNull() | keep
    return run_resumable(spark, input_df, keys, exploded, result_path, save_every).filter(shown)


def run_stream(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    process: Process,
    result_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1,
    fmt: str = "parquet",
) -> DataFrame:
    """Resumable micro-batches over a landing folder.

    ``trigger(availableNow=True)`` processes every file present now, in
    micro-batches of ``max_files_per_trigger`` files, then stops; a later run
    with the same ``checkpoint_path`` continues with only the new files. Each
    batch is written to ``result_path/batch_id=N`` (overwrite: replays are
    idempotent). Returns the whole result table, an empty one when no file came.
    """
    result_schema = process(spark.createDataFrame([], schema)).schema

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{result_path}/batch_id={batch_id}")

    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", "true")
        .load(source_path)
    )
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return read_result(spark, result_path, T.StructType([*result_schema.fields, T.StructField("batch_id", T.IntegerType())]))


def delete_results(spark: SparkSession, path: str) -> bool:
    """Remove a result/checkpoint folder after the final output is safely
    written (a job-level clean-up step, off unless the job asks for it)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True)) if fs.exists(hpath) else False
