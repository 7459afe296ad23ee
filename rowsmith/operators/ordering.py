"""Row positions without a single-task window.

``row_number() over (partition by g order by k)`` sends each group to one task;
with a handful of groups (a status, a source, an event type) that is a handful
of tasks however big the cluster. ``row_index`` gives the same numbers with
full parallelism:

1. range-partition on ``(group, order)`` into a fixed number of partitions
   and sort within partitions (one shuffle, every task busy, a hot group
   spread over many partitions);
2. tag rows with ``monotonically_increasing_id`` = partition << 33 | position
   and checkpoint them (reliable, shared folder), so the two reads below see
   one fixed set of partitions and ids;
3. count rows per (partition, group) - a tiny table - and turn the counts into
   starting offsets with a window over that tiny table;
4. index = offset + position of the row within its group's run in the partition.

The order should be total (add tie-breakers) so that the numbering itself is
deterministic from run to run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    name: str = "row_id",
    path: str | None = None,
) -> DataFrame:
    """0-based position of each row by ``order_by`` within ``partition_by``.

    Names in ``order_by`` sort ascending with nulls first; pass a sort Column
    (``F.col(x).desc()``) for anything else. With ``path`` the sorted rows are kept there
    as Parquet, which takes less disk than a checkpoint and which the caller may delete.
    """
    groups = list(partition_by)
    sort_keys = [F.col(g).asc_nulls_first() for g in groups] + [
        F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by
    ]
    from ..session import checkpoint_root, written

    spark = df.sparkSession
    checkpoint_root(spark)  # the shared folder (created only in tests)
    setting = str(spark.conf.get("spark.sql.shuffle.partitions"))  # no default here: Spark has its own, and checks one that is given
    n = int(setting) if setting.isdigit() and int(setting) > 0 else spark.sparkContext.defaultParallelism
    ranged = df.repartitionByRange(n, *sort_keys).sortWithinPartitions(*sort_keys)
    # The tagged rows are read twice (counts, then positions). Materialising
    # them once makes both reads see the same partitions and ids: recomputing
    # would re-sample the range bounds from input whose row order may differ
    # (after a shuffle, or after an executor loss).
    tagged = ranged.withColumn("_rs_mid", F.monotonically_increasing_id()).withColumn(
        "_rs_pid", F.shiftright(F.col("_rs_mid"), 33)
    )
    tagged = tagged.checkpoint(eager=True) if path is None else written(tagged, path=path)
    stats = tagged.groupBy("_rs_pid", *groups).agg(
        F.min("_rs_mid").alias("_rs_first"), F.count(F.lit(1)).alias("_rs_n")
    )
    before = Window.partitionBy(*groups).orderBy("_rs_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        F.col("_rs_pid").alias("_rs_opid"),
        *[F.col(g).alias(f"_rs_g{i}") for i, g in enumerate(groups)],
        "_rs_first",
        F.coalesce(F.sum("_rs_n").over(before), F.lit(0)).alias("_rs_off"),
    )
    cond = [F.col("_rs_pid") == F.col("_rs_opid")] + [F.col(g).eqNullSafe(F.col(f"_rs_g{i}")) for i, g in enumerate(groups)]
    # Without groups there is a row of offsets for each partition at most, so the rows need not move to meet them.
    joined = tagged.join(offsets if groups else F.broadcast(offsets), on=cond, how="inner")
    idx = F.col("_rs_off") + (F.col("_rs_mid") - F.col("_rs_first"))
    return joined.select(*[F.col(c) for c in df.columns], idx.alias(name))


def every_nth(df: DataFrame, index_col: str, n: int) -> DataFrame:
    """P10: keep rows whose 1-based position is a multiple of ``n``."""
    if n <= 0:
        raise ValueError("n must be positive")
    return df.filter((F.col(index_col) + F.lit(1)) % F.lit(n) == F.lit(0))


def file_ordered(spark, path: str, name: str = "row_id", schema=None) -> DataFrame:
    """The rows of a Parquet table with their position in file order: by file name, then as they lie in the file.

    No sort and no key: a row knows its file and its place there (``_metadata``), and the
    rows before a file come from a table of one row a file. The position is the same in
    every run, and reading stays as parallel as the scan is.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("_fo_file"), F.col("_metadata.row_index").alias("_fo_at"))
    # Column pruning leaves nothing but the metadata to this read. One row a file; summed up
    # along the names in ranges, as ``row_index`` does, so that millions of files are no one task's.
    counts = rows.groupBy(F.col("_metadata.file_path").alias("_fo_of")).agg((F.max("_metadata.row_index") + 1).alias("_fo_n"))
    from ..session import checkpoint_root

    checkpoint_root(spark)
    ranged = counts.repartitionByRange(spark.sparkContext.defaultParallelism, "_fo_of").withColumn("_rs_pid", F.spark_partition_id()).checkpoint(eager=True)
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_rs_pid").agg(F.sum("_fo_n").alias("_fo_n"))
    ranges = sums.select(F.col("_rs_pid").alias("_rs_opid"), F.coalesce(F.sum("_fo_n").over(upto.orderBy("_rs_pid")), F.lit(0)).alias("_fo_range"))
    within = F.coalesce(F.sum("_fo_n").over(upto.partitionBy("_rs_pid").orderBy("_fo_of")), F.lit(0))
    starts = ranged.select("_fo_of", "_rs_pid", within.alias("_fo_in")).join(ranges, F.col("_rs_pid") == F.col("_rs_opid"))
    starts = starts.select("_fo_of", (F.col("_fo_range") + F.col("_fo_in")).alias("_fo_start"))
    joined = placed.join(starts, F.col("_fo_file") == F.col("_fo_of"))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns if c != name], (F.col("_fo_start") + F.col("_fo_at")).alias(name))


def file_ordered_union(spark, paths: dict[str, str], name: str = "row_id", source_col: str = "source_name", ordinal_col: str = "source_ordinal") -> DataFrame:
    """Many Parquet inputs as one table in input order, then file order, with one index over all.

    Missing columns are null (``readers.union_by_name``). The sizes of the inputs are one
    number each.
    """
    from ..sources.readers import union_by_name

    frames, before = [], 0
    for i, (source, path) in enumerate(paths.items()):
        rows = file_ordered(spark, path, name)
        frames.append(rows.withColumn(name, F.col(name) + F.lit(before)).select("*", F.lit(source).alias(source_col), F.lit(i).cast("int").alias(ordinal_col)))
        before += spark.read.parquet(path).count()  # from the footers
    return union_by_name(frames)
