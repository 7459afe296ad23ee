"""Reading the given tables and cutting lineage.

``written`` is the one way these operators cut lineage: a Parquet table in the
folder named by ``spark.checkpoint.dir`` (shared by driver and executors), so a
lost executor costs a task, not the stages before it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark only."""
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Rows of a small table that share a file, where the writer knows how many there are.
ROWS_PER_FILE = 40_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back with its schema.

    ``rows``, at most so many as the table has, keeps a table of few rows from being
    cut into a file for each shuffle partition.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fields(df: DataFrame, extra: str) -> T.StructType:
    """Schema of ``df`` followed by the fields of the DDL text ``extra``."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(extra).fields])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sliced(batches, rows: int = 1024):
    """Arrow batches cut to at most so many rows, which bounds what a worker holds beside them."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)
