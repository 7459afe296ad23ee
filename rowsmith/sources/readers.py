"""Table readers and writers (S1-S6), named-input union (S5, U1, P11), column
alignment (P5).

Formats are picked by the last suffix of the path, lower-cased. An unknown suffix
raises instead of returning nothing. CSV and JSON are read with an explicit schema
when one is given; schema inference is an ad-hoc convenience only.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("parquet", "csv", "json")


def format_of(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    if "." not in base:
        raise ValueError(f"no file suffix in {path!r}; expected one of {FORMATS}")
    ext = base.rsplit(".", 1)[1].lower()
    if ext == "jsonl":
        ext = "json"
    if ext not in FORMATS:
        raise ValueError(f"unsupported file type {ext!r} for {path!r}; expected one of {FORMATS}")
    return ext


def load_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read a table by its suffix (.parquet / .csv / .json).

    CSV is read one record per line, so large files are split over many tasks;
    ``multi_line`` allows line breaks inside quoted cells, at one task per file.
    """
    fmt = format_of(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line).option("escape", '"')
        if schema is None:
            reader = reader.option("inferSchema", True)
        return reader.csv(path)
    # JSON Lines: one record per line, splittable.
    return reader.json(path)


def _single_line(c: str) -> F.Column:
    broken = F.raise_error(F.lit(f"line break in column {c}: write this CSV with multi_line=True, and read it so"))
    return F.when(F.col(f"`{c}`").rlike(r"[\r\n]"), broken).otherwise(F.col(f"`{c}`")).alias(c)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", multi_line: bool = False) -> str:
    """Write by suffix. Unknown suffix raises (nothing is silently lost).

    A CSV cell with a line break cannot be read back line by line, so it stops
    the write unless ``multi_line`` says that readers will allow for it.
    """
    fmt = format_of(path)
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        if not multi_line:
            texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
            df = df.select(*[_single_line(c) if c in texts else F.col(f"`{c}`") for c in df.columns])
            writer = df.write.mode(mode)
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.option("ignoreNullFields", False).json(path)
    return path


def align_columns(df: DataFrame, like: DataFrame | T.StructType) -> DataFrame:
    """P5: add the columns of ``like`` that ``df`` lacks, as typed nulls.

    Existing columns keep their place; new ones go to the end in ``like`` order.
    """
    schema = like if isinstance(like, T.StructType) else like.schema
    have = {c.lower() for c in df.columns}
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name.lower() not in have]
    return df.select("*", *extra) if extra else df


def union_by_name(frames: Iterable[DataFrame], as_text_on_clash: bool = True) -> DataFrame:
    """Union all by column name, missing columns filled with null.

    Spark would cast a STRING side of an INT/STRING clash to a number and fail at
    run time, while pandas keeps both as objects. With ``as_text_on_clash`` every
    column whose type differs between inputs is turned to STRING first.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    if as_text_on_clash:
        seen: dict[str, T.DataType] = {}
        clash: set[str] = set()
        for f in frames:
            for fld in f.schema.fields:
                key = fld.name.lower()
                if key in seen and seen[key] != fld.dataType:
                    clash.add(key)
                seen.setdefault(key, fld.dataType)
        if clash:
            frames = [
                f.select(*[F.col(c).cast("string").alias(c) if c.lower() in clash else F.col(c) for c in f.columns])
                for f in frames
            ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_named_inputs(
    inputs: Mapping[str, DataFrame],
    exclude: Iterable[str] = (),
    source_col: str = "source_name",
    ordinal_col: str = "source_ordinal",
) -> DataFrame:
    """S5 + P11 + U1: many named inputs (sheets) into one table.

    Inputs named in ``exclude`` are left out. Each row keeps the name of its input
    and the input's position in the mapping, so input order survives the union
    without any global sort.
    """
    excluded = set(exclude)
    kept = [(i, name, df) for i, (name, df) in enumerate(inputs.items()) if name not in excluded]
    if not kept:
        raise ValueError("every input was excluded")
    tagged = [
        df.select("*", F.lit(name).alias(source_col), F.lit(i).cast("int").alias(ordinal_col)) for i, name, df in kept
    ]
    return union_by_name(tagged)


def scan_partitions(df: DataFrame) -> int | None:
    """Partitions of a plan that has no shuffle yet; None when it has one.

    Asking an adaptive (shuffling) plan for its RDD would run its shuffle
    stages on the spot, so such plans are not asked: their width is the
    shuffle's. A plan without a shuffle builds its RDD lazily (file listing
    only).
    """
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" or "Exchange" in plan.toString():
        return None
    return df.rdd.getNumPartitions()


def spread(df: DataFrame, min_partitions: int | None = None, run_rows: int = 1) -> DataFrame:
    """Round-robin an under-partitioned input over the cluster's cores.

    ``run_rows`` (a power of two) rows that follow each other stay together, for work
    that groups neighbours.

    A table stored as one file with one row group is read by one task, so any
    heavy per-row work (regexes over whole texts) would run on one core. When
    the input already has enough partitions (the large-table case), or comes
    out of a shuffle, nothing is added.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = scan_partitions(df)
    if n is not None and n < target:
        # Hash on the row's position in its split: no per-partition sort (a
        # round-robin repartition sorts every partition first), and the same
        # split always sends the same row to the same place on a retry.
        return df.repartition(target, F.shiftright(F.monotonically_increasing_id(), run_rows.bit_length() - 1))
    return df
