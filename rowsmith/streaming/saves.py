"""A result table that grows save by save, and whose columns may grow with it.

Each save is a folder of its own. It counts once its entry lies in ``_saves``: a small
JSON file with the folder, its schema, and how many rows and errors it has, written after
the data and put in place by a rename. A folder without an entry is what a crash left and
is never read. So a run whose stage gained or lost a column, or whose types grew, saves
next to the earlier ones:

* a column that a save lacks is null in its rows (inside structs and lists as well);
* types are widened where no value can be lost: integers to longer ones or, up to 32
  bits, to double, float to double, decimals to more digits, anything from void;
* any other pair of types is refused by the column's name, before any work is done.

Entries are read by the driver, one for each save of the table (``resume`` bounds how many
a run makes); rows never are. A save that holds several steps of a run (the "save every n
rows" of ``resume``) says of how many rows they are, and has a small table of their errors
beside it, under ``_errors``: progress is told by step, however many steps go into a save.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_freed

#: The place of an input row in the order of its run, from 0 on.
PLACE = "_rs_place"

_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


class SchemaClash(TypeError):
    """Two saves hold a column in types of which neither takes in the other."""


def widened(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The type that holds every value of both, or ``SchemaClash`` with the column's name."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    kinds = {type(a), type(b)}
    if kinds <= {T.FloatType, T.DoubleType} or (T.DoubleType in kinds and kinds & {T.ByteType, T.ShortType, T.IntegerType}):
        return T.DoubleType()
    if kinds == {T.DecimalType}:
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        if scale + whole <= 38:
            return T.DecimalType(scale + whole, scale)
    if kinds == {T.StructType}:
        return merged([a, b], f"{name}.")
    if kinds == {T.ArrayType}:
        return T.ArrayType(widened(a.elementType, b.elementType, f"{name}[]"))
    if kinds == {T.MapType}:
        return T.MapType(widened(a.keyType, b.keyType, f"{name} (key)"), widened(a.valueType, b.valueType, f"{name} (value)"))
    raise SchemaClash(f"column {name}: {a.simpleString()} here, {b.simpleString()} in another save; neither holds the other")


def merged(schemas: Iterable[T.StructType], prefix: str = "") -> T.StructType:
    """Every column of the schemas once (names in any case), in order of first sight, with widened types."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = fields.get(f.name.lower())
            kind = f.dataType if seen is None else widened(seen.dataType, f.dataType, f"{prefix}{seen.name}")
            fields[f.name.lower()] = T.StructField(f.name if seen is None else seen.name, kind, True)
    return T.StructType(list(fields.values()))


def _conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as the wider ``want``."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [
            (_conformed(value[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _conformed(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keys = F.transform_keys(value, lambda k, v: _conformed(k, have.keyType, want.keyType))
        return F.transform_values(keys, lambda k, v: _conformed(v, have.valueType, want.valueType))
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: null where it has none (P5), widened where it is narrower."""
    have = {f.name.lower(): f for f in df.schema.fields}
    return df.select(
        *[
            (_conformed(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


@dataclass(frozen=True)
class Save:
    """One entry: ``rows_done`` counts the rows of its run up to and with this save.

    ``step`` is how many input rows a step has, where the save holds several of them.
    """

    folder: str
    schema: T.StructType
    rows: int
    errors: int
    run: str
    rows_done: int
    saved_at: float
    step: int | None = None


class SavedTable:
    """The saves under ``path``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._text = lambda stream: jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")

    def exists(self) -> bool:
        return self._fs.exists(self._path("_saves"))

    def saves(self) -> list[Save]:
        """All saves, oldest first."""
        if not self.exists():
            return []
        out = []
        for status in self._fs.listStatus(self._path("_saves")):
            if not status.getPath().getName().endswith(".json"):
                continue
            stream = self._fs.open(status.getPath())
            try:
                entry = json.loads(self._text(stream))
            finally:
                stream.close()
            out.append(Save(**{**entry, "schema": T.StructType.fromJson(entry["schema"])}))
        return sorted(out, key=lambda s: (s.saved_at, s.folder))

    def schema(self, *more: T.StructType) -> T.StructType:
        """Columns of ``more`` and then of all saves; raises on types that clash."""
        return merged([*more, *[s.schema for s in self.saves()]])

    @staticmethod
    def folder(run: str, number: int) -> str:
        return f"save-{run}-{number:06d}"

    def read(self, *more: T.StructType, without: str | None = None) -> DataFrame:
        """All rows saved, but for the save in the folder ``without``, with the columns of ``more`` first; an empty table when there is none."""
        saves, schema = [s for s in self.saves() if s.folder != without], self.schema(*more)
        kinds: dict[str, list[Save]] = {}
        for s in saves:
            kinds.setdefault(s.schema.json(), []).append(s)
        out = self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(g[0].schema).parquet(*[f"{self.path}/{s.folder}" for s in g]) for g in kinds.values()]
        for i, part in enumerate(parts):
            part = conform(part, schema)
            out = part if i == 0 else out.unionByName(part)
        return out

    def start(self, run: str | None = None) -> str:
        """The name of a run, a new one without ``run``."""
        self._fs.mkdirs(self._path("_saves"))
        return run or uuid.uuid4().hex[:12]

    def save(
        self, df: DataFrame, run: str, number: int, rows_before: int = 0, input_rows: int | None = None, step: int | None = None, places: DataFrame | None = None
    ) -> Save:
        """Write ``df`` and put its entry in place; a save of the same run and number is replaced.

        Rows and errors (of an ``error`` column) are counted while the rows are written.
        ``rows_done`` goes on by ``input_rows``, by the rows written without it. With
        ``step``, of which the input rows are several, errors are told by step as well:
        ``places`` has the keys of the input rows, which ``df`` has too, and the ``PLACE``
        of each.
        """
        folder = self.folder(run, number)
        errors = F.count("error") if "error" in df.columns else F.count(F.lit(None))
        seen = Observation()
        with shuffles_freed(df.sparkSession):
            df.observe(seen, F.count(F.lit(1)).alias("rows"), errors.alias("errors")).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        rows, n_errors = (seen.get.get(k, 0) for k in ("rows", "errors"))
        done = rows_before + (rows if input_rows is None else input_rows)
        steps = step is not None and done - rows_before > step
        if steps and n_errors:
            self._errors_by_step(folder, df.schema, places, step, rows_before // step, (done - 1) // step)
        entry = Save(folder, df.schema, rows, n_errors, run, done, time.time(), step if steps else None)
        text = json.dumps({**entry.__dict__, "schema": entry.schema.jsonValue()})
        hidden, final = self._path("_saves", f".{folder}.tmp"), self._path("_saves", f"{folder}.json")
        stream = self._fs.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(final):
            self._fs.delete(final, False)
        if not self._fs.rename(hidden, final):
            raise OSError(f"could not put {final} in place")
        return entry

    def _errors_by_step(self, folder: str, schema: T.StructType, places: DataFrame, step: int, first: int, last: int) -> None:
        """The table of (``step``, ``errors``) of a save of the steps ``first`` to ``last``: its failed rows meet the places of their keys.

        Where several input rows have one key, its errors are dealt evenly over their places.
        """
        keys = [c for c in places.columns if c != PLACE]
        failed = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").filter(F.col("error").isNotNull())
        failed = failed.groupBy(*[F.col(f"`{k}`").alias(f"_f{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
        # Where rows of a key stand: how many in each step, and how many before it.
        own = [F.col(f"`{k}`").alias(f"_p{i}") for i, k in enumerate(keys)]
        names = [f"_p{i}" for i in range(len(keys))]
        at = F.least(F.greatest(F.floor(F.col(PLACE) / F.lit(step)).cast("long"), F.lit(first)), F.lit(last)).cast("long")
        there = places.select(*own, at.alias("step")).groupBy(*names, "step").agg(F.count(F.lit(1)).alias("_m"))
        along = Window.partitionBy(*names)
        upto = F.sum("_m").over(along.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        there = there.withColumn("_upto", upto).withColumn("_all", F.sum("_m").over(along))
        met = there.join(failed, reduce(and_, [F.col(f"_p{i}").eqNullSafe(F.col(f"_f{i}")) for i in range(len(keys))]))
        share = lambda rows: F.floor(F.col("_n") * rows / F.col("_all"))
        counted = met.groupBy("step").agg(F.sum(share(F.col("_upto")) - share(F.col("_upto") - F.col("_m"))).alias("errors"))
        counted.select("step", F.col("errors").cast("long")).write.mode("overwrite").parquet(f"{self.path}/_errors/{folder}")

    def progress(self, every: int | None = None) -> DataFrame:
        """``rows_done``, ``errors`` and ``message`` of every step so far, also while its run goes on.

        A save is one step, or as many as it says. With ``every`` there is a row for each
        multiple of so many rows passed instead, with the errors up to the step that passed it.
        """
        entries, errors, before, tables = [], {}, {}, []
        for s in self.saves():
            sofar = errors.get(s.run, 0)
            errors[s.run] = sofar + s.errors
            entries.append((s.folder, before.get(s.run, 0), s.rows_done, s.step, sofar, errors[s.run]))
            before[s.run] = s.rows_done
            if s.step is not None and s.errors:
                tables.append(s.folder)
        saves = self.spark.createDataFrame(entries, "folder STRING, first LONG, last LONG, step LONG, sofar LONG, errors LONG")
        steps = F.when(F.col("step").isNotNull(), F.sequence(F.floor(F.col("first") / F.col("step")), F.floor((F.col("last") - 1) / F.col("step"))))
        out = saves.filter("step is null").select(F.col("first").alias("before"), F.col("last").alias("rows_done"), "errors")
        told = saves.select("folder", "first", "last", F.col("step").alias("size"), "sofar", F.explode(steps).alias("step"))
        found = self.spark.createDataFrame([], "step LONG, errors LONG, folder STRING")
        if tables:
            found = self.spark.read.schema("step LONG, errors LONG").parquet(*[f"{self.path}/_errors/{t}" for t in tables])
            found = found.select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("folder"))
        along = Window.partitionBy("folder").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        told = told.join(found, ["folder", "step"], "left").withColumn("errors", F.col("sofar") + F.coalesce(F.sum("errors").over(along), F.lit(0)))
        ends = F.least((F.col("step") + 1) * F.col("size"), "last")
        out = out.unionByName(told.select(F.greatest(F.col("step") * F.col("size"), "first").alias("before"), ends.alias("rows_done"), "errors"))
        if every is not None:
            first = (F.floor(F.col("before") / every) + 1) * F.lit(every)
            marks = F.when(first <= F.col("rows_done"), F.sequence(first, F.col("rows_done"), F.lit(every).cast("long")))
            out = out.select(F.explode(marks).alias("rows_done"), "errors")
        return out.select("rows_done", "errors", F.format_string("Row: %d", "rows_done").alias("message"))
