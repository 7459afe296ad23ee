"""Context built from related rows.

Invoice context: every line gets all lines of its invoice (same creditor and
invoice number), ordered by line number. The reference rescans the table per
row (O(n^2)); here the list is built once per invoice, by one aggregation that
lists an invoice of very many lines in many tasks before its lists meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prompts import json_item, nan_to_null
from .ordering import row_index


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_groups(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    fields: Mapping[str, Column | str],
    tie_breakers: Sequence[str] = (),
    list_col: str = "items",
) -> DataFrame:
    """A1 + O1: one row per key with the ordered list of ``fields`` structs.

    Sorted by ``order_col`` ascending with nulls last, then by ``tie_breakers``
    and then by every collected field, so ties have one fixed order. Rows with a
    null key are left out (a null key matches nothing).

    One plan for every size and one shuffle: each task lists its own rows of a key, and
    a key's lists meet and are sorted into its one value, which has to be in one place by
    its meaning. So a key with half of all rows is listed by many tasks and sends a row
    from each. Nothing is counted or sampled first and no key reaches the driver.
    """
    names = list(fields)
    rows = df.filter(_all_not_null(keys))
    item = _ordered_item(order_col, fields, tie_breakers)
    merged = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_sorted"))
    return merged.select(*keys, F.transform("_sorted", lambda x: F.struct(*[x[n].alias(n) for n in names])).alias(list_col))


def _ordered_item(order_col: str, fields: Mapping[str, Column | str], tie_breakers: Sequence[str]) -> Column:
    """A struct of ``fields`` that sorts by ``order_col``, nulls last, then by the tie breakers and by every field."""
    return F.struct(
        F.col(order_col).isNull().alias("_o_null"),
        F.col(order_col).alias("_o"),
        *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie_breakers)],
        *[_c(v).alias(k) for k, v in fields.items()],
    )


#: Input rows to a chunk (a power of two): the most lines that one request holds.
CHUNK_ROWS = 1 << 14


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def chunked(df: DataFrame, chunk_rows: int = CHUNK_ROWS, name: str = "_chunk") -> DataFrame:
    """``df`` with the number of the run of ``chunk_rows`` (a power of two) rows each row is in.

    A run lies within one partition. Rows of a key that stand together in the input
    mostly share a run; a hot key is spread over the runs of all partitions.
    """
    bits = chunk_rows.bit_length() - 1
    if chunk_rows != 1 << bits:
        raise ValueError("chunk_rows must be a power of two")
    return df.withColumn(name, F.shiftright(F.monotonically_increasing_id(), bits))


def invoice_context(
    lines: DataFrame,
    keys: Sequence[str],
    order_col: str,
    fields: Mapping[str, Column | str],
    tie_breakers: Sequence[str] = (),
    as_json: bool = True,
    context_col: str = "context",
) -> DataFrame:
    """Add the ordered invoice context to every line.

    With ``as_json`` the list is rendered as JSON text (F15), doubles as Python
    prints them and NaN as null; a line with a null key gets ``[]``. The list is
    built once per invoice (:func:`ordered_groups`) and joined back, where a hot
    invoice's lines may be split over many tasks. The result repeats the context on
    every line, by its meaning; a job that only sends it to a model uses
    :func:`context_requests`, which does not.
    """
    groups = invoice_groups(lines, keys, order_col, fields, tie_breakers, as_json)
    empty = F.lit("[]") if as_json else F.array().cast(groups.schema["_ctx"].dataType)
    right = groups.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_ctx")
    cond = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    joined = lines.join(right, on=cond, how="left")
    return joined.select(*[F.col(c) for c in lines.columns], F.coalesce(F.col("_ctx"), empty).alias(context_col))


def invoice_groups(
    lines: DataFrame, keys: Sequence[str], order_col: str, fields: Mapping[str, Column | str], tie_breakers: Sequence[str] = (), as_json: bool = True
) -> DataFrame:
    """One row per invoice: the keys and ``_ctx``, its ordered lines (JSON text or structs)."""
    if not as_json:
        return ordered_groups(lines, keys, order_col, _clean(lines, fields), tie_breakers, list_col="_ctx")
    listed = ordered_groups(lines, keys, order_col, _with_json(lines, fields), tie_breakers, list_col="_items")
    return listed.select(*keys, _json_list(F.col("_items")).alias("_ctx"))


def _clean(lines: DataFrame, fields: Mapping[str, Column | str]) -> dict[str, Column]:
    return {k: (nan_to_null(v) if _is_double(lines, v) else _c(v)) for k, v in fields.items()}


def _with_json(lines: DataFrame, fields: Mapping[str, Column | str]) -> dict[str, Column]:
    """The clean fields and each line as JSON text, rendered once; the context is a join of ready strings.

    The clean values go first, for they decide between lines that tie so far.
    """
    clean = _clean(lines, fields)
    return {**clean, "_json": json_item(clean, {k for k, v in fields.items() if _is_double(lines, v)})}


def _json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: x["_json"]), ","), F.lit("]"))


def invoice_requests(
    lines: DataFrame,
    keys: Sequence[str],
    order_col: str,
    fields: Mapping[str, Column | str],
    parts: Column,
    tie_breakers: Sequence[str] = (),
    invoices: DataFrame | None = None,
    slots: int | None = None,
) -> DataFrame:
    """``context_requests`` for invoices that fit a request, with one shuffle: of the bare lines, by invoice.

    Contexts and requests are made where an invoice's lines meet, so neither crosses a
    shuffle; ``slots`` tasks get an equal share of the invoices. ``invoices`` has all
    lines, where ``lines`` are only those to ask for; it is shuffled the same way.
    Lines with a null key are left out.
    """
    of = [f"_k{i}" for i in range(len(keys))]

    def dealt(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        return df.repartition(slots, *cols) if slots else df

    line = F.struct(F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias("row"), parts.alias("parts"))
    asked = dealt(lines.filter(_all_not_null(keys)), keys)
    if invoices is None:
        item = _ordered_item(order_col, _with_json(lines, fields), tie_breakers)
        met = asked.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_items"), F.collect_list(line).alias("lines"))
        return met.select(_json_list(F.col("_items")).alias("context"), "lines")
    used = dict.fromkeys([*keys, order_col, *tie_breakers, *[v for v in fields.values() if isinstance(v, str)]])
    item = _ordered_item(order_col, _with_json(invoices, fields), tie_breakers)
    rows = dealt(invoices.filter(_all_not_null(keys)).select(*used), keys)
    own = asked.select(*[F.col(k).alias(a) for k, a in zip(keys, of)], line.alias("_line"))
    same = [F.col(k) == F.col(a) for k, a in zip(keys, of)]
    listed = rows.join(own.select(*of).distinct(), same, "left_semi").groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    chunks = own.groupBy(*of).agg(F.collect_list("_line").alias("lines"))
    return chunks.join(listed, same, "left").select(_json_list(F.col("_items")).alias("context"), "lines")


def context_requests(lines: DataFrame, keys: Sequence[str], groups: DataFrame, parts: Column, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Requests for a model that sees an invoice's lines one by one, each with the whole invoice.

    One row per (invoice, chunk), with at most ``chunk_rows`` lines: ``context`` once,
    and ``lines``, an array of (``row``: all columns of the line, ``parts``: its prompt
    without the context, to be joined by it). So the sum of squares of the invoice
    sizes crosses neither a shuffle nor Arrow. A line with a null key is a request of
    its own, with an empty context.
    """
    line = F.struct(F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias("row"), parts.alias("parts"))
    has_key = _all_not_null(keys)
    keyed = chunked(lines.filter(has_key).select(*keys, line.alias("_line")), chunk_rows)
    chunks = keyed.groupBy(*keys, "_chunk").agg(F.collect_list("_line").alias("lines"))
    right = groups.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_ctx").alias("context"))
    cond = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    met = chunks.join(right, on=cond, how="left").select("context", "lines")
    return met.unionByName(keyless_requests(lines, keys, parts))


def keyless_requests(lines: DataFrame, keys: Sequence[str], parts: Column) -> DataFrame:
    """A request of its own, with an empty context, for each line with a null key."""
    line = F.struct(F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias("row"), parts.alias("parts"))
    return lines.filter(~F.coalesce(_all_not_null(keys), F.lit(False))).select(F.lit("[]").alias("context"), F.array(line).alias("lines"))


def _is_double(df: DataFrame, v: Column | str) -> bool:
    if not isinstance(v, str):
        return False
    return df.schema[v].dataType.typeName() in ("double", "float")


#: Turns to a chunk of a long conversation in :func:`running_history`.
HISTORY_CHUNK = 256


def running_history(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    message: Column | str,
    include: Column | None = None,
    name: str = "history",
    bounded: bool = False,
    chunk_rows: int = HISTORY_CHUNK,
) -> DataFrame:
    """For each row, the messages of its partition so far (itself included).

    ``include`` picks which rows contribute a message (e.g. user turns only);
    every row still gets the history up to itself. Null messages are left out.

    One plan for every size: rows are numbered (``row_index``, written once) and meet
    by (partition, chunk of ``chunk_rows`` rows). A chunk's messages are one list; the
    lists of the chunks before it are sent to it one by one and joined there, so
    a row's history is that list and the part of its own chunk's up to itself. A hot
    partition is spread over as many tasks as it has chunks; only the result is as
    large as its meaning. With ``bounded`` the caller knows partitions to be small
    (batches of fixed size), and each is one window.
    """
    msg = _c(message)
    if include is not None:
        msg = F.when(include, msg)
    if bounded:
        w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.collect_list(msg).over(w))
    keys, at = list(partition_by), "_rh_at"
    rows = row_index(df.withColumn("_rh_msg", msg), order_by, keys, name="_rh_at")
    rows = rows.withColumn("_rh_chunk", F.floor(F.col("_rh_at") / F.lit(chunk_rows)).cast("long"))
    item = F.struct("_rh_at", "_rh_msg")
    lists = rows.groupBy(*keys, "_rh_chunk").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["_rh_msg"]).alias("_rh_own"))

    def keyed(prefix: str, *more: Column) -> DataFrame:
        return lists.select(*[F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)], *more)

    def same(prefix: str, other: Sequence[str]) -> Column:
        return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(other)], F.lit(True))

    # A chunk asks for each list before it, so what meets in a task is one list or one chunk.
    chunk, to = F.col("_rh_chunk"), [f"_rh_t{i}" for i in range(len(keys))]
    asked = keyed("_rh_t", chunk.alias("_rh_to"), F.explode(F.when(chunk > 0, F.sequence(F.lit(0).cast("long"), chunk - 1))).alias("_rh_from"))
    given = keyed("_rh_g", chunk.alias("_rh_no"), F.filter("_rh_own", lambda m: m.isNotNull()).alias("_rh_list"))
    met = asked.join(given, same("_rh_g", to) & (F.col("_rh_from") == F.col("_rh_no"))).groupBy(*to, "_rh_to")
    before = met.agg(F.sort_array(F.collect_list(F.struct("_rh_from", "_rh_list"))).alias("_rh_parts"))
    before = before.select(*to, "_rh_to", F.flatten(F.transform("_rh_parts", lambda x: x["_rh_list"])).alias("_rh_before"))
    own = keyed("_rh_o", chunk.alias("_rh_of"), F.col("_rh_own"))
    out = rows.join(own, same("_rh_o", keys) & (chunk == F.col("_rh_of"))).join(before, same("_rh_t", keys) & (chunk == F.col("_rh_to")), "left")
    upto = F.slice("_rh_own", F.lit(1), (F.col("_rh_at") - chunk * F.lit(chunk_rows) + 1).cast("int"))
    upto = F.filter(upto, lambda m: m.isNotNull())
    history = F.when(F.col("_rh_before").isNull(), upto).otherwise(F.concat("_rh_before", upto))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], history.alias(name))
