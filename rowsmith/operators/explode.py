"""Nested answers and pages into rows.

All of it is generator expressions (``posexplode``) inside one stage: no
shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_answer(
    df: DataFrame,
    answer: str,
    list_field: str,
    keep: Sequence[str],
    scalar_fields: Sequence[str] = (),
    prefix: str = "answer_",
    position: str = "linjenummer",
    defaults: dict | None = None,
) -> DataFrame:
    """one row per element of ``answer.list_field``, numbered from 1.

    Output: ``keep`` input columns, the answer's scalar fields (prefixed, because
    Spark names are case-insensitive and an input ``Kreditor`` would silently
    collide with an answer ``kreditor``), the element fields, and the position.
    An input column named like an element field or the position is replaced by
    it.
    An empty or null list gives no row; use :func:`unexploded` to list those.

    ``defaults`` (P9) maps a scalar field to the value used when it is null.
    ``from_json`` cannot tell an absent key from an explicit null, so the
    default covers both (the reference's ``dict.get`` covers only the first).
    """
    ans = F.col(answer)
    defaults = defaults or {}
    el_type = df.schema[answer].dataType[list_field].dataType.elementType
    # Element fields override same-named input columns, the position overrides
    # all (names compared case-insensitively, as Spark resolves them).
    taken = {f.name.lower() for f in el_type.fields} | {position.lower()}
    keep = [k for k in keep if k.lower() not in taken]
    base = df.select(
        *[F.col(k) for k in keep],
        *[(F.coalesce(ans[f], F.lit(defaults[f])) if f in defaults else ans[f]).alias(prefix + f) for f in scalar_fields],
        F.posexplode(ans[list_field]).alias("_pos", "_el"),
    )
    return base.select(
        *[F.col(k) for k in keep],
        *[F.col(prefix + f) for f in scalar_fields],
        *[F.col("_el")[f.name].alias(f.name) for f in el_type.fields],
        (F.col("_pos") + F.lit(1)).cast("int").alias(position),
    )


def unexploded(df: DataFrame, answer: str, list_field: str) -> DataFrame:
    """Rows whose answer list is null or empty (dead letters of F10)."""
    arr = F.col(answer)[list_field]
    return df.filter(arr.isNull() | (F.size(arr) == F.lit(0)))


def base_name(path: Column | str) -> Column:
    """last path segment without its extension (``a.b.pdf`` -> ``a.b``)."""
    return F.regexp_extract(_c(path), r"([^/]*?)(\.[^./]*)?$", 1)


def url_path(url: Column | str) -> Column:
    """The path part of a URL or file path: query string and fragment dropped."""
    return F.regexp_replace(_c(url), r"[?#].*$", "")


def split_pages(text: Column | str, separator: str = "\n") -> Column:
    """Stand-in page decoder: one page per line of text, as UTF-8 bytes.

    A real job passes a decoder Column (e.g. a pandas UDF around a PDF
    rasteriser) that maps document bytes to ``ARRAY<BINARY>``.
    """
    return F.transform(F.split(_c(text), separator, -1), lambda p: F.encode(p, "UTF-8"))


def page_explode(
    docs: DataFrame,
    id_col: str,
    pages: Column,
    keep: Sequence[str] = (),
    page_suffix: str = ".png",
) -> DataFrame:
    """F12 + W5: one row per page: ``(id, page_no from 1, page_name, content)``."""
    exploded = docs.select(
        F.col(id_col), *[F.col(k) for k in keep], F.posexplode(pages).alias("_pos", "content")
    )
    page_no = (F.col("_pos") + F.lit(1)).cast("int")
    return exploded.select(
        F.col(id_col),
        *[F.col(k) for k in keep],
        page_no.alias("page_no"),
        F.concat(F.col(id_col).cast("string"), F.lit("_"), page_no.cast("string"), F.lit(page_suffix)).alias(
            "page_name"
        ),
        F.col("content"),
    )
