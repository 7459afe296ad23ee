"""Answers as VARIANT (F8, P9): absent against null, wrong types as such, bad JSON as such.

``answers.with_parsed_answer`` reads an answer with a schema, in which a missing key, a
null and a value of another type all end as null. Here the answer is parsed once into a
VARIANT, and every field says which of these it was.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a field can be.
VALUE, NULL, ABSENT, WRONG = "value", "null", "absent", "wrong type"

#: Kinds of JSON values (as ``schema_of_variant`` names them) that a wanted type takes.
_TAKES = {
    "string": r"^STRING$",
    "boolean": r"^BOOLEAN$",
    "int": r"^BIGINT$",
    "long": r"^BIGINT$",
    "double": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$",
    "variant": r"^(?!VOID)",
}


def variant_fields(text: Column, fields: Mapping[str, str]) -> tuple[Column, dict[str, Column], dict[str, Column]]:
    """Status, and value and state of each top-level field, of an answer that is already a column of its own.

    ``fields`` maps keys to ``string``, ``boolean``, ``int``, ``long``, ``double`` or
    ``variant`` (anything). Status: ``missing`` (no answer), ``empty`` (white space),
    ``bad json``, ``no object`` or ``ok``. A field of a sound object is a ``value``,
    ``null`` (the key is there with null), ``absent`` or of the ``wrong type`` (its value
    is null then); integers out of the type's range are of the wrong type.
    """
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(parsed)
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    status = (
        F.when(text.isNull(), F.lit("missing"))
        .when(F.trim(text) == "", F.lit("empty"))
        .when(parsed.isNull(), F.lit("bad json"))
        .when(~is_object, F.lit("no object"))
        .otherwise(F.lit("ok"))
    )
    values, states = {}, {}
    for key, wanted in fields.items():
        path = f"$[{key!r}]"
        own = F.try_variant_get(parsed, path, "variant")
        found = F.schema_of_variant(own)
        value = own if wanted == "variant" else F.try_variant_get(parsed, path, wanted)
        fits = found.rlike(_TAKES[wanted]) & value.isNotNull()
        states[key] = F.when(is_object, F.when(own.isNull(), F.lit(ABSENT)).when(F.is_variant_null(own), F.lit(NULL)).when(fits, F.lit(VALUE)).otherwise(F.lit(WRONG)))
        values[key] = F.when(is_object & fits, value)
    return status, values, states


def with_variant_answer(df: DataFrame, text_col: str, fields: Mapping[str, str], required: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """``df`` with ``status``, a column and a ``_state`` column for each field, and ``violations``.

    A violation names a field of the wrong type, and a required one that is absent or null.
    """
    text = F.col(f"`{text_col}`")
    status, values, states = variant_fields(text, fields)
    own = {f"{prefix}status", f"{prefix}violations", *[f"{prefix}{k}" for k in fields], *[f"{prefix}{k}_state" for k in fields]}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in own]
    staged = df.select(
        *kept, status.alias(f"{prefix}status"), *[v.alias(f"{prefix}{k}") for k, v in values.items()], *[s.alias(f"{prefix}{k}_state") for k, s in states.items()]
    )
    broken = [
        F.when(F.col(f"{prefix}{k}_state").isin(*([WRONG, ABSENT, NULL] if k in required else [WRONG])), F.concat(F.lit(f"{k}: "), F.col(f"{prefix}{k}_state"))) for k in fields
    ]
    return staged.withColumn(f"{prefix}violations", F.array_compact(F.array(*broken)))
