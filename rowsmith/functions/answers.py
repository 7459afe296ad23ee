"""Model answers into typed columns.

Answers are parsed JVM-side with ``from_json``. Integer fields are read as
DOUBLE first and turned to INT only when whole, because ``from_json`` with an
INT field nulls both ``7.5`` and ``2.0`` while ``json.loads`` keeps them. Every
deviation from the declared schema lands in a ``violations`` array instead of
failing the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label rules of the reference's label adjuster, in order.
# lower-cased label contains "mat"  -> "Materialeindkøb"
# lower-cased label contains "tjen" -> "Tjenesteydelse"
# anything else (not null)          -> "Ukendt"
DEFAULT_LABEL_RULES: tuple[tuple[str, str], ...] = (("mat", "Materialeindkøb"), ("tjen", "Tjenesteydelse"))
DEFAULT_LABEL_FALLBACK = "Ukendt"

CORRUPT = "_corrupt"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class AnswerSchema:
    """A flat answer schema: ``(name, kind)`` with kind in str / int / float."""

    fields: tuple[tuple[str, str], ...]

    @staticmethod
    def of(*fields: tuple[str, str]) -> AnswerSchema:
        for _, kind in fields:
            if kind not in ("str", "int", "float"):
                raise ValueError(f"unknown field kind {kind!r}")
        return AnswerSchema(tuple(fields))

    def raw_struct(self) -> T.StructType:
        kinds = {"str": T.StringType(), "int": T.DoubleType(), "float": T.DoubleType()}
        return T.StructType(
            [T.StructField(n, kinds[k]) for n, k in self.fields] + [T.StructField(CORRUPT, T.StringType())]
        )

    def ddl(self) -> str:
        kinds = {"str": "STRING", "int": "INT", "float": "DOUBLE"}
        return ", ".join(f"`{n}` {kinds[k]}" for n, k in self.fields)


# Answer schemas of the reference jobs (field names are part of the contract).
PURCHASE_SIMPLE = AnswerSchema.of(("label", "str"), ("reason", "str"), ("secure", "int"))
PURCHASE_ADVANCED = AnswerSchema.of(
    ("label", "str"), ("reason_for", "str"), ("reason_against", "str"), ("secure", "int")
)
PURCHASE_SMALL = AnswerSchema.of(("label", "str"), ("secure", "int"))
CLASSIFICATION = AnswerSchema.of(("label", "str"), ("reason", "str"))

INVOICE_LINE_DDL = "fakturalinje_beskrivelse STRING, antal DOUBLE, `linje_beløb` DOUBLE"
INVOICE_DDL = f"kreditor STRING, fakturalinjer ARRAY<STRUCT<{INVOICE_LINE_DDL}>>, secure DOUBLE, {CORRUPT} STRING"
BOOKS_DDL = f"books ARRAY<STRUCT<title STRING, author STRING, year DOUBLE, stars DOUBLE>>, {CORRUPT} STRING"

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # json.loads rejects single quotes; keep Spark as strict.
    "allowSingleQuotes": "false",
}


def whole_int(d: Column) -> Column:
    """DOUBLE -> INT when whole and finite, else null."""
    ok = d.isNotNull() & ~F.isnan(d) & (d == F.floor(d)) & (F.abs(d) <= F.lit(2147483647.0))
    return F.when(ok, d.cast("int"))


def parse_answer(text: Column | str, schema: AnswerSchema) -> Column:
    """F8 + F9: answer text -> struct of typed fields plus ``status`` and ``violations``.

    status: ``ok``; ``missing`` (null answer: the call failed); ``empty`` (blank
    text); ``invalid`` (not a JSON object: bad, cut off, fenced, array, ``null``).
    On anything but ``ok`` every field is null (the reference's default answer).

    As a single Column this repeats the parse inside the expression tree; in a
    DataFrame use :func:`with_parsed_answer`, which parses once per row.
    """
    t = _c(text)
    return typed_answer(t, F.from_json(t, schema.raw_struct(), JSON_OPTIONS), schema)


def with_parsed_answer(df: DataFrame, text_col: str, schema: AnswerSchema, name: str = "answer") -> DataFrame:
    """Add ``name`` = :func:`parse_answer` of ``text_col``, parsing each row once.

    The raw ``from_json`` result is its own projected column, so Catalyst keeps
    one parse and reads its fields, instead of inlining the parse into every
    field expression.
    """
    raw = df.withColumn("_raw_answer", F.from_json(F.col(text_col), schema.raw_struct(), JSON_OPTIONS))
    out = raw.withColumn(name, typed_answer(F.col(text_col), F.col("_raw_answer"), schema))
    return out.drop("_raw_answer")


def typed_answer(t: Column, raw: Column, schema: AnswerSchema) -> Column:
    blank = F.trim(t) == F.lit("")
    status = (
        F.when(t.isNull(), F.lit("missing"))
        .when(blank, F.lit("empty"))
        .when(raw.isNull() | raw[CORRUPT].isNotNull(), F.lit("invalid"))
        .otherwise(F.lit("ok"))
    )
    good = status == F.lit("ok")
    out: list[Column] = []
    checks: list[Column] = []
    for name, kind in schema.fields:
        v = raw[name]
        if kind == "int":
            typed = whole_int(v)
            checks.append(F.when(good & v.isNotNull() & typed.isNull(), F.lit(f"{name}:not_int")))
        elif kind == "float":
            typed = F.when(~F.isnan(v), v)
            checks.append(F.when(good & v.isNotNull() & F.isnan(v), F.lit(f"{name}:nan")))
        else:
            typed = v
        checks.append(F.when(good & v.isNull(), F.lit(f"{name}:missing")))
        out.append(F.when(good, typed).alias(name))
    violations = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return F.struct(*out, status.alias("status"), violations.alias("violations"))


def normalise_label(
    label: Column | str,
    rules: Sequence[tuple[str, str]] = DEFAULT_LABEL_RULES,
    fallback: str = DEFAULT_LABEL_FALLBACK,
) -> Column:
    """first rule whose needle is in the lower-cased label; else ``fallback``.

    A null label stays null (the reference raises on it; the row then carries an
    error instead of a made-up ``Ukendt``). ``''`` gives the fallback.
    """
    lab = F.lower(_c(label))
    expr = None
    for needle, out in rules:
        cond = lab.contains(F.lit(needle))
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    fb = F.when(lab.isNotNull(), F.lit(fallback))
    return fb if expr is None else expr.when(lab.isNotNull(), F.lit(fallback))


def score_band(score: Column | str, low: int = 1, high: int = 10) -> Column:
    """the prompt's confidence bands: 8-10 clear, 3-7 unsure, 1-2 hard."""
    s = _c(score)
    return (
        F.when(s.isNull(), F.lit(None))
        .when((s < F.lit(low)) | (s > F.lit(high)), F.lit("out_of_range"))
        .when(s >= F.lit(8), F.lit("clear"))
        .when(s >= F.lit(3), F.lit("unsure"))
        .otherwise(F.lit("hard"))
    )


def score_in_range(score: Column | str, low: int = 1, high: int = 10) -> Column:
    s = _c(score)
    return F.when(s.isNotNull(), (s >= F.lit(low)) & (s <= F.lit(high)))


def pick(arr: Column | str, position: int, field: str | None = None) -> Column:
    """M9: the element at 1-based ``position`` (null when out of range)."""
    el = F.try_element_at(_c(arr), F.lit(position))
    return el[field] if field else el
