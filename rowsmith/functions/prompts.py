"""Prompt rendering.

A template is parsed once on the driver and turned into one ``concat`` Column, so
rendering runs in whole-stage codegen with no Python per row. Placeholders are
``{name}``; ``{{`` and ``}}`` are literal braces. Braces that come from the data
are never expanded, because values are spliced in, not substituted textually.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


class TemplateError(ValueError):
    pass


def template_fields(template: str) -> list[str]:
    """Names used by a template, in order of first use."""
    names: list[str] = []
    for _, name, _, _ in string.Formatter().parse(template):
        if name is not None and name not in names:
            names.append(name)
    return names


# Fixed value: how a missing cell prints in a prompt (Python's str() of a
# pandas missing value).
NULL_TEXT = "nan"


def number_text(c: Column | str) -> Column:
    """A double as Python's ``str`` prints it; any other type as its cast to text.

    Both print the shortest digits that read back the same; they differ in when
    and how an exponent is written: Spark from 1e7 and below 1e-3 as ``1.0E7``,
    Python from 1e16 and below 1e-4 as ``1e+16``. (Digits differ for the smallest
    doubles, ``4.9e-324`` against ``5e-324``, and for some beside powers of two, where
    Java's rounding gives another last digit that reads back the same.)

    A text without an exponent, nearly every amount, is the cast as it is; the rest
    is worked out only for the others.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    special = F.when(text == "NaN", F.lit("nan")).when(text == "Infinity", F.lit("inf")).when(text == "-Infinity", F.lit("-inf"))
    # The rare case is a lambda: written out at each use, it would make methods that are too long to be compiled.
    rare = F.transform(F.array(text), lambda t: _with_exponent(t, t.cast("double")))[0]
    as_python = F.when(F.contains(text, F.lit("E")), rare).otherwise(F.coalesce(special, text))
    return F.when(F.typeof(c).isin("double", "float"), as_python).otherwise(text)


def _with_exponent(text: Column, double: Column) -> Column:
    """``1.25E-7`` as Python prints it.

    Older Java runtimes print a digit or two too many for some doubles with an
    exponent (of those without, tests find none): texts of so many digits that a
    shorter one may read back the same are tried with 15, 16 and 17 digits.
    """
    shortest = F.upper(text)
    for n in (16, 15, 14):  # digits after the first; the fewest that read back the same win
        tried = F.format_string(f"%.{n}e", double)
        shortest = F.when(tried.cast("double") == double, F.upper(tried)).otherwise(shortest)
    sci = F.when(F.length(F.substring_index(text, "E", 1)) >= 17, shortest).otherwise(text)
    # With an exponent: no trailing zeros, a sign, two digits at least. Without: every place a decimal has, less trailing zeros.
    power = F.regexp_replace(F.regexp_replace(F.regexp_replace(sci, r"\.?0*E\+?", "e"), r"e(\d)", r"e+$1"), r"e([+-])(\d)$", "e$10$2")
    plain = F.regexp_replace(sci.cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when((F.abs(double) >= 1e16) | (F.abs(double) < 1e-4), power).otherwise(plain)


def render(template: str, variables: Mapping[str, Column | str], null_text: str | None = NULL_TEXT) -> Column:
    """render ``template`` with column-valued variables.

    ``variables`` maps each placeholder to a Column (or column name). Values are
    turned to text as Python prints them (``number_text``); a null value prints as ``null_text`` (``nan``, as a missing
    table cell prints in the source); with ``null_text=None`` a null value makes
    the whole prompt null. An unknown placeholder, a positional ``{}``, a format spec
    or a conversion raises here, on the driver, before any job runs.
    """
    parts: list[Column] = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if name == "" or name.isdigit():
            raise TemplateError("positional placeholders are not supported; name every field")
        if spec or conversion:
            raise TemplateError(f"format spec / conversion not supported in {{{name}}}")
        if name not in variables:
            raise TemplateError(f"template uses {{{name}}} but no such variable was given")
        value = variables[name]
        value = F.col(value) if isinstance(value, str) else value
        text = number_text(value)
        if null_text is not None:
            text = F.coalesce(text, F.lit(null_text))
        parts.append(text)
    if not parts:
        return F.lit("")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def render_around(
    template: str, hole: str, variables: Mapping[str, Column | str], null_text: str | None = NULL_TEXT
) -> Column:
    """F1 in pieces: the rendered texts around every ``{hole}``, as an array.

    Joined by the value of ``hole`` they are the prompt; so a value that many
    prompts share need not be written into each.
    """
    pieces, current = [], ""
    for literal, name, spec, conversion in string.Formatter().parse(template):
        current += literal.replace("{", "{{").replace("}", "}}")
        if name == hole:
            pieces.append(current)
            current = ""
        elif name is not None:
            current += "{" + name + (f"!{conversion}" if conversion else "") + (f":{spec}" if spec else "") + "}"
    return F.array(*[render(p, variables, null_text) for p in [*pieces, current]])


def static_prompt(template: str) -> Column:
    """a template used unchanged, as a literal column."""
    return F.lit(template)


def load_template(path: str) -> str:
    """Read a template file once on the driver."""
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def context_json(arr: Column | str) -> Column:
    """an array of structs as JSON text, nulls written out.

    Deviation kept on purpose: the reference prints a Python list repr although
    the prompt promises JSON; we write real JSON. NaN doubles are turned into
    null before this is called (see ``nan_to_null``).
    """
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.to_json(arr, {"ignoreNullFields": "false"})


def json_item(fields: Mapping[str, Column], doubles: set[str]) -> Column:
    """One JSON object; the fields named in ``doubles`` are written as ``json.dumps`` writes them.

    NaN and infinities are not JSON and become null.
    """
    parts: list[Column] = []
    for i, (name, value) in enumerate(fields.items()):
        key = F.to_json(F.array(F.lit(name)))
        parts.append(F.concat(F.lit("," if i else "{"), F.substring(key, F.lit(2), F.length(key) - 2), F.lit(":")))
        if name in doubles:
            finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
            parts.append(F.coalesce(F.when(finite, number_text(value)), F.lit("null")))
        else:
            listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
            parts.append(F.substring(listed, F.lit(2), F.length(listed) - 2))
    return F.concat(*parts, F.lit("}"))


def nan_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)
