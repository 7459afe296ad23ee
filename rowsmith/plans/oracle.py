"""Helpers that spell our column logic as DuckDB SQL for the oracle checks.

The oracle restates the same rules (templates, keyword rules, label rules) in
SQL, so a Spark plan and an independent SQL engine must agree on the data.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from ..functions.answers import DEFAULT_LABEL_FALLBACK, DEFAULT_LABEL_RULES
from ..operators.standins import DEFAULT_KEYWORD_RULES, DEFAULT_NO_RULE_LABEL

# DuckDB twin of Python str.split() white space on these tables.
SQL_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def lit(text: str) -> str:
    """A SQL string literal; new lines become chr(10)."""
    pieces = text.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in pieces]
    out = " || chr(10) || ".join(quoted)
    return f"({out})" if len(pieces) > 1 else out


def render(template: str, variables: Mapping[str, str], null_text: str | None = "nan") -> str:
    parts: list[str] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(lit(literal))
        if name is None:
            continue
        expr = f"CAST({variables[name]} AS VARCHAR)"
        if null_text is not None:
            expr = f"coalesce({expr}, {lit(null_text)})"
        parts.append(expr)
    return "(" + " || ".join(parts) + ")"


def keyword_needle(prompt: str, rules: Sequence[tuple[str, str]] = DEFAULT_KEYWORD_RULES) -> str:
    whens = " ".join(f"WHEN strpos(lower({prompt}), {lit(n)}) > 0 THEN {lit(n)}" for n, _ in rules)
    return f"(CASE {whens} ELSE 'none' END)"


def keyword_label(needle: str, rules: Sequence[tuple[str, str]] = DEFAULT_KEYWORD_RULES,
                  default: str = DEFAULT_NO_RULE_LABEL) -> str:
    whens = " ".join(f"WHEN {needle} = {lit(n)} THEN {lit(lab)}" for n, lab in rules)
    return f"(CASE {whens} ELSE {lit(default)} END)"


def normalise(label: str) -> str:
    whens = " ".join(f"WHEN strpos(lower({label}), {lit(n)}) > 0 THEN {lit(out)}" for n, out in DEFAULT_LABEL_RULES)
    return f"(CASE WHEN {label} IS NULL THEN NULL {whens} ELSE {lit(DEFAULT_LABEL_FALLBACK)} END)"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SQL_WS}'), lambda x: x <> '')"


def word_count(text: str) -> str:
    return f"len({words(text)})"


def strip_thinking(text: str) -> str:
    return f"regexp_replace({text}, '(?s)<think>.*?</think>', '', 'g')"


def clean_word(w: str) -> str:
    return rf"lower(regexp_replace({w}, '[^\p{{L}}\p{{N}}_]', '', 'g'))"
