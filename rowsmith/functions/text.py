"""Answer text functions (F3-F6) as JVM-side Column expressions.

Python and Java regexes differ, so every pattern here is written to give what
Python's ``re`` / ``str.split`` give:

* Python's ``\\w`` (Unicode) is letters, digits and ``_``; Java's plain ``\\w`` is
  ASCII only, so we spell it ``[\\p{L}\\p{N}_]``.
* ``str.split()`` breaks on Unicode white space and also on ``\\x1c``-``\\x1f``;
  Java's ``(?U)\\s`` misses the latter, so they are added.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD_CHAR = r"[^\p{L}\p{N}_]"
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
THINK_BLOCK = r"(?s)<think>.*?</think>"
NOT_WORD_OR_SPACE = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_word(word: Column | str) -> Column:
    """drop every non-word character, lower-case."""
    return F.lower(F.regexp_replace(_c(word), NOT_WORD_CHAR, ""))


def clean_word_py(word: str) -> str:
    """Driver-side twin of :func:`clean_word`, used for configured labels."""
    return re.sub(r"[^\w]", "", word).lower()


def strip_thinking(text: Column | str) -> Column:
    """remove ``<think>...</think>`` blocks (shortest match, across lines).

    An unclosed tag stays, and white space around a block stays.
    """
    return F.regexp_replace(_c(text), THINK_BLOCK, "")


def words(text: Column | str) -> Column:
    """Python ``str.split()``: white-space separated words, no empty strings."""
    return F.filter(F.split(_c(text), WHITESPACE_RUN), lambda w: w != F.lit(""))


def word_count(text: Column | str) -> Column:
    return F.size(words(text))


def thinking_word_count(text: Column | str) -> Column:
    """words of the raw answer minus words once thinking is stripped.

    Stripping can glue two words together, so this is not the number of words
    inside the tags; it is what the reference reports.
    """
    t = _c(text)
    return F.when(t.isNotNull(), word_count(t) - word_count(strip_thinking(t)))


def label_lookup(labels: Sequence[str]) -> dict[str, str]:
    """Cleaned label -> configured label; the first label wins on equal cleaning."""
    out: dict[str, str] = {}
    for label in labels:
        out.setdefault(clean_word_py(label), label)
    return out


def extract_label(text: Column | str, labels: Sequence[str] | None, remove_thinking: bool = True) -> Column:
    """the first word (in text order) whose cleaned form equals a cleaned label.

    Returns the label as configured. No labels, no hit, or a null answer give
    null. With ``remove_thinking`` the scan skips ``<think>`` blocks.

    Cleaning every word with its own regex call is the slow part on long
    answers, so the whole text is cleaned once: every character that is
    neither a word character nor white space is dropped and the text is
    lower-cased; splitting that on white space gives exactly the cleaned
    words (a word of only punctuation becomes empty and is dropped, which can
    only matter for a label that cleans to nothing; that case takes the
    per-word path).
    """
    if not labels:
        return F.lit(None).cast("string")
    t = _c(text)
    if remove_thinking:
        t = strip_thinking(t)
    lookup = label_lookup(labels)

    def to_label(cw: Column) -> Column:
        expr = None
        for cleaned, label in lookup.items():
            expr = F.when(cw == F.lit(cleaned), F.lit(label)) if expr is None else expr.when(cw == F.lit(cleaned), F.lit(label))
        return expr

    if "" in lookup:
        hits = F.filter(F.transform(words(t), lambda w: to_label(clean_word(w))), lambda x: x.isNotNull())
        return F.try_element_at(hits, F.lit(1))
    cleaned_words = words(F.lower(F.regexp_replace(t, NOT_WORD_OR_SPACE, "")))
    wanted = F.array(*[F.lit(c) for c in lookup])
    first = F.try_element_at(F.filter(cleaned_words, lambda w: F.array_contains(wanted, w)), F.lit(1))
    as_label = F.create_map(*[F.lit(x) for pair in lookup.items() for x in pair])
    return F.try_element_at(as_label, first)


def answer_without_thinking(text: Column | str, remove_thinking: bool = True) -> Column:
    return strip_thinking(text) if remove_thinking else _c(text)
