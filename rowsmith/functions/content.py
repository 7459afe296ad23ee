"""Main content of a web page by text and link density (F13), in array functions.

``html.main_content`` trusts the ``<article>`` element. This one looks at the text: the page
is cut at its block elements, each block is scored by its characters less a multiple of
those inside links and a toll, and the run of neighbouring blocks with the greatest sum is
the content. Navigation and footers score below nothing, and so do short lines unless
they stand between longer ones; nesting does not matter. One pass over the blocks, linear
in the page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import MAX_TEXT_CHARS, decode_entities, squeeze

#: Elements that begin or end a block of text.
BLOCKS = "p|div|article|section|main|td|th|tr|table|li|ul|ol|dl|dt|dd|h[1-6]|header|footer|nav|aside|body|head|html|title|br|hr|blockquote|pre|form|figure|figcaption"
_CUT = rf"(?i)</?(?:{BLOCKS})\b[^>]*>"
#: What a block costs, and what a character in a link costs.
TOLL, LINK_COST = 30, 3


def _text(fragment: Column) -> Column:
    return squeeze(decode_entities(F.regexp_replace(fragment, r"<[^<>]*>", " ")))


def without(html: Column, opening: str, closing: str) -> Column:
    """``html`` without what stands from the first ``opening`` before a ``closing`` to it; an opening that is never closed stays.

    The page is split at the closings, and each piece is cut where an opening stands in
    it: a pattern for both ends would look through the rest of the page for every opening.
    """
    pieces = F.split(html, closing)
    kept = F.transform(F.array(pieces), lambda ps: F.transform(ps, lambda p, i: F.when(i == F.size(ps) - 1, p).otherwise(F.regexp_replace(p, rf"(?is){opening}.*$", ""))))[0]
    return F.array_join(kept, " ")


def text_blocks(html: Column) -> Column:
    """Blocks of a page that have text, in order: ``text`` and ``score``."""
    h = html
    for opening, closing in ((r"<script\b", r"(?i)</script>"), (r"<style\b", r"(?i)</style>"), ("<!--", "-->"), (r"<head\b", r"(?i)</head>")):
        h = without(h, opening, closing)
    parts = F.transform(F.split(h, _CUT), lambda b: F.struct(_text(b).alias("text"), F.length(_text(without(b, r"<a\b", r"(?i)</a>"))).alias("plain")))
    with_text = F.filter(parts, lambda b: b["text"] != "")

    def scored(b: Column) -> Column:
        n = F.length(b["text"])
        return F.struct(b["text"].alias("text"), (n - LINK_COST * (n - b["plain"]) - TOLL).alias("score"))

    return F.transform(with_text, scored)


def best_run(blocks: Column) -> Column:
    """``first`` (from 0) and ``n`` of the neighbouring blocks with the greatest sum of scores; ``n`` is 0 if no sum is over 0.

    Of equal sums the one that ends first, of these the shortest.
    """
    zero = F.lit(0)
    start = F.struct(zero.alias("at"), zero.alias("now"), zero.alias("since"), zero.alias("best"), zero.alias("first"), zero.alias("n"))

    def step(s: Column, b: Column) -> Column:
        now = F.when(s["now"] > 0, s["now"] + b["score"]).otherwise(b["score"])
        since = F.when(s["now"] > 0, s["since"]).otherwise(s["at"])
        better = now > s["best"]
        return F.struct(
            (s["at"] + 1).alias("at"), now.alias("now"), since.alias("since"), F.when(better, now).otherwise(s["best"]).alias("best"),
            F.when(better, since).otherwise(s["first"]).alias("first"), F.when(better, s["at"] + 1 - since).otherwise(s["n"]).alias("n"),
        )

    return F.aggregate(blocks, start, step, lambda s: F.struct(s["first"], s["n"]))


def content_text(html: Column | str, max_chars: int | None = MAX_TEXT_CHARS) -> Column:
    """the text of the best run of blocks, of the whole page when none scores over nothing; a null page gives null."""
    h = F.col(html) if isinstance(html, str) else html
    # Blocks are worked out once, however often the body uses them.
    once = F.transform(F.array(text_blocks(h)), lambda blocks: F.struct(blocks.alias("b"), best_run(blocks).alias("r")))[0]
    chosen = F.transform(F.array(once), lambda x: F.transform(F.when(x["r"]["n"] > 0, F.slice(x["b"], x["r"]["first"] + 1, x["r"]["n"])).otherwise(x["b"]), lambda b: b["text"]))[0]
    text = F.when(h.isNotNull(), F.array_join(chosen, " "))
    return F.substring(text, 1, max_chars) if max_chars else text
