"""Web page text (F13, F14) as a regex chain, JVM-side.

Deviation kept on purpose: the reference runs a readability scorer and an HTML
parser per page. We pick the main content with a rule (the ``<article>`` elements
when there are any, else the whole page), drop scripts, styles, comments and
tags, decode the common entities and squeeze white space. Every pattern is
plain enough that Java and RE2 agree on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_TEXT_CHARS = 5000
EXCERPT_CHARS = 1000
SPACE_RUN = r"[ \t\n\r\f\x0b]+"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_entities(text: Column) -> Column:
    for ent, ch in ENTITIES:  # &amp; last, so "&amp;lt;" stays "&lt;"
        text = F.replace(text, F.lit(ent), F.lit(ch))
    return text


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE_RUN, " "))


def main_content(html: Column | str) -> Column:
    """What stands in the outermost ``<article>`` elements (all of them, in order), else the page.

    The page is cut before every opening and closing tag up to the last closing one,
    and a fold over the parts keeps those at a depth of one or more.
    """
    h = _c(html)
    parts = F.split(F.regexp_extract(h, r"(?is)^(.*</article>)", 1), r"(?i)(?=<article\b[^>]*>|</article>)")
    opening = r"(?i)^<article\b[^>]*>"

    def step(acc: Column, part: Column) -> Column:
        depth = acc["depth"] + F.when(part.rlike(opening), 1).when((F.lower(F.left(part, F.lit(10))) == "</article>") & (acc["depth"] > 0), -1).otherwise(0)
        own = F.regexp_replace(F.regexp_replace(part, opening, ""), r"(?i)^</article>", "")
        sep = F.when(acc["any"], " ").otherwise("")
        inside = depth > 0
        return F.struct(depth.alias("depth"), (acc["any"] | inside).alias("any"), F.when(inside, F.concat(acc["text"], sep, own)).otherwise(acc["text"]).alias("text"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("any"), F.lit("").alias("text"))
    articles = F.aggregate(parts, start, step, lambda acc: acc["text"])
    return F.when(articles != F.lit(""), articles).otherwise(h)


def html_to_text(html: Column | str, max_chars: int | None = MAX_TEXT_CHARS) -> Column:
    """visible text of the main content, space separated, trimmed, cut."""
    t = main_content(html)
    t = F.regexp_replace(t, r"(?is)<script\b.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style\b.*?</style>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    t = squeeze(decode_entities(t))
    return F.substring(t, 1, max_chars) if max_chars else t


def html_title(html: Column | str) -> Column:
    raw = F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return squeeze(decode_entities(raw))


def page_block(position: Column | str, title: Column | str, url: Column | str, text: Column | str,
               excerpt_chars: int = EXCERPT_CHARS) -> Column:
    """one numbered page block of the search digest."""
    # The reference's page block layout (labels and line breaks).
    return F.format_string(
        "SIDE %d:\nTitel: %s\nURL: %s\nUddrag:\n%s\n",
        _c(position), _c(title), _c(url), F.substring(_c(text), 1, excerpt_chars),
    )
