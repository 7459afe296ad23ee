"""Search over stored pages.

The reference asks a web search engine; here the pages are a table. A query is
a set of words; a page's score is the number of distinct query words it
contains. Pages are tokenised once (distinct ``(page, word)``), equi-joined with
the query words, counted per ``(query, page)`` and ranked; which side is
broadcast, if any, is left to the sizes measured at run time. A word that every
page holds is one hot key of an inner join, which may be split. ``row_number() <= k`` lets Spark keep a per-partition top-k before the
shuffle (window group limit), so a query that hits every page does not pull
all of them into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as X

# Reference defaults for the search tool.
CANDIDATES = 10  # results asked from the search engine
MAX_PAGES = 3  # pages kept per query
NO_TITLE = "Ingen titel"


def page_words(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Distinct cleaned words per page, from the page's whole text.

    Words are cleaned in one pass over the text and made distinct inside each
    row (``array_distinct``), so no shuffle is needed to de-duplicate them.
    """
    text = H.html_to_text(html_col, max_chars=None)
    cleaned = F.array_distinct(X.words(F.lower(F.regexp_replace(text, X.NOT_WORD_OR_SPACE, ""))))
    return pages.select(F.col(id_col), F.explode(cleaned).alias("word"))


def query_words(queries: DataFrame, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    words = queries.select(F.col(id_col), F.explode(X.words(text_col)).alias("_w"))
    return words.select(id_col, X.clean_word("_w").alias("word")).filter(F.col("word") != "").distinct()


def search_candidates(
    pages: DataFrame,
    queries: DataFrame,
    candidates: int = CANDIDATES,
    id_col: str = "page_id",
    html_col: str = "html",
) -> DataFrame:
    """J4 + O2: the ``candidates`` best pages per query: (query_id, rank, page_id, score)."""
    hits = page_words(pages, id_col, html_col).join(query_words(queries), "word").groupBy("query_id", id_col).agg(
        F.count(F.lit(1)).alias("score")
    )
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_col).asc())
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(candidates))


def first_pages(
    pages: DataFrame,
    queries: DataFrame,
    max_pages: int = MAX_PAGES,
    candidates: int = CANDIDATES,
    id_col: str = "page_id",
    url_col: str = "url",
    href_col: str | None = None,
    html_col: str = "html",
    max_chars: int = H.MAX_TEXT_CHARS,
    found: DataFrame | None = None,
) -> DataFrame:
    """W4 + O3 + P8 + F13: first ``max_pages`` candidates that have a link.

    The link is ``href`` when non-empty, else ``url``; candidates without one
    are dropped *after* the candidate cut, as the reference does. Output:
    query_id, position (1..max_pages), page_id, title, url, text. ``found`` has the
    candidates where they come from elsewhere (``page_index.PageIndex.search``).
    """
    cand = search_candidates(pages, queries, candidates, id_col, html_col) if found is None else found
    href = F.col(href_col) if href_col else F.lit(None).cast("string")
    link = F.coalesce(F.when(href != "", href), F.when(F.col(url_col) != "", F.col(url_col)))
    cols = [id_col, url_col, html_col] + ([href_col] if href_col else [])
    # Only the candidates' pages are rendered to text: join first, then parse.
    got = pages.select(*cols).join(cand, id_col)
    title = H.html_title(html_col)
    with_link = got.select(
        "query_id", "rank", F.col(id_col), link.alias("link"),
        F.coalesce(F.when(title != "", title), F.lit(NO_TITLE)).alias("title"),
        H.html_to_text(html_col, max_chars).alias("text"),
    ).filter(F.col("link").isNotNull())
    w = Window.partitionBy("query_id").orderBy("rank")
    kept = with_link.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= F.lit(max_pages))
    return kept.select("query_id", "position", id_col, "title", F.col("link").alias("url"), "text")


def digest(first: DataFrame) -> DataFrame:
    """A2 + F14: per query, the page blocks joined by a blank line, in order."""
    block = H.page_block("position", "title", "url", "text")
    return first.groupBy("query_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("position", block.alias("b")))), lambda x: x["b"]),
            "\n\n",
        ).alias("digest"),
        F.count(F.lit(1)).alias("n_pages"),
    )
