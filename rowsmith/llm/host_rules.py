"""Operator 8: quality rules with host verdicts, in Spark expressions only.

Every text gets counts (words, symbols, repeated lines, words in repeated 5-word
windows) and base rules decide on them. A host (the ``source`` of a document) is
judged by all its documents: failures of the strict rules are summed by host, the
rate is shrunk towards the rate of all hosts with a beta prior fitted to the hosts
themselves (moments of the host rates), and a host is bad whose shrunk rate is over
``HOST_FACTOR`` times the rate of all documents, or over ``HOST_LIMIT`` in any case. The
fewer documents a host has, and the more alike hosts are, the nearer its rate is drawn
to that of all, so chance alone makes no host bad. The
verdict is joined back: documents of a bad host are held to the strict rules,
others to the base rules alone. So a clean document stays, whatever its host.

Sums by host are pre-aggregated, so a host with a third of all rows is one row per
task; joining back is a join on the host whose hot key Spark may split.

Two equal windows are told by a 64-bit hash of their five words.

Defined results: a null text has no words and fails the base rules; rows without a
host share the null host; rows are judged one by one, so repeated rows repeat; an
empty table gives an empty result; other input columns are carried along or not
looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .chat_format import _let

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Strict rules: what counts as a failure of the host, and applies on bad hosts.
STRICT_REPEAT_PERCENT = 10
STRICT_SYMBOL_PERCENT = 10
STRICT_DUP_LINES_PERCENT = 30
#: A host is bad when its shrunk failure rate is over so many times that of all documents, or over the limit.
HOST_FACTOR, HOST_LIMIT = 1.25, 0.5
#: Least and most weight of the prior, in documents.
PRIOR_WEIGHT = (1.0, 1e6)

_SPACES = r"[\x20\x09-\x0D]+"


def _repeat_words(words: Column, windows: Column) -> Column:
    """Words that lie in windows found twice or more; ``windows``: hash of the window at each place."""

    def covered(order: Column) -> Column:
        again = F.filter(order, lambda e, j: (e["h"] == F.get(order, j - 1)["h"]) | (e["h"] == F.get(order, j + 1)["h"]))
        return _let(
            F.array_sort(F.transform(again, lambda e: e["p"])),
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x
            ),
        )

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(pairs, covered))


def with_counts(docs: DataFrame, text_col: str = "text", host_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """Per row: ``row`` (a struct of the ``carry`` columns, all by default), ``host`` and the counts.

    Carried columns sit in the struct, so their names cannot clash with anything.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])

    def measured(words: Column) -> Column:
        # Windows start at every word that has four after it.
        starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _let(windows, lambda w: _repeat_words(words, w)).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        row.alias("row"),
        F.col(host_col).alias("host"),
        _let(F.filter(F.split(text, _SPACES, -1), lambda w: w != ""), measured).alias("words"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(lines, lambda x: F.size(x)).cast("long").alias("n_lines"),
    )
    return counted.select("row", "host", "words.*", "n_symbols", "n_dup_lines", "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def strict_failed() -> Column:
    return (
        base_failed()
        | (100 * F.col("n_repeat_words") > STRICT_REPEAT_PERCENT * F.col("n_words"))
        | (100 * F.col("n_symbols") > STRICT_SYMBOL_PERCENT * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > STRICT_DUP_LINES_PERCENT * F.col("n_lines"))
    )


def host_verdicts(counted: DataFrame) -> DataFrame:
    """Per host: documents, failures, shrunk rate, and whether the host is bad."""
    hosts = counted.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(strict_failed(), 1).otherwise(0)).alias("failed"))
    # Beta prior by moments: mean of all documents, and variance of the host rates
    # around it, sum n (p - mean)^2 / N = sum(f^2 / n) / N - mean^2. One row.
    n, f, square = hosts.agg(F.sum("n"), F.sum("failed"), F.sum(F.col("failed") * F.col("failed") / F.col("n"))).first()
    mean, weight = (f / n if n else 0.0), PRIOR_WEIGHT[1]
    if n and (variance := square / n - mean * mean) > 0:
        weight = min(max(mean * (1 - mean) / variance - 1, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    rate = (F.col("failed") + F.lit(weight * mean)) / (F.col("n") + F.lit(weight))
    return hosts.select("host", "n", "failed", rate.alias("rate"), (rate > min(HOST_LIMIT, HOST_FACTOR * mean)).alias("bad"))


def judged(docs: DataFrame, host_col: str = "source", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: ``row`` (a struct of the carried columns), the counts, ``base_failed`` and ``kept``.

    Counts are worked out once and written, for they are needed by the hosts first
    and by the documents after.
    """
    counted = tables.written(with_counts(docs, text_col, host_col, carry), "counts")
    # Written, so that its true size decides how it is joined: few hosts need no shuffle of the rows.
    verdicts = tables.written(host_verdicts(counted).select(F.col("host").alias("judged"), "bad"), "hosts")
    ruled = counted.join(verdicts, F.col("host").eqNullSafe(F.col("judged")), "left")
    kept = ~base_failed() & ~(F.col("bad") & strict_failed())
    return ruled.select(*counted.columns, base_failed().alias("base_failed"), kept.alias("kept"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged(tables.table(spark, sf_dir, "documents"), carry=["doc_id"])
    return docs.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL_OP8 = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, list_aggregate(words[i:i + {WINDOW - 1}], 'string_agg', ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS m FROM g), range({WINDOW}) t(k)
    WHERE m > 1 GROUP BY doc_id),
c AS (SELECT w.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(list_aggregate(words, 'string_agg', '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {STRICT_REPEAT_PERCENT} * n_words OR 100 * n_symbols > {STRICT_SYMBOL_PERCENT} * word_chars
      OR 100 * n_dup_lines > {STRICT_DUP_LINES_PERCENT} * n_lines AS strict FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE strict) AS bad FROM f GROUP BY source),
m AS (SELECT sum(bad) / sum(n) AS mean FROM h),
v AS (SELECT any_value(mean) AS mean, sum(n * power(bad / n - mean, 2)) / sum(n) AS var FROM h, m),
p AS (SELECT mean, greatest({PRIOR_WEIGHT[0]}, least({PRIOR_WEIGHT[1]}, CASE WHEN var > 0 THEN mean * (1 - mean) / var - 1 ELSE {PRIOR_WEIGHT[1]} END)) AS weight FROM v),
x AS (SELECT source, (bad + weight * mean) / (n + weight) > least({HOST_LIMIT}, {HOST_FACTOR} * mean) AS bad_host FROM h, p)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (bad_host AND strict) AS kept
FROM f JOIN x ON f.source IS NOT DISTINCT FROM x.source
"""
