"""Query catalogue: one Spark plan per SURVEY section 2 item, each with the
DuckDB SQL that must give the same rows (where SQL can say it).

Every query reads the driver tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model as M
from ..operators import standins as B
from . import jobs as J
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def wide(df: DataFrame) -> DataFrame:
    """For heavy work row by row: a small file that one task would read is spread over the cores.

    Called after filters and column choice, which therefore reach the scan.
    """
    from ..sources.readers import spread

    return spread(df)


# ---------------------------------------------------------------------------
# M2 + F1 + F7 + F8: classify one line with a structured answer
# ---------------------------------------------------------------------------

_SIMPLE_PROMPT_SQL = O.render(J.SIMPLE_TEMPLATE, {"key": "p_partkey", "fakturalinje": "p_name"})


def _simple_sql(source: str, extra: str = "") -> str:
    needle = O.keyword_needle("prompt")
    return f"""
WITH p AS (SELECT *, {_SIMPLE_PROMPT_SQL} AS prompt FROM {source}),
k AS (SELECT *, {needle} AS needle FROM p)
SELECT p_partkey, p_name,
       {O.normalise(O.keyword_label('needle'))} AS klassificering,
       CAST(length(prompt) % 12 AS INTEGER) AS score,
       'rule ' || needle AS begrundelse,
       'ok' AS status{extra}
FROM k"""


@register("classify_structured", sql=_simple_sql("part"))
def classify_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    out = J.classify_simple(part, "p_name", "p_partkey", B.KeywordBackend())
    return out.select("p_partkey", "p_name", J.OUT_LABEL, J.OUT_SCORE, J.OUT_REASON, "status")


# ---------------------------------------------------------------------------
# Sources, sinks, unions
# ---------------------------------------------------------------------------

from ..session import scratch_path, shuffles_freed, written  # noqa: E402
from ..sources import readers as R  # noqa: E402


@register("scan_parquet", sql="SELECT * FROM nation")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.load_table(spark, os.path.join(sf_dir, "nation.parquet"))


def _roundtrip(spark: SparkSession, df: DataFrame, suffix: str) -> DataFrame:
    path = scratch_path(spark, f"roundtrip.{suffix}") + f".{suffix}"
    R.write_table(df, path)
    return R.load_table(spark, path, schema=df.schema)


@register("scan_csv_roundtrip", sql="SELECT * FROM part")
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, table(spark, sf_dir, "part"), "csv")


@register("scan_json_roundtrip", sql="SELECT * FROM customer")
def scan_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, table(spark, sf_dir, "customer"), "json")


@register("sink_roundtrip", sql="SELECT * FROM lineitem")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, table(spark, sf_dir, "lineitem"), "parquet")


_CUST_NULLS = "NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey, NULL::DOUBLE AS c_acctbal, NULL::VARCHAR AS c_mktsegment"
_SUPP_NULLS = "NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name, NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal"


@register(
    "union_named_inputs",
    sql=f"""
SELECT *, {_SUPP_NULLS}, 'customer' AS source_name, 0 AS source_ordinal FROM customer
UNION ALL
SELECT {_CUST_NULLS}, *, 'supplier' AS source_name, 1 AS source_ordinal FROM supplier""",
)
def union_named_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = {n: table(spark, sf_dir, n) for n in ("customer", "supplier", "nation")}
    return R.union_named_inputs(inputs, exclude=["nation"])


@register(
    "align_columns",
    sql=f"""
SELECT *, {_CUST_NULLS}, 'supplier' AS side FROM supplier
UNION ALL
SELECT {_SUPP_NULLS}, *, 'customer' AS side FROM customer""",
)
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp, cust = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    a = R.align_columns(supp, cust).withColumn("side", F.lit("supplier"))
    b = R.align_columns(cust, supp).withColumn("side", F.lit("customer"))
    return a.unionByName(b)


# ---------------------------------------------------------------------------
# Positions, sampling, progress
# ---------------------------------------------------------------------------

from ..operators import metrics as MT  # noqa: E402
from ..operators.ordering import every_nth, row_index  # noqa: E402


@register(
    "row_index",
    sql="""SELECT o_orderkey, o_orderstatus,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS row_id
FROM orders""",
)
def q_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return row_index(orders, ["o_orderkey"], ["o_orderstatus"])


@register(
    "sample_every_n",
    sql="""SELECT * FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders)
WHERE (row_id + 1) % 25 = 0""",
)
def sample_every_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return every_nth(row_index(orders, ["o_orderkey"]), "row_id", 25)


@register(
    "progress_rows",
    sql="""SELECT o_orderkey, rows_done, 'Row: ' || CAST(rows_done AS VARCHAR) AS message FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rows_done FROM orders)
WHERE rows_done % 500 = 0""",
)
def progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MT.progress_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 500)


# ---------------------------------------------------------------------------
# Answer text functions on answers made from whole documents
# ---------------------------------------------------------------------------

from ..functions import answers as A  # noqa: E402
from ..functions import text as X  # noqa: E402

LABELS = ("materialeindkøb", "tjenesteydelse")


def _made_answer() -> "F.Column":
    t, m = F.col("text"), F.col("doc_id") % 4
    return (
        F.when(m == 0, F.concat(F.lit("<think>"), t, F.lit(" tjenesteydelse</think>\nSvar: **Materialeindkøb**")))
        .when(m == 1, F.concat(t, F.lit("\nLabel: TJENESTEYDELSE.")))
        .when(m == 2, F.concat(F.lit("<think>overvejer materialeindkøb</think>"), t))
        .otherwise(t)
    )


_MADE_ANSWER_SQL = (
    "CASE doc_id % 4 "
    f"WHEN 0 THEN '<think>' || text || {O.lit(' tjenesteydelse</think>' + chr(10) + 'Svar: **Materialeindkøb**')} "
    f"WHEN 1 THEN text || {O.lit(chr(10) + 'Label: TJENESTEYDELSE.')} "
    "WHEN 2 THEN '<think>overvejer materialeindkøb</think>' || text "
    "ELSE text END"
)
_ANSWERS_SQL = f"(SELECT doc_id, {_MADE_ANSWER_SQL} AS answer FROM documents)"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = wide(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", _made_answer().alias("answer"))


@register(
    "clean_word",
    sql=f"""SELECT doc_id,
  array_to_string(list_transform({O.words('answer')}, lambda w: {O.clean_word('w')}), ' ') AS cleaned
FROM {_ANSWERS_SQL}""",
)
def q_clean_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _answers(spark, sf_dir)
    return a.select("doc_id", F.array_join(F.transform(X.words("answer"), X.clean_word), " ").alias("cleaned"))


@register(
    "strip_thinking",
    sql=f"SELECT doc_id, {O.strip_thinking('answer')} AS stripped FROM {_ANSWERS_SQL}",
)
def q_strip_thinking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("doc_id", X.strip_thinking("answer").alias("stripped"))


@register(
    "word_counts",
    sql=f"""SELECT doc_id, CAST({O.word_count('answer')} AS INTEGER) AS total_words,
  CAST({O.word_count('answer')} - {O.word_count(O.strip_thinking('answer'))} AS INTEGER) AS thinking_words
FROM {_ANSWERS_SQL}""",
)
def q_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _answers(spark, sf_dir)
    return a.select("doc_id", X.word_count("answer").alias("total_words"), X.thinking_word_count("answer").alias("thinking_words"))


def _label_sql(text: str) -> str:
    whens = " ".join(f"WHEN {O.lit(X.clean_word_py(l))} THEN {O.lit(l)}" for l in LABELS)
    return f"list_filter(list_transform({O.words(text)}, lambda w: CASE {O.clean_word('w')} {whens} END), lambda x: x IS NOT NULL)[1]"


@register(
    "extract_label",
    sql=f"""SELECT doc_id, {_label_sql(O.strip_thinking('answer'))} AS label,
  {_label_sql('answer')} AS label_with_thinking
FROM {_ANSWERS_SQL}""",
)
def q_extract_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _answers(spark, sf_dir)
    return a.select(
        "doc_id",
        X.extract_label("answer", LABELS, remove_thinking=True).alias("label"),
        X.extract_label("answer", LABELS, remove_thinking=False).alias("label_with_thinking"),
    )


# ---------------------------------------------------------------------------
# Labels, scores, JSON answers
# ---------------------------------------------------------------------------

_RAW_LABEL_SQL = """CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Materialeindkøb'
  WHEN 3 THEN 'automatisk tjeneste' WHEN 4 THEN 'TJENESTEYDELSE' WHEN 5 THEN 'MAT' ELSE p_name END"""


def _raw_label() -> "F.Column":
    m = F.col("p_partkey") % 7
    return (
        F.when(m == 0, F.lit(None).cast("string"))
        .when(m == 1, F.lit(""))
        .when(m == 2, F.lit("Materialeindkøb"))
        .when(m == 3, F.lit("automatisk tjeneste"))
        .when(m == 4, F.lit("TJENESTEYDELSE"))
        .when(m == 5, F.lit("MAT"))
        .otherwise(F.col("p_name"))
    )


@register(
    "normalise_label",
    sql=f"""SELECT p_partkey, raw_label, CASE WHEN raw_label ILIKE '%mat%' THEN 'Materialeindkøb' WHEN raw_label ILIKE '%tjen%' THEN 'Tjenesteydelse'
  WHEN raw_label IS NOT NULL THEN 'Ukendt' END AS label FROM (SELECT p_partkey, {_RAW_LABEL_SQL} AS raw_label FROM part)""",
)
def q_normalise_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", _raw_label().alias("raw_label"))
    return p.select("p_partkey", "raw_label", A.normalise_label("raw_label").alias("label"))


_EVENT_TEXT_SQL = "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 5 = 0 THEN substr(props, 1, length(props) - 2) ELSE props END"


@register(
    "parse_answer",
    sql=f"""SELECT event_id,
  CASE WHEN status = 'ok' AND kd = floor(kd) THEN CAST(kd AS INTEGER) END AS k, status
FROM (SELECT event_id,
        CASE WHEN txt IS NULL THEN 'missing' WHEN trim(txt) = '' THEN 'empty'
             WHEN json_valid(txt) AND json_type(txt) = 'OBJECT' THEN 'ok' ELSE 'invalid' END AS status,
        CASE WHEN json_valid(txt) THEN TRY_CAST(json_extract_string(txt, '$.k') AS DOUBLE) END AS kd
      FROM (SELECT event_id, {_EVENT_TEXT_SQL} AS txt FROM events))""",
)
def q_parse_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = wide(table(spark, sf_dir, "events").select("event_id", "props"))
    eid, props = F.col("event_id"), F.col("props")
    txt = F.when(eid % 7 == 0, F.lit("")).when(eid % 5 == 0, F.expr("substr(props, 1, length(props) - 2)")).otherwise(props)
    parsed = A.with_parsed_answer(ev.select("event_id", txt.alias("txt")), "txt", A.AnswerSchema.of(("k", "int")), "a")
    return parsed.select("event_id", F.col("a.k").alias("k"), F.col("a.status").alias("status"))


# ---------------------------------------------------------------------------
# Nested answers and pages
# ---------------------------------------------------------------------------

from ..functions import prompts as P  # noqa: E402
from ..operators import explode as EX  # noqa: E402
from ..operators.context import invoice_context, ordered_groups, running_history  # noqa: E402

_LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_LINE_ORDER_SQL = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@register(
    "nested_pick",
    sql=f"""SELECT l_orderkey, CAST(len(books) AS INTEGER) AS n_books, books[2].author AS second_author,
  CAST(books[2].year AS INTEGER) AS second_year
FROM (SELECT l_orderkey,
        list({{'title': 'del ' || CAST(l_partkey AS VARCHAR), 'author': 'lev ' || CAST(l_suppkey AS VARCHAR),
              'year': l_linenumber, 'stars': l_quantity}} ORDER BY {_LINE_ORDER_SQL}) AS books
      FROM lineitem GROUP BY l_orderkey)""",
)
def nested_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    fields = {
        "title": F.concat(F.lit("del "), F.col("l_partkey").cast("string")),
        "author": F.concat(F.lit("lev "), F.col("l_suppkey").cast("string")),
        "year": F.col("l_linenumber"),
        "stars": F.col("l_quantity"),
    }
    books = ordered_groups(li, ["l_orderkey"], "l_linenumber", fields, _LINE_TIES, list_col="books")
    # The answer travels as JSON text, as a model would send it, and is parsed back.
    as_text = books.select("l_orderkey", F.to_json(F.struct("books")).alias("response"))
    parsed = as_text.select("l_orderkey", F.from_json("response", A.BOOKS_DDL, A.JSON_OPTIONS).alias("a"))
    second = A.pick("a.books", 2)
    return parsed.select(
        "l_orderkey",
        F.size("a.books").alias("n_books"),
        second["author"].alias("second_author"),
        A.whole_int(second["year"]).alias("second_year"),
    )


def _invoice_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, an invoice answer as JSON text (what the reader's model returns)."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    fields = {
        "fakturalinje_beskrivelse": F.concat(F.lit("del "), F.col("l_partkey").cast("string")),
        "antal": F.col("l_quantity"),
        "linje_beløb": F.col("l_extendedprice"),
    }
    lines = ordered_groups(li, ["l_orderkey"], "l_linenumber", fields, _LINE_TIES, list_col="fakturalinjer")
    inv = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    doc = F.struct(
        F.concat(F.lit("kunde "), F.col("o_custkey").cast("string")).alias("kreditor"),
        F.col("fakturalinjer"),
        F.least(F.size("fakturalinjer"), F.lit(10)).alias("secure"),
    )
    return inv.select("l_orderkey", F.to_json(doc).alias("response"))


@register(
    "explode_answer",
    sql=f"""SELECT l_orderkey, 'kunde ' || CAST(o_custkey AS VARCHAR) AS answer_kreditor,
  CAST(least(count(*) OVER (PARTITION BY l_orderkey), 10) AS INTEGER) AS answer_secure,
  'del ' || CAST(l_partkey AS VARCHAR) AS fakturalinje_beskrivelse,
  CAST(l_quantity AS INTEGER) AS antal, l_extendedprice AS "linje_beløb",
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_SQL}) AS INTEGER) AS linjenummer
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def explode_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ans = _invoice_answers(spark, sf_dir)
    parsed = ans.select("l_orderkey", F.from_json("response", A.INVOICE_DDL, A.JSON_OPTIONS).alias("answer"))
    parsed = parsed.withColumn("answer", F.col("answer").withField("secure", A.whole_int(F.col("answer.secure"))))
    out = EX.explode_answer(parsed, "answer", "fakturalinjer", keep=["l_orderkey"], scalar_fields=["kreditor", "secure"])
    return out.withColumn("antal", A.whole_int(F.col("antal")))


@register(
    "page_explode",
    sql="""SELECT doc_id, CAST(page_no AS INTEGER) AS page_no,
  CAST(doc_id AS VARCHAR) || '_' || CAST(page_no AS VARCHAR) || '.png' AS page_name, page AS content
FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS page_no, unnest(p) AS page
      FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))""",
)
def page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = wide(table(spark, sf_dir, "documents").select("doc_id", "text"))
    pages = EX.page_explode(docs, "doc_id", EX.split_pages("text"))
    return pages.withColumn("content", F.decode("content", "UTF-8"))


# ---------------------------------------------------------------------------
# Context and prompts
# ---------------------------------------------------------------------------

_CTX_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(orders, li["l_orderkey"] == orders["o_orderkey"]).join(cust, F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        "c_name", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_name", "l_quantity", "l_extendedprice",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


_INVOICE_LINES_SQL = """(SELECT c_name, l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, l_quantity,
   l_extendedprice, l_extendedprice / l_quantity AS unit_price
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
   JOIN part ON l_partkey = p_partkey)"""


@register(
    "invoice_context",
    sql=f"""SELECT c_name, l_orderkey, count(*) AS n_lines,
  string_agg(p_name, ' | ' ORDER BY {_LINE_ORDER_SQL}, p_name) AS descriptions
FROM {_INVOICE_LINES_SQL} GROUP BY c_name, l_orderkey""",
)
def q_invoice_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _invoice_lines(spark, sf_dir)
    g = ordered_groups(lines, ["c_name", "l_orderkey"], "l_linenumber", {"d": "p_name"}, _CTX_TIES, list_col="ctx")
    return g.select(
        "c_name", "l_orderkey", F.size("ctx").cast("long").alias("n_lines"),
        F.array_join(F.transform("ctx", lambda x: x["d"]), " | ").alias("descriptions"),
    )


@register(
    "invoice_context_composite",
    sql=f"""SELECT l_suppkey, l_orderkey % 50 AS order_group, count(*) AS n_lines,
  string_agg(CAST(l_orderkey AS VARCHAR) || ':' || p_name, ' | ' ORDER BY l_linenumber, l_orderkey, l_partkey, l_quantity, l_extendedprice) AS descriptions
FROM {_INVOICE_LINES_SQL} GROUP BY l_suppkey, l_orderkey % 50""",
)
def invoice_context_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _invoice_lines(spark, sf_dir).withColumn("order_group", F.col("l_orderkey") % 50)
    g = ordered_groups(
        lines, ["l_suppkey", "order_group"], "l_linenumber",
        {"d": F.concat(F.col("l_orderkey").cast("string"), F.lit(":"), F.col("p_name"))},
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"], list_col="ctx",
    )
    return g.select(
        "l_suppkey", "order_group", F.size("ctx").cast("long").alias("n_lines"),
        F.array_join(F.transform("ctx", lambda x: x["d"]), " | ").alias("descriptions"),
    )


_STATIC_TEMPLATE = "Du er en hjælpsom assistent for en boligadministration.\nSvar kort.\n"


@register("render_static", sql=f"SELECT p_partkey, {O.lit(_STATIC_TEMPLATE)} AS prompt FROM part")
def render_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", P.static_prompt(_STATIC_TEMPLATE).alias("prompt"))


_BRACE_TEMPLATE = "{{JSON}} vare {navn} af mærket {maerke} (type {type}), størrelse {str}; pris {pris}.\n"


@register(
    "render_prompt",
    sql=f"""SELECT p_partkey, {O.render(_BRACE_TEMPLATE, {
        'navn': 'p_name', 'maerke': "'{' || p_brand || '}'", 'type': 'CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END',
        'str': 'p_size', 'pris': 'p_retailprice'})} AS prompt FROM part""",
)
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    variables = {
        "navn": "p_name",
        "maerke": F.concat(F.lit("{"), F.col("p_brand"), F.lit("}")),  # braces in data stay as they are
        "type": F.when(F.col("p_size") % 4 != 0, F.col("p_type")),  # null prints as None
        "str": "p_size",
        "pris": "p_retailprice",
    }
    return part.select("p_partkey", P.render(_BRACE_TEMPLATE, variables).alias("prompt"))


@register(
    "render_prompt_context",
    sql=f"""WITH g AS (
  SELECT c_name, l_orderkey,
    to_json(list({{'fakturalinje': p_name, 'antal': l_quantity, 'stykpris': unit_price}}
                 ORDER BY {_LINE_ORDER_SQL}, p_name, l_quantity, unit_price)) AS faktura
  FROM {_INVOICE_LINES_SQL} GROUP BY c_name, l_orderkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
  {O.render(J.CONTEXT_TEMPLATE, {'kreditor': 'l.c_name', 'faktura': 'g.faktura', 'fakturalinje': 'l.p_name'})} AS prompt
FROM {_INVOICE_LINES_SQL} l JOIN g ON l.c_name = g.c_name AND l.l_orderkey = g.l_orderkey""",
)
def render_prompt_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = R.spread(written(_invoice_lines(spark, sf_dir), "invoice-lines"), run_rows=J.LINE_RUN)  # read for the contexts and for the lines
    ctx = invoice_context(
        lines, ["c_name", "l_orderkey"], "l_linenumber",
        {"fakturalinje": "p_name", "antal": "l_quantity", "stykpris": "unit_price"},
        tie_breakers=_CTX_TIES, as_json=True, context_col="faktura",
    )
    prompt = P.render(J.CONTEXT_TEMPLATE, {"kreditor": "c_name", "faktura": "faktura", "fakturalinje": "p_name"})
    return ctx.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", prompt.alias("prompt"))


@register(
    "chat_context",
    sql="""SELECT conv_id, turn, n_user_msgs, history FROM (
  SELECT conv_id, turn, role,
    count(CASE WHEN role = 'user' THEN 1 END) OVER w AS n_user_msgs,
    array_to_string(list(CASE WHEN role = 'user' THEN text END) OVER w, chr(10)) AS history
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE role = 'user'""",
)
def chat_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    is_user = F.col("role") == "user"
    h = running_history(conv, ["conv_id"], ["turn"], "text", include=is_user)
    return h.filter(is_user).select(
        "conv_id", "turn", F.size("history").cast("long").alias("n_user_msgs"),
        F.array_join("history", "\n").alias("history"),
    )


CHAT_BATCH = 25
CHAT_SYSTEM = "Klassificér hver fakturalinje som materialeindkøb eller tjenesteydelse."


@register(
    "chat_batches",
    sql=f"""SELECT p_partkey, CAST(idx // {CHAT_BATCH} AS BIGINT) AS chat_no, CAST(idx % {CHAT_BATCH} AS BIGINT) AS chat_pos,
  {O.lit(CHAT_SYSTEM)} || chr(10) || array_to_string(list('Fakturalinje: ' || p_name) OVER (
    PARTITION BY idx // {CHAT_BATCH} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), chr(10)) AS chat
FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part)""",
)
def chat_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    idx = row_index(part, ["p_partkey"], name="idx")
    idx = idx.withColumn("chat_no", F.floor(F.col("idx") / CHAT_BATCH).cast("long")).withColumn(
        "chat_pos", (F.col("idx") % CHAT_BATCH).cast("long")
    )
    msg = F.concat(F.lit("Fakturalinje: "), F.col("p_name"))
    h = running_history(idx, ["chat_no"], ["idx"], msg, name="msgs", bounded=True)
    chat = F.concat(F.lit(CHAT_SYSTEM + "\n"), F.array_join("msgs", "\n"))
    return h.select("p_partkey", "chat_no", "chat_pos", chat.alias("chat"))


# ---------------------------------------------------------------------------
# The model stage around the simple job
# ---------------------------------------------------------------------------


def _part_nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.withColumn("p_name", F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")))


@register(
    "null_guard",
    sql=f"""SELECT p_partkey, p_name,
  CASE WHEN p_name IS NULL THEN NULL ELSE klassificering END AS klassificering,
  CASE WHEN p_name IS NULL THEN NULL ELSE score END AS score,
  CASE WHEN p_name IS NULL THEN 'missing' ELSE status END AS status
FROM ({_simple_sql("(SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS p_name FROM part)")})""",
)
def null_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = J.classify_simple(_part_nulled(spark, sf_dir), "p_name", "p_partkey", B.KeywordBackend())
    return out.select("p_partkey", "p_name", J.OUT_LABEL, J.OUT_SCORE, "status")


@register(
    "score_bands",
    sql=f"""SELECT p_partkey, score,
  CASE WHEN score < 1 OR score > 10 THEN 'out_of_range' WHEN score >= 8 THEN 'clear'
       WHEN score >= 3 THEN 'unsure' ELSE 'hard' END AS band,
  score BETWEEN 1 AND 10 AS in_range
FROM ({_simple_sql("part")})""",
)
def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    out = J.classify_simple(part, "p_name", "p_partkey", B.KeywordBackend())
    return out.select(
        "p_partkey", J.OUT_SCORE, A.score_band(J.OUT_SCORE).alias("band"), A.score_in_range(J.OUT_SCORE).alias("in_range")
    )


FAULTY = B.FaultyBackend(raise_every=97)


def _fault_case(k: str = "p_partkey") -> str:
    f = FAULTY
    return (f"CASE WHEN {k} % {f.raise_every} = 0 THEN 'raise' WHEN {k} % {f.none_every} = 0 THEN 'none' "
            f"WHEN {k} % {f.bad_every} = 0 THEN 'bad' WHEN {k} % {f.empty_every} = 0 THEN 'empty' "
            f"WHEN {k} % {f.cut_every} = 0 THEN 'cut' ELSE 'ok' END")


@register(
    "error_isolation",
    sql=f"""SELECT p_partkey,
  CASE WHEN fault = 'ok' THEN klassificering END AS klassificering,
  CASE WHEN fault = 'ok' THEN score END AS score,
  CASE fault WHEN 'ok' THEN 'ok' WHEN 'raise' THEN 'missing' WHEN 'none' THEN 'missing'
             WHEN 'empty' THEN 'empty' ELSE 'invalid' END AS status,
  fault <> 'ok' AS failed
FROM (SELECT *, {_fault_case()} AS fault FROM ({_simple_sql("part")}))""",
)
def error_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    out = J.classify_simple(part, "p_name", "p_partkey", FAULTY)
    return out.select("p_partkey", J.OUT_LABEL, J.OUT_SCORE, "status", F.col("error").isNotNull().alias("failed"))


@register(
    "response_stats",
    sql=f"""SELECT stop_reason, count(*) AS n_rows, count(CASE WHEN fault NOT IN ('raise', 'none') THEN 1 END) AS n_answers,
  count(CASE WHEN fault = 'raise' THEN 1 END) AS n_errors, CAST(sum(n_tokens) AS BIGINT) AS sum_tokens,
  CAST(max(n_tokens) AS INTEGER) AS max_tokens
FROM (SELECT fault,
        CASE fault WHEN 'raise' THEN NULL WHEN 'none' THEN 'failed' ELSE 'eosFound' END AS stop_reason,
        CASE WHEN fault = 'raise' THEN NULL ELSE 7 + length(lab) - length(replace(lab, ' ', '')) END AS n_tokens
      FROM (SELECT *, {_fault_case()} AS fault, {O.keyword_label('needle')} AS lab
            FROM (SELECT *, {O.keyword_needle('prompt')} AS needle
                  FROM (SELECT p_partkey, {_SIMPLE_PROMPT_SQL} AS prompt FROM part))))
GROUP BY stop_reason""",
)
def response_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    prompt = P.render(J.SIMPLE_TEMPLATE, {"key": "p_partkey", "fakturalinje": "p_name"})
    staged = M.call_model(part.select("p_partkey", prompt.alias("prompt")), FAULTY)
    return MT.response_stats(staged)


# ---------------------------------------------------------------------------
# M1, M8, M4, M3: free text, documents, two-stage chains, document reading
# ---------------------------------------------------------------------------

_FREETEXT_PROMPT_SQL = O.render(J.FREETEXT_TEMPLATE, {"fakturalinje": "text"})


def _prose_sql(prompt: str) -> str:
    lab = O.keyword_label(O.keyword_needle(prompt))
    return (f"('<think>' || chr(10) || {prompt} || chr(10) || '</think>' || chr(10) || 'Svaret er **' "
            f"|| {lab} || '**.')")


@register(
    "classify_freetext",
    sql=f"""SELECT doc_id, {_label_sql(O.strip_thinking('r'))} AS label, {O.strip_thinking('r')} AS reason,
  CAST({O.word_count('r')} - {O.word_count(O.strip_thinking('r'))} AS INTEGER) AS thinking_words,
  CAST({O.word_count('r')} AS INTEGER) AS total_words
FROM (SELECT doc_id, {_prose_sql('prompt')} AS r FROM (SELECT doc_id, {_FREETEXT_PROMPT_SQL} AS prompt FROM documents))""",
)
def classify_freetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = J.classify_freetext(docs, "text", B.KeywordBackend(mode="prose"), LABELS)
    return out.select("doc_id", "label", "reason", "thinking_words", "total_words")


DOC_TEMPLATE = "Kilde {kilde}, kvalitet {kvalitet}.\nTekst:\n{tekst}\nSvar med JSON: label, reason.\n"
DOC_BACKEND = B.KeywordBackend(fields=("label", "reason"))


@register(
    "classify_documents",
    sql=f"""SELECT doc_id, quality, {O.normalise(O.keyword_label('needle'))} AS klassificering, 'rule ' || needle AS begrundelse
FROM (SELECT *, {O.keyword_needle('prompt')} AS needle
      FROM (SELECT d.doc_id, l.quality,
              {O.render(DOC_TEMPLATE, {'kilde': 'd.source', 'kvalitet': 'l.quality', 'tekst': 'd.text'})} AS prompt
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))""",
)
def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = docs.join(labels, "doc_id", "left")
    prompt = P.render(DOC_TEMPLATE, {"kilde": "source", "kvalitet": "quality", "tekst": "text"})
    staged = J.structured_answers(d.select("doc_id", "quality", prompt.alias("prompt")), F.col("prompt"), DOC_BACKEND, A.CLASSIFICATION)
    return staged.select(
        "doc_id", "quality", A.normalise_label("answer.label").alias(J.OUT_LABEL), F.col("answer.reason").alias(J.OUT_REASON)
    )


SECOND_TEMPLATE = "Første svar:\n{svar}\nGiv nu label og secure som JSON.\n"
SMALL_BACKEND = B.KeywordBackend(fields=("label", "secure"))


@register(
    "two_stage",
    sql=f"""SELECT doc_id, {O.normalise(O.keyword_label(O.keyword_needle('p2')))} AS klassificering,
  CAST(length(p2) % 12 AS INTEGER) AS score
FROM (SELECT doc_id, {O.render(SECOND_TEMPLATE, {'svar': O.strip_thinking('r')})} AS p2
      FROM (SELECT doc_id, {_prose_sql('prompt')} AS r FROM (SELECT doc_id, {_FREETEXT_PROMPT_SQL} AS prompt FROM documents)))""",
)
def two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = J.two_stage(
        docs, P.render(J.FREETEXT_TEMPLATE, {"fakturalinje": "text"}), B.KeywordBackend(mode="prose"),
        SECOND_TEMPLATE, "svar", SMALL_BACKEND, A.PURCHASE_SMALL, keep=["doc_id"],
    )
    return out.select("doc_id", A.normalise_label("answer.label").alias(J.OUT_LABEL), F.col("answer.secure").alias(J.OUT_SCORE))


@register(
    "read_documents",
    sql=f"""SELECT doc_id, source AS answer_kreditor, CAST(least(len(p), 10) AS INTEGER) AS answer_secure,
  'side ' || CAST(i AS VARCHAR) AS fakturalinje_beskrivelse,
  CAST({O.word_count('p[i]')} AS INTEGER) AS antal, CAST(length(p[i]) AS DOUBLE) AS "linje_beløb",
  CAST(i AS INTEGER) AS linjenummer
FROM (SELECT doc_id, source, p, unnest(range(1, len(p) + 1)) AS i
      FROM (SELECT doc_id, source, string_split(text, chr(10)) AS p FROM documents))""",
)
def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = wide(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    docs = docs.select("doc_id", "source", EX.split_pages("text").alias("pages"))
    out = J.read_documents(docs, "source", "pages", B.PageReaderBackend(), B.InvoiceWriterBackend())
    return out.drop("source", "status", "error")


@register("read_documents_by_cost", sql=SQL["read_documents"])
def read_documents_by_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M3: documents dealt to the reading model's slots by their bytes, so that no slot has far more than its share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    dealt = M.deal_by_cost(docs, F.octet_length("text"), spark.sparkContext.defaultParallelism)
    dealt = dealt.select("doc_id", "source", EX.split_pages("text").alias("pages"))
    return J.read_documents(dealt, "source", "pages", B.PageReaderBackend(), B.InvoiceWriterBackend()).drop("source", "status", "error")


def _filed(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Every document in container files, under the name ``<doc_id>.pdf``."""
    docs = wide(table(spark, sf_dir, "documents").select("doc_id", "text"))
    name, content = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")), F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    D.write_containers(docs, name, content, root)


def _decoded(chosen: DataFrame) -> DataFrame:
    """Stand-in page decoder of the filed documents."""
    return EX.page_explode(chosen.withColumn("_text", F.decode("content", "UTF-8")), "path", EX.split_pages("_text")).select("path", "page_no", "content")


def _register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reader is asked for: every document, and for each one more id that no file has."""
    docs = table(spark, sf_dir, "documents").drop("text")
    return docs.unionByName(docs.withColumn("doc_id", -1 - F.col("doc_id")))


_REGISTER_SQL = f"""WITH d AS (SELECT *, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
x AS (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM d)
SELECT doc_id, source, lang, n_chars, source AS answer_kreditor, CAST(least(len(p), 10) AS INTEGER) AS answer_secure,
  'side ' || CAST(i AS VARCHAR) AS fakturalinje_beskrivelse, CAST({O.word_count('p[i]')} AS INTEGER) AS antal,
  CAST(length(p[i]) AS DOUBLE) AS "linje_beløb", CAST(i AS INTEGER) AS linjenummer, 'ok' AS status, NULL::VARCHAR AS error
FROM x
UNION ALL
SELECT -1 - doc_id, source, lang, n_chars, NULL, NULL, NULL, NULL, NULL, NULL, 'missing', 'no readable page' FROM d"""


@register("read_register", sql=_REGISTER_SQL)
def read_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are written from the documents, scanned, looked up by id, paged and read by both models."""
    root = scratch_path(spark, "register")
    _filed(spark, sf_dir, root)
    files, contents = D.scan_containers(spark, root).select("path"), D.scan_containers(spark, root, with_content=True).select("path", "content")
    out = J.read_register(
        _register(spark, sf_dir), "doc_id", "source", files, contents, _decoded, B.PageReaderBackend(), B.InvoiceWriterBackend()
    )
    return out.drop("doc_path")


@register("doc_scan", sql="SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS length FROM documents")
def doc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of the container files written from the documents."""
    root = scratch_path(spark, "scan")
    _filed(spark, sf_dir, root)
    return D.scan_containers(spark, root).select(EX.base_name("path").cast("long").alias("doc_id"), "length")


# ---------------------------------------------------------------------------
# Advanced jobs: classify each line in its invoice context (J1 + F15 + M2)
# ---------------------------------------------------------------------------

_CTX_PROMPT_SQL = f"""(SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
  {O.render(J.CONTEXT_TEMPLATE, {'kreditor': 'l.c_name', 'faktura': 'g.faktura', 'fakturalinje': 'l.p_name'})} AS prompt
FROM {_INVOICE_LINES_SQL} l JOIN (
  SELECT c_name, l_orderkey,
    to_json(list({{'fakturalinje': p_name, 'antal': l_quantity, 'stykpris': unit_price}}
                 ORDER BY {_LINE_ORDER_SQL}, p_name, l_quantity, unit_price)) AS faktura
  FROM {_INVOICE_LINES_SQL} GROUP BY c_name, l_orderkey) g
ON l.c_name = g.c_name AND l.l_orderkey = g.l_orderkey)"""

ADVANCED_BACKEND = B.KeywordBackend(fields=("label", "reason_for", "reason_against", "secure"))


@register(
    "classify_context",
    sql=f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  {O.normalise(O.keyword_label('needle'))} AS klassificering, CAST(length(prompt) % 12 AS INTEGER) AS score,
  'rule ' || needle AS begrundelse_for, 'no rule before ' || needle AS begrundelse_imod
FROM (SELECT *, {O.keyword_needle('prompt')} AS needle FROM {_CTX_PROMPT_SQL})""",
)
def classify_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _invoice_lines(spark, sf_dir).drop("l_extendedprice")
    out = J.classify_with_context(
        lines, "c_name", "l_orderkey", "l_linenumber", "p_name", "l_quantity", "unit_price", ADVANCED_BACKEND,
        tie_breakers=_CTX_TIES[:3] + ["unit_price"],
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        J.OUT_LABEL, J.OUT_SCORE, J.OUT_REASON_FOR, J.OUT_REASON_AGAINST,
    )


@register(
    "classify_context_small",
    sql=f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  {O.normalise(O.keyword_label('needle'))} AS klassificering, CAST(length(prompt) % 12 AS INTEGER) AS score
FROM (SELECT *, {O.keyword_needle('prompt')} AS needle FROM {_CTX_PROMPT_SQL})""",
)
def classify_context_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _invoice_lines(spark, sf_dir).drop("l_extendedprice")
    out = J.classify_with_context(
        lines, "c_name", "l_orderkey", "l_linenumber", "p_name", "l_quantity", "unit_price", SMALL_BACKEND,
        small_schema=True, tie_breakers=_CTX_TIES[:3] + ["unit_price"],
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", J.OUT_LABEL, J.OUT_SCORE)


# ---------------------------------------------------------------------------
# Pages, search, lookup, token windows
# ---------------------------------------------------------------------------

from ..functions import html as H  # noqa: E402
from ..operators import documents as D  # noqa: E402
from ..operators import search as S  # noqa: E402


# The SQL of the page and label rules is written out on its own, from the
# inventory's text and not from the code's patterns, so that either can be wrong alone.
_ENTITY_SQL = """replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&')"""


def _html_text_sql(h: str, cut: bool = True) -> str:
    parts = f"list_transform(string_split_regex({h}, '(?i)<article\\b'), lambda x: x)[2:]"
    inside = f"array_to_string(list_transform({parts}, lambda x: regexp_extract(x, '(?is)^[^>]*>(.*?)</article>', 1)), ' ')"
    t = f"CASE WHEN {inside} <> '' THEN {inside} ELSE {h} END"
    for block in ("(?is)<script\\b.*?</script>", "(?is)<style\\b.*?</style>", "(?s)<!--.*?-->", "<[^>]*>"):
        t = f"regexp_replace({t}, '{block}', ' ', 'g')"
    words = f"list_filter(string_split_regex({_ENTITY_SQL.format(t)}, '[\\x09-\\x0d ]+'), lambda x: x <> '')"
    joined = f"array_to_string({words}, ' ')"
    return f"substr({joined}, 1, 5000)" if cut else joined


def _title_sql(h: str) -> str:
    t = _ENTITY_SQL.format(f"regexp_extract({h}, '(?is)<title[^>]*>(.*?)</title>', 1)")
    return f"array_to_string(list_filter(string_split_regex({t}, '[\\x09-\\x0d ]+'), lambda x: x <> ''), ' ')"


def _page_words_sql(text: str) -> str:
    """Words of a page: letters, digits and underscores of what white space separates, lower case."""
    split = f"string_split_regex({text}, '[\\s\\x1c-\\x1f]+')"
    return f"list_distinct(list_filter(list_transform({split}, lambda w: lower(regexp_replace(w, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))), lambda w: w <> ''))"


@register("html_text", sql=f"SELECT page_id, {_title_sql('html')} AS title, {_html_text_sql('html')} AS text FROM pages")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wide(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", H.html_title("html").alias("title"), H.html_to_text("html").alias("text"))


# Search requests (user input; the work scales with the pages table).
SEARCH_QUERIES = ((1, "the and of"), (2, "der und die"), (3, "le la des"), (4, "el los las"), (5, "zzqx"))
_QUERIES_SQL = "(VALUES " + ", ".join(f"({i}, {O.lit(q)})" for i, q in SEARCH_QUERIES) + ") q(query_id, query)"


def _queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEARCH_QUERIES), "query_id INT, query STRING")


_SEARCH_SQL = f"""
WITH pw AS (SELECT page_id, unnest({_page_words_sql(_html_text_sql('html', cut=False))}) AS word FROM pages),
qw AS (SELECT query_id, unnest({_page_words_sql('query')}) AS word FROM {_QUERIES_SQL}),
hits AS (SELECT query_id, page_id, count(*) AS score FROM pw JOIN qw USING (word) GROUP BY query_id, page_id),
cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, page_id) AS rank FROM hits) WHERE rank <= 10),
linked AS (SELECT c.query_id, c.rank, c.page_id, CASE WHEN p.url <> '' THEN p.url END AS url,
             CASE WHEN {_title_sql('p.html')} = '' THEN 'Ingen titel' ELSE {_title_sql('p.html')} END AS title, {_html_text_sql('p.html')} AS text
           FROM cand c JOIN pages p USING (page_id)),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS position FROM linked WHERE url IS NOT NULL)
           WHERE position <= 3)"""


@register(
    "search_first_k",
    sql=_SEARCH_SQL + "\nSELECT query_id, CAST(position AS INTEGER) AS position, page_id, title, url, text FROM firsts",
)
def search_first_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.first_pages(wide(table(spark, sf_dir, "pages")), _queries(spark))
    return out.withColumn("position", F.col("position").cast("int"))


@register(
    "search_digest",
    sql=_SEARCH_SQL + """
SELECT query_id, string_agg(printf('SIDE %d:' || chr(10) || 'Titel: %s' || chr(10) || 'URL: %s' || chr(10) || 'Uddrag:' || chr(10) || '%s' || chr(10),
                                   position, title, url, substr(text, 1, 1000)), chr(10) || chr(10) ORDER BY position) AS digest,
       count(*) AS n_pages
FROM firsts GROUP BY query_id""",
)
def search_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.digest(S.first_pages(wide(table(spark, sf_dir, "pages")), _queries(spark)))


@register(
    "doc_lookup",
    sql="""WITH f AS (SELECT regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*?)(\\.[^./]*)?$', 1) AS base_name, url, page_id FROM pages),
firsts AS (SELECT base_name, min(url) AS url, arg_min(page_id, url) AS page_id FROM f GROUP BY base_name)
SELECT d.doc_id, firsts.url AS doc_url, firsts.page_id AS doc_page_id
FROM documents d LEFT JOIN firsts ON CAST(d.doc_id AS VARCHAR) = firsts.base_name""",
)
def doc_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    files = table(spark, sf_dir, "pages").select("url", "page_id")
    out = D.lookup_documents(docs, "doc_id", files, path_col="url", strip_query=True)
    return out.select("doc_id", "doc_url", "doc_page_id")


@register(
    "token_throughput",
    sql="""WITH idx AS (SELECT event_type, epoch_us(ts) AS us, CAST(user_id AS VARCHAR) || ' ' AS tok,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events),
w AS (SELECT event_type, i // 50 AS window_no, count(*) AS n_tokens, min(us) AS first_us, max(us) AS last_us,
    string_agg(tok, '' ORDER BY i) AS text FROM idx GROUP BY event_type, i // 50)
SELECT a.event_type, a.window_no, a.n_tokens, a.text,
  a.last_us - coalesce(p.last_us, a.first_us) AS elapsed_us,
  CASE WHEN a.last_us - coalesce(p.last_us, a.first_us) > 0
       THEN a.n_tokens / ((a.last_us - coalesce(p.last_us, a.first_us)) / 1000000.0::DOUBLE) ELSE 0.0::DOUBLE END AS tokens_per_sec
FROM w a LEFT JOIN w p ON a.event_type = p.event_type AND a.window_no = p.window_no + 1""",
)
def token_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    tok = F.concat(F.col("user_id").cast("string"), F.lit(" "))
    return MT.count_windows(ev, ["event_type"], ["ts", "event_id"], "ts", tok, size=50)


from ..streaming import tokens as TK  # noqa: E402


@register("token_stream", sql=SQL["token_throughput"])
def token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of ``token_throughput`` from a stream that stops half way and goes on."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "user_id")
    base = scratch_path(spark, "token-stream")
    tok = F.concat(F.col("user_id").cast("string"), F.lit(" "))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part, rows in enumerate((events.filter(early), events.filter(~early))):
        rows.write.parquet(f"{base}/landing/part={part}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{base}/landing")
        run = TK.run_token_windows(stream.withColumn("tok", tok), ["event_type"], "ts", "event_id", "tok", f"{base}/out", f"{base}/checkpoint")
    return run.result()


from ..streaming import keyed_tokens as KT  # noqa: E402


@register("token_state", sql=SQL["token_throughput"])
def token_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows on keyed state; the stream stops half way, and a second run goes on from its state."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "user_id")
    base = scratch_path(spark, "token-state")
    tok = F.concat(F.col("user_id").cast("string"), F.lit(" "))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part, rows in enumerate((events.filter(early), events.filter(~early))):
        rows.write.parquet(f"{base}/landing/part={part}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{base}/landing")
        run = KT.run_keyed_token_windows(stream.withColumn("tok", tok), ["event_type"], "ts", "event_id", "tok", f"{base}/out", f"{base}/checkpoint")
    return run.result()


# ---------------------------------------------------------------------------
# Resumable runs (first run stops part way, second resumes)
# ---------------------------------------------------------------------------

from ..config import resolve_every  # noqa: E402
from ..streaming import resume as RS  # noqa: E402

ORDER_TEMPLATE = "Ordre #{key} med prioritet {fakturalinje}.\nSvar med JSON: label, reason, secure.\n"
PRIORITY_RULES = (("urgent", "materialeindkøb"), ("high", "tjenesteydelse"), ("low", "Materiale"))
ORDER_BACKEND = B.KeywordBackend(rules=PRIORITY_RULES)
CRASH_DATE = "1995-01-01"


def _classify_orders(df: DataFrame) -> DataFrame:
    out = J.classify_simple(
        df.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", ORDER_BACKEND,
        template=ORDER_TEMPLATE,
    )
    return out.select("o_orderkey", J.OUT_LABEL, J.OUT_SCORE)


_ORDER_PROMPT_SQL = O.render(ORDER_TEMPLATE, {"key": "o_orderkey", "fakturalinje": "o_orderpriority"})


@register(
    "resume_antijoin",
    sql=f"""SELECT o_orderkey, {O.normalise(O.keyword_label(O.keyword_needle('prompt', PRIORITY_RULES), PRIORITY_RULES))} AS klassificering,
  CAST(length(prompt) % 12 AS INTEGER) AS score
FROM (SELECT o_orderkey, {_ORDER_PROMPT_SQL} AS prompt FROM orders)""",
)
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    path = scratch_path(spark, "resume-antijoin")
    # First run: only the orders before the crash date got done.
    RS.run_resumable(spark, orders.filter(F.col("o_orderdate") < F.lit(CRASH_DATE)), ["o_orderkey"], _classify_orders, path)
    # Second run over everything: the anti join leaves only the rest to do.
    return RS.run_resumable(spark, orders, ["o_orderkey"], _classify_orders, path, save_every=100_000)


#: Rows to a chunk in the runs that crash: enough chunks at any size to crash in a later one.
CRASH_CHUNKS = 4


@register("resume_crash", sql=SQL["resume_antijoin"])
def resume_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run that dies in its first chunk, a second that dies in its last, a third that ends.

    The stage really raises; what was committed stays, and nothing is done twice.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "resume-crash")
    low, high, n = orders.agg(F.min("o_orderkey"), F.max("o_orderkey"), F.count(F.lit(1))).first()

    def dying(key: int):
        crash = F.when(F.col("o_orderkey") == F.lit(key), F.raise_error(F.lit("the worker died"))).otherwise(F.col(J.OUT_LABEL))
        return lambda part: _classify_orders(part).withColumn(J.OUT_LABEL, crash)

    every = -(-n // CRASH_CHUNKS)
    for process in (dying(low), dying(high), _classify_orders):
        try:
            out = RS.run_resumable(spark, orders, ["o_orderkey"], process, path, save_every=every)
        except Exception as exc:  # noqa: BLE001 - only the crash made above
            if "the worker died" not in str(exc):
                raise
    return out


@register("resume_default_saves", sql=SQL["resume_antijoin"])
def resume_default_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saves at the default of every 100 rows, through a run that dies half way and one that ends.

    However many saves that is, a run commits them in at most ``MAX_COMMITS`` micro-batches.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "resume-saves")
    middle = orders.agg(F.expr("percentile(o_orderkey, 0.5)")).first()[0]
    middle = orders.filter(F.col("o_orderkey") >= F.lit(middle)).agg(F.min("o_orderkey")).first()[0]
    crash = F.when(F.col("o_orderkey") == F.lit(middle), F.raise_error(F.lit("the worker died"))).otherwise(F.col(J.OUT_LABEL))
    for process in (lambda part: _classify_orders(part).withColumn(J.OUT_LABEL, crash), _classify_orders):
        try:
            out = RS.run_resumable(spark, orders, ["o_orderkey"], process, path, save_every=resolve_every(None, None))
        except Exception as exc:  # noqa: BLE001 - only the crash made above
            if "the worker died" not in str(exc):
                raise
    return out


@register(
    "resume_schema_growth",
    sql=f"""SELECT o_orderkey, {O.normalise(O.keyword_label(O.keyword_needle('prompt', PRIORITY_RULES), PRIORITY_RULES))} AS klassificering,
  CASE WHEN early THEN CAST(o_custkey % 100 AS BIGINT) ELSE o_custkey * 1000000000 END AS amount,
  CASE WHEN early THEN o_orderstatus END AS status, CASE WHEN NOT early THEN length(prompt) % 12 + 0.5::DOUBLE END AS score,
  o_custkey AS detail_a, CASE WHEN NOT early THEN o_orderpriority END AS detail_b
FROM (SELECT *, o_orderdate < DATE '{CRASH_DATE}' AS early, {_ORDER_PROMPT_SQL} AS prompt FROM orders)""",
)
def resume_schema_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run saved a column that a later one has not, and narrower types; all of it comes back."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "resume-growth")

    def classified(part: DataFrame) -> DataFrame:
        out = J.classify_simple(part, "o_orderpriority", "o_orderkey", ORDER_BACKEND, template=ORDER_TEMPLATE)
        return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", J.OUT_LABEL, J.OUT_SCORE)

    def first(part: DataFrame) -> DataFrame:
        key = F.col("o_custkey")
        return classified(part).select(
            "o_orderkey", J.OUT_LABEL, (key % 100).cast("int").alias("amount"), F.col("o_orderstatus").alias("status"), F.struct(key.alias("a")).alias("detail")
        )

    def second(part: DataFrame) -> DataFrame:
        key = F.col("o_custkey")
        detail = F.struct(key.alias("a"), F.col("o_orderpriority").alias("b"))
        return classified(part).select("o_orderkey", J.OUT_LABEL, (key * F.lit(10**9)).cast("long").alias("amount"), (F.col(J.OUT_SCORE) + 0.5).alias("score"), detail.alias("detail"))

    RS.run_resumable(spark, orders.filter(F.col("o_orderdate") < F.lit(CRASH_DATE)), ["o_orderkey"], first, path)
    out = RS.run_resumable(spark, orders, ["o_orderkey"], second, path, save_every=100_000)
    return out.select("*", F.col("detail.a").alias("detail_a"), F.col("detail.b").alias("detail_b")).drop("detail")


_EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


EVENT_TEMPLATE = "Hændelse #{key} af typen {fakturalinje}.\nSvar med JSON: label, reason, secure.\n"
EVENT_RULES = (("purchase", "materialeindkøb"), ("signup", "tjenesteydelse"), ("click", "Materiale"))
EVENT_BACKEND = B.KeywordBackend(rules=EVENT_RULES)


def _parse_events(batch: DataFrame) -> DataFrame:
    """Per micro-batch: parse the JSON payload, then classify through the model stage."""
    a = A.with_parsed_answer(batch, "props", A.AnswerSchema.of(("k", "int")), "a")
    parsed = a.select("event_id", "event_type", F.col("a.k").alias("k"), F.col("a.status").alias("props_status"))
    out = J.classify_simple(parsed, "event_type", "event_id", EVENT_BACKEND, template=EVENT_TEMPLATE)
    return out.select("event_id", "event_type", "k", F.col("props_status").alias("status"), J.OUT_LABEL, J.OUT_SCORE)


_EVENT_PROMPT_SQL = O.render(EVENT_TEMPLATE, {"key": "event_id", "fakturalinje": "event_type"})


@register(
    "resume_batches",
    sql=f"""SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 'ok' AS status,
  {O.normalise(O.keyword_label(O.keyword_needle('prompt', EVENT_RULES), EVENT_RULES))} AS klassificering,
  CAST(length(prompt) % 12 AS INTEGER) AS score
FROM (SELECT *, {_EVENT_PROMPT_SQL} AS prompt FROM events)""",
)
def resume_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    events = table(spark, sf_dir, "events")
    base = scratch_path(spark, "resume-stream")
    landing, result, ckpt = f"{base}/landing", f"{base}/result", f"{base}/checkpoint"
    schema = T._parse_datatype_string(_EVENT_SCHEMA)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    # Files that landed before the crash: first run handles them.
    # They are cut by size, and come in micro-batches of so many files.
    land = lambda rows, part: rows.write.option("maxRecordsPerFile", 250_000).parquet(f"{landing}/part={part}")
    land(events.filter(early), 1)
    RS.run_stream(spark, landing, schema, _parse_events, result, ckpt, max_files_per_trigger=64)
    # More files land; the rerun with the same checkpoint only reads those.
    land(events.filter(~early), 2)
    out = RS.run_stream(spark, landing, schema, _parse_events, result, ckpt, max_files_per_trigger=64)
    return out.drop("batch_id")


def _nested_invoices(todo: DataFrame, lineitem: DataFrame) -> DataFrame:
    fields = {
        "fakturalinje_beskrivelse": F.concat(F.lit("del "), F.col("l_partkey").cast("string")),
        "antal": F.col("l_quantity"),
        "linje_beløb": F.col("l_extendedprice"),
    }
    lines = ordered_groups(lineitem, ["l_orderkey"], "l_linenumber", fields, _LINE_TIES, list_col="fakturalinjer")
    inv = todo.join(lines, todo["o_orderkey"] == lines["l_orderkey"], "left")
    doc = F.struct(
        F.concat(F.lit("kunde "), F.col("o_custkey").cast("string")).alias("kreditor"),
        F.col("fakturalinjer"),
        F.least(F.size("fakturalinjer"), F.lit(10)).alias("secure"),
    )
    parsed = inv.select("o_orderkey", F.from_json(F.to_json(doc), A.INVOICE_DDL, A.JSON_OPTIONS).alias("a"))
    lines_t = "array<struct<fakturalinje_beskrivelse:string,antal:int,`linje_beløb`:double>>"
    return parsed.select(
        "o_orderkey",
        F.col("a.kreditor").alias("answer_kreditor"),
        A.whole_int(F.col("a.secure")).alias("answer_secure"),
        F.transform("a.fakturalinjer", lambda x: x.withField("antal", A.whole_int(x["antal"]))).cast(lines_t).alias("fakturalinjer"),
    )


@register(
    "resume_exploded",
    sql=f"""SELECT o_orderkey, 'kunde ' || CAST(o_custkey AS VARCHAR) AS answer_kreditor,
  CAST(least(count(*) OVER (PARTITION BY l_orderkey), 10) AS INTEGER) AS answer_secure,
  'del ' || CAST(l_partkey AS VARCHAR) AS fakturalinje_beskrivelse,
  CAST(l_quantity AS INTEGER) AS antal, l_extendedprice AS "linje_beløb",
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_SQL}) AS INTEGER) AS linjenummer
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def resume_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "resume-exploded")

    def process(todo: DataFrame) -> DataFrame:
        # Only the lines of orders still to do are grouped.
        todo_lines = li.join(todo.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        return _nested_invoices(todo, todo_lines)

    RS.run_resumable_exploded(spark, orders.filter(F.col("o_orderdate") < F.lit(CRASH_DATE)), ["o_orderkey"], process,
                              "fakturalinjer", path, position="linjenummer")
    return RS.run_resumable_exploded(spark, orders, ["o_orderkey"], process, "fakturalinjer", path, position="linjenummer")


# ---------------------------------------------------------------------------
# W2 + M2: classify in chats of 25 rows
# ---------------------------------------------------------------------------


@register(
    "classify_chat",
    sql=f"""SELECT p_partkey, p_name, chat_no, {O.normalise(O.keyword_label('needle'))} AS klassificering,
  CAST(length(prompt) % 12 AS INTEGER) AS score
FROM (SELECT *, {O.keyword_needle('prompt')} AS needle
      FROM (SELECT p_partkey, p_name, CAST(idx // 25 AS BIGINT) AS chat_no,
              {O.lit(J.CHAT_SYSTEM_PROMPT)} || array_to_string(list('Fakturalinje: ' || coalesce(p_name, 'nan')) OVER (
                PARTITION BY idx // 25 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), chr(10)) AS prompt
            FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part)))""",
)
def classify_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    out = J.classify_chat(part, "p_name", "p_partkey", B.KeywordBackend())
    return out.select("p_partkey", "p_name", "chat_no", J.OUT_LABEL, J.OUT_SCORE)


# ---------------------------------------------------------------------------
# The job runner (S1, P7, M6, T1, T2, S6, S10), amounts in prompts (F1, F15), F16
# ---------------------------------------------------------------------------

from dataclasses import replace  # noqa: E402

from ..config import JobConfig, ModelParams  # noqa: E402


def _job(spark: SparkSession, sf_dir: str, name: str, text_col: str, save_every: int, delete_work: bool) -> JobConfig:
    work = scratch_path(spark, f"job-{name}")
    return JobConfig(
        os.path.join(sf_dir, f"{name}.parquet"), f"{work}-out.parquet", work, delete_work, text_col, save_every=save_every,
        model=ModelParams(max_tokens=200, temperature=0.3),
    )


@register("job_part", sql=_simple_sql("part"))
def job_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole job over the parts: load, classify with the job's model settings in chunks, write, clean up."""
    config = _job(spark, sf_dir, "part", "p_name", 10_000, delete_work=True)
    out = J.run_job(spark, config, "p_partkey", lambda params: B.KeywordBackend(params=params))
    return out.select("p_partkey", "p_name", J.OUT_LABEL, J.OUT_SCORE, J.OUT_REASON, "status")


JOB_SAVE_EVERY = 50_000


@register(
    "job_progress",
    sql=f"""SELECT rows_done, 'Row: ' || CAST(rows_done AS VARCHAR) AS message
FROM (SELECT least(i * {JOB_SAVE_EVERY}, n) AS rows_done
      FROM (SELECT count(*) AS n FROM orders), range(1, 1000000) t(i) WHERE (i - 1) * {JOB_SAVE_EVERY} < n)""",
)
def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress rows that a job over the orders appended, one for each chunk."""
    config = _job(spark, sf_dir, "orders", "o_orderpriority", JOB_SAVE_EVERY, delete_work=False)
    J.run_job(spark, config, "o_orderkey", lambda params: B.KeywordBackend(rules=PRIORITY_RULES, params=params), ORDER_TEMPLATE)
    return J.job_progress(spark, config).select("rows_done", "message")


@register(
    "job_progress_errors",
    sql=f"""SELECT CAST(i * 500 AS BIGINT) AS rows_done, 'Row: ' || CAST(i * 500 AS VARCHAR) AS message,
  (SELECT count(*) FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS n FROM part) WHERE p_partkey % 13 = 0 AND n <= least(((i * 500 - 1) // 20000 + 1) * 20000, (SELECT count(*) FROM part))) AS errors
FROM range(1, 1000000) t(i) WHERE i * 500 <= (SELECT count(*) FROM part)""",
)
def job_progress_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message every 500 rows (the default), with the failed calls up to the save that passed them."""
    config = _job(spark, sf_dir, "part", "p_name", 20_000, delete_work=False)
    J.run_job(spark, config, "p_partkey", lambda params: B.FaultyBackend(B.KeywordBackend(params=params), none_every=10**9, bad_every=10**9, empty_every=10**9, cut_every=10**9))
    return J.job_progress(spark, config, config.rows_between_progress())


@register("job_freetext", sql=SQL["classify_freetext"])
def job_freetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The free-text job through the runner, saves and output file included."""
    config = replace(_job(spark, sf_dir, "documents", "text", 50_000, delete_work=True), labels=tuple(LABELS))
    out = J.run_job(spark, config, "doc_id", lambda params: B.KeywordBackend(mode="prose"), kind="freetext")
    return out.select("doc_id", "label", "reason", "thinking_words", "total_words")


@register("job_context", sql=SQL["classify_context"])
def job_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The context job through the runner: a run that dies with part of the lines saved, and one that ends.

    Lines are saved in an order that cuts invoices, so prompts hold lines that are done already.
    """
    config = _job(spark, sf_dir, "lineitem", "p_name", 250_000, delete_work=True)
    work = config.work_path
    lines = _invoice_lines(spark, sf_dir).drop("l_extendedprice")
    config = replace(
        config, input_path=f"{work}-in.parquet", creditor_col="c_name", invoice_col="l_orderkey", line_col="l_linenumber", quantity_col="l_quantity", unit_price_col="unit_price"
    )
    with shuffles_freed(spark):
        lines.write.parquet(config.input_path)
    keys = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "unit_price"]
    # The earlier run had the lines of some parts only; its saves are in the work folder.
    all_lines = spark.read.parquet(config.input_path)
    early = replace(config, input_path=f"{work}-early.parquet", delete_work=False)
    early_lines = all_lines.filter(F.col("l_partkey") % 3 == 0)
    run = lambda part: J.classify_with_context(
        part, "c_name", "l_orderkey", "l_linenumber", "p_name", "l_quantity", "unit_price", ADVANCED_BACKEND, tie_breakers=keys, invoices=all_lines
    )
    RS.run_resumable(spark, early_lines, keys, run, f"{early.work_folder}/done")
    out = J.run_job(spark, config, keys, lambda params: ADVANCED_BACKEND, kind="context")
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", J.OUT_LABEL, J.OUT_SCORE, J.OUT_REASON_FOR, J.OUT_REASON_AGAINST
    )


@register("job_reader", sql=_REGISTER_SQL)
def job_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader job with two models through the runner: half of the register first, then all of it.

    Documents done keep a row of their own in the saves, with lines or without, so the second run reads the others only.
    """
    work = scratch_path(spark, "job-reader")
    _filed(spark, sf_dir, f"{work}-files")
    files = D.scan_containers(spark, f"{work}-files").select("path")
    contents = D.scan_containers(spark, f"{work}-files", with_content=True).select("path", "content")
    documents = J.Documents(files, contents, _decoded)
    config = JobConfig(f"{work}-first.parquet", f"{work}-out.parquet", work, creditor_col="source", document_id_col="doc_id", save_every=25_000)
    register_rows = _register(spark, sf_dir)
    register_rows.filter(F.col("doc_id") % 2 == 0).write.parquet(config.input_path)
    models = dict(backend=lambda params: B.PageReaderBackend(), writer=lambda params: B.InvoiceWriterBackend(), kind="reader_dual", documents=documents)
    J.run_job(spark, config, **models)
    config = replace(config, input_path=f"{work}-all.parquet", delete_work=True)
    register_rows.write.parquet(config.input_path)
    return J.run_job(spark, config, **models).drop("doc_path")


AMOUNT_TEMPLATE = "Beløb {beloeb}; sats {sats}; stor {stor}; lille {lille}."


@register(
    "render_amounts",
    sql=f"""SELECT p_partkey, 'Beløb ' || CAST(p_retailprice * 12345.0::DOUBLE AS VARCHAR) || '; sats ' || CAST(p_retailprice / 1e7::DOUBLE AS VARCHAR)
    || '; stor ' || CAST(p_retailprice * 1e15::DOUBLE AS VARCHAR) || '; lille ' || CAST(p_retailprice / 1e12::DOUBLE AS VARCHAR) || '.' AS prompt,
  '[{{"beloeb":' || CAST(p_retailprice * 12345.0::DOUBLE AS VARCHAR) || ',"sats":' || CAST(p_retailprice / 1e7::DOUBLE AS VARCHAR) || '}}]' AS context
FROM part""",
)
def render_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """amounts from 1e7 up and 1e-4 down print as Python prints them, in prompt and context."""
    p = F.col("p_retailprice")
    amounts = {"beloeb": p * F.lit(12345.0), "sats": p / F.lit(1e7), "stor": p * F.lit(1e15), "lille": p / F.lit(1e12)}
    item = P.json_item({k: amounts[k] for k in ("beloeb", "sats")}, {"beloeb", "sats"})
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", P.render(AMOUNT_TEMPLATE, amounts).alias("prompt"), F.concat(F.lit("["), item, F.lit("]")).alias("context"))


STATS_BACKEND = B.KeywordBackend(seconds_per_token=0.125)


@register(
    "stats_lines",
    sql=f"""SELECT p_partkey, '[Row ' || CAST(p_partkey + 1 AS VARCHAR) || '] Tokens/sec: 8.00 | Total tokens: ' || CAST(n_tokens AS VARCHAR) || ' | Stop reason: eosFound' AS message
FROM (SELECT p_partkey, 7 + length(lab) - length(replace(lab, ' ', '')) AS n_tokens
      FROM (SELECT p_partkey, {O.keyword_label('needle')} AS lab
            FROM (SELECT *, {O.keyword_needle('prompt')} AS needle FROM (SELECT p_partkey, {_SIMPLE_PROMPT_SQL} AS prompt FROM part))))""",
)
def stats_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: the statistics line of every response."""
    part = wide(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    prompt = P.render(J.SIMPLE_TEMPLATE, {"key": "p_partkey", "fakturalinje": "p_name"})
    return MT.response_log(M.call_model(part.select("p_partkey", prompt.alias("prompt")), STATS_BACKEND), "p_partkey")


# ---------------------------------------------------------------------------
# F6 with a table of labels, J4 from an index, F8 on VARIANT, W1 in file order
# ---------------------------------------------------------------------------

from ..functions import variants as V  # noqa: E402
from ..operators.labels import labels_from_table  # noqa: E402
from ..operators.ordering import file_ordered_union  # noqa: E402
from ..operators.page_index import PageIndex  # noqa: E402


@register(
    "extract_label_table",
    sql=f"""WITH l AS (SELECT {O.clean_word('w')} AS word, min(w) AS label
    FROM (SELECT unnest({O.words('text')}) AS w FROM benchmark) WHERE length(w) > 9 GROUP BY 1),
a AS (SELECT doc_id, {O.words(O.strip_thinking('answer'))} AS ws FROM {_ANSWERS_SQL}),
w AS (SELECT doc_id, unnest(list_transform(ws, lambda x: {O.clean_word('x')})) AS word, generate_subscripts(ws, 1) AS i FROM a),
f AS (SELECT doc_id, arg_min(label, i) AS label FROM w JOIN l USING (word) WHERE word <> '' GROUP BY doc_id)
SELECT documents.doc_id, label FROM documents LEFT JOIN f USING (doc_id)""",
)
def extract_label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 with labels that are rows: the long words of the benchmark items."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(X.words("text")).alias("label"))
    labels = words.filter(F.length("label") > 9).distinct()
    return labels_from_table(_answers(spark, sf_dir), "answer", labels).select("doc_id", "label")


@register("search_from_index", sql=SQL["search_first_k"])
def search_from_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages are indexed in two goes, the second with all of them; searches read the buckets of their words."""
    pages = wide(table(spark, sf_dir, "pages"))
    index = PageIndex(spark, scratch_path(spark, "page-index"))
    index.add(pages.filter(F.length("html") % 2 == 0))
    index.add(pages)
    out = S.first_pages(pages, _queries(spark), found=index.search(_queries(spark)))
    return out.withColumn("position", F.col("position").cast("int"))


#: Answers in every way a model gives them, made from the parts.
_VARIANT_CASES = (
    """'{"label": "' || p_name || '", "score": ' || CAST(p_size AS VARCHAR) || '}'""",
    """'{"label": null, "score": ' || CAST(p_size AS VARCHAR) || '.5}'""",
    """'{"score": "' || CAST(p_size AS VARCHAR) || '"}'""",
    """'{"label": ["' || p_brand || '"], "score": ' || CAST(p_size AS VARCHAR) || '00000000000}'""",
    """'{"label": "' || p_name""",
    """'[' || CAST(p_size AS VARCHAR) || ']'""",
    """' '""",
)
_VARIANT_CASE = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_VARIANT_CASES)) + " END"


def _variant_state_sql(key: str, kinds: str, extra: str = "true") -> str:
    return f"""CASE WHEN ok THEN CASE WHEN NOT json_exists(j, '$.{key}') THEN 'absent' WHEN json_type(j, '$.{key}') = 'NULL' THEN 'null'
    WHEN json_type(j, '$.{key}') IN ({kinds}) AND {extra} THEN 'value' ELSE 'wrong type' END END"""


@register(
    "variant_answers",
    sql=f"""WITH r AS (SELECT p_partkey, {_VARIANT_CASE} AS t FROM part),
v AS (SELECT *, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j, coalesce(json_valid(t) AND json_type(CASE WHEN json_valid(t) THEN t END) = 'OBJECT', false) AS ok FROM r),
s AS (SELECT *, {_variant_state_sql('label', "'VARCHAR'")} AS label_state,
    {_variant_state_sql('score', "'BIGINT', 'UBIGINT'", "TRY_CAST(json_extract_string(j, '$.score') AS INTEGER) IS NOT NULL")} AS score_state FROM v)
SELECT p_partkey, CASE WHEN t IS NULL THEN 'missing' WHEN trim(t) = '' THEN 'empty' WHEN j IS NULL THEN 'bad json' WHEN NOT ok THEN 'no object' ELSE 'ok' END AS status,
  CASE WHEN label_state = 'value' THEN json_extract_string(j, '$.label') END AS label, label_state,
  CASE WHEN score_state = 'value' THEN CAST(json_extract_string(j, '$.score') AS INTEGER) END AS score, score_state,
  concat_ws('; ', CASE WHEN label_state <> 'value' THEN 'label: ' || label_state END, CASE WHEN score_state = 'wrong type' THEN 'score: wrong type' END) AS violations
FROM s""",
)
def variant_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with values, nulls, absent keys, wrong types, bad JSON, no object, nothing."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(_VARIANT_CASE.replace("VARCHAR", "STRING")).alias("answer"))
    out = V.with_variant_answer(part, "answer", {"label": "string", "score": "int"}, required=("label",))
    return out.select("p_partkey", "status", "label", "label_state", "score", "score_state", F.array_join("violations", "; ").alias("violations"))


@register(
    "union_file_order",
    sql="""WITH o AS (SELECT o_orderkey, o_custkey, NULL::DOUBLE AS o_totalprice, 'up' AS source_name, 0 AS source_ordinal, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders
UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'down', 1, row_number() OVER (ORDER BY o_orderkey DESC) - 1 + (SELECT count(*) FROM orders) FROM orders)
SELECT * FROM o""",
)
def union_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs whose files lie in opposite orders; rows are numbered as they lie, over both."""
    orders, base = table(spark, sf_dir, "orders"), scratch_path(spark, "file-order")
    for source, key, columns in (("up", F.col("o_orderkey").asc(), ["o_orderkey", "o_custkey"]), ("down", F.col("o_orderkey").desc(), ["o_orderkey", "o_totalprice"])):
        orders.select(*columns).repartitionByRange(5, key).sortWithinPartitions(key).write.option("maxRecordsPerFile", 40_000).parquet(f"{base}/{source}")
    return file_ordered_union(spark, {"up": f"{base}/up", "down": f"{base}/down"})


from ..streaming.arrivals import run_arrivals  # noqa: E402


@register(
    "documents_arriving",
    sql="""SELECT doc_id, source, 'ok' AS status, CAST(least(len(string_split(coalesce(text, ''), chr(10))), 10) AS INTEGER) AS answer_secure,
  CAST(len(string_split(coalesce(text, ''), chr(10))) AS INTEGER) AS n_lines FROM documents
UNION ALL SELECT -1 - doc_id, source, 'waiting', NULL, NULL FROM documents""",
)
def documents_arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents land in two goes; each is read in the run after its landing, and register rows without a file wait."""
    base = scratch_path(spark, "arriving")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    register_rows = _register(spark, sf_dir).select("doc_id", "source")
    name, content = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")), F.encode(F.coalesce("text", F.lit("")), "UTF-8")

    def read(found: DataFrame) -> DataFrame:
        pages = found.select("doc_id", "source", EX.split_pages(F.decode("content", "UTF-8")).alias("pages"))
        nested = J.read_documents_nested(pages, "source", "pages", B.PageReaderBackend(), B.InvoiceWriterBackend())
        return nested.select("doc_id", "source", "status", "answer_secure", F.size(J.LINES).alias("n_lines"))

    short = F.col("n_chars") < 1500
    for part, rows in enumerate((docs.filter(short), docs.filter(~F.coalesce(short, F.lit(False))))):
        D.write_containers(wide(rows), name, content, f"{base}/landing/part={part}")
        run = run_arrivals(register_rows, "doc_id", D.stream_containers(spark, f"{base}/landing"), read, f"{base}/out", f"{base}/checkpoint")
    waiting = run.waiting(register_rows).select("doc_id", "source", F.lit("waiting").alias("status"), F.lit(None).cast("int").alias("answer_secure"), F.lit(None).cast("int").alias("n_lines"))
    return run.results().unionByName(waiting)


from ..functions import content as CT  # noqa: E402


def _fragment_sql(x: str) -> str:
    decoded = _ENTITY_SQL.format(f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')")
    return f"array_to_string(list_filter(string_split_regex({decoded}, '[\\x09-\\x0d ]+'), lambda w: w <> ''), ' ')"


@register(
    "page_content",
    sql=f"""WITH s AS (SELECT page_id, string_split_regex(regexp_replace(html, '(?is)<head\\b.*?</head>|<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g'),
    '(?i)</?(p|div|article|section|main|td|th|tr|table|li|ul|ol|dl|dt|dd|h[1-6]|header|footer|nav|aside|body|head|html|title|br|hr|blockquote|pre|form|figure|figcaption)\\b[^>]*>') AS parts FROM pages),
f AS (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM s),
t AS (SELECT page_id, place, {_fragment_sql('part')} AS text, length({_fragment_sql("regexp_replace(part, '(?is)<a\\b[^>]*>.*?</a>', ' ', 'g')")}) AS plain FROM f),
b AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) AS k, text, length(text) - 3 * (length(text) - plain) - 30 AS score FROM t WHERE text <> ''),
p AS (SELECT *, sum(score) OVER (PARTITION BY page_id ORDER BY k) AS upto FROM b),
r AS (SELECT a.page_id, a.k AS from_k, z.k AS to_k, z.upto - a.upto + a.score AS total FROM p a JOIN p z ON a.page_id = z.page_id AND a.k <= z.k),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY total DESC, to_k, from_k DESC) AS rank FROM r) WHERE rank = 1),
kept AS (SELECT b.page_id, string_agg(text, ' ' ORDER BY k) AS text FROM b JOIN best USING (page_id) WHERE total <= 0 OR k BETWEEN from_k AND to_k GROUP BY b.page_id)
SELECT page_id, substr(coalesce(kept.text, ''), 1, 5000) AS text FROM pages LEFT JOIN kept USING (page_id)""",
)
def page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the run of blocks with the best text and link density, of every page."""
    pages = wide(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", CT.content_text("html").alias("text"))
