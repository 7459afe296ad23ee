"""The reference's jobs as Spark plans.

Each job takes DataFrames and returns a DataFrame: input columns + answer
columns + ``status`` / ``error``. Nothing is collected; the only Python in the
plan is the backend inside the model stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig, ModelParams
from ..functions import answers as A
from ..functions import prompts as P
from ..functions import text as X
from ..operators.context import CHUNK_ROWS, context_requests, invoice_groups, invoice_requests, keyless_requests
from ..operators.model import BackendSpec, call_model, call_model_joined
from ..session import checkpoint_root, shuffles_freed, written
from ..sources.readers import load_table, spread, write_table

# Output column names of the reference jobs (snake-cased).
OUT_LABEL = "klassificering"
OUT_SCORE = "score"
OUT_REASON = "begrundelse"
OUT_REASON_FOR = "begrundelse_for"
OUT_REASON_AGAINST = "begrundelse_imod"

# Our own template texts (the reference's are not copied).
SIMPLE_TEMPLATE = (
    "Du får en linje fra en faktura.\n"
    "Linje #{key}: {fakturalinje}\n"
    "Svar kun med JSON: label (materialeindkøb eller tjenesteydelse), reason, secure (1-10).\n"
)
FREETEXT_TEMPLATE = "Hvilken type køb er dette?\nTekst: {fakturalinje}\nSkriv dit svar med egne ord.\n"
CONTEXT_TEMPLATE = (
    "Kreditor: {kreditor}\n"
    "Alle linjer på fakturaen (JSON): {faktura}\n"
    "Klassificér denne linje: {fakturalinje}\n"
    "Svar med JSON: label, reason_for, reason_against, secure (1-10).\n"
)


def structured_answers(
    df: DataFrame,
    prompt: Column | str,
    backend: BackendSpec,
    schema: A.AnswerSchema,
    slots: int | str | None = "auto",
) -> DataFrame:
    """M2: prompt -> model -> parsed ``answer`` struct (+ response, error ...).

    ``prompt`` is a Column, or the name of a column of ``df`` holding it.
    An under-partitioned input is widened before the prompt is rendered, so
    the shuffle moves the inputs, not the longer prompts.
    """
    if slots == "auto":
        df = spread(df)
    df = df.withColumnRenamed(prompt, "prompt") if isinstance(prompt, str) else df.withColumn("prompt", prompt)
    staged = call_model(df.withColumn("_sent", F.col("prompt").isNotNull()), backend, slots=slots)
    return A.with_parsed_answer(staged, "response", schema)


def _finish(staged: DataFrame, outputs: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    ans = F.col("answer")
    cols = [F.col(c) for c in keep]
    for field, name in outputs.items():
        val = ans[field]
        if field == "label":
            val = A.normalise_label(val)
        cols.append(val.alias(name))
    # Row-level error: the call failed, or the answer lacks a usable label.
    error = F.coalesce(
        F.col("error"),
        F.when(ans["status"].isin("empty", "invalid"), F.concat(F.lit("answer "), ans["status"])),
        F.when((ans["status"] == "ok") & ans["label"].isNull(), F.lit("answer has no label")),
        F.when((ans["status"] == "missing") & F.col("_sent"), F.lit("no answer")),
    )
    cols += [ans["status"].alias("status"), ans["violations"].alias("violations"), error.alias("error")]
    return staged.select(*cols)


def classify_simple(
    df: DataFrame,
    text_col: str,
    key_col: str,
    backend: BackendSpec,
    template: str = SIMPLE_TEMPLATE,
    on_null: str = "skip",
    slots: int | str | None = "auto",
) -> DataFrame:
    """Classify one line (simple job): label, score, reason per row.

    ``on_null='skip'`` sends no prompt for null text (outputs null);
    ``on_null='text'`` sends the text ``nan`` in its place, as the source's
    simple job does.
    """
    null_text = None if on_null == "skip" else P.NULL_TEXT
    prompt = P.render(template, {"key": key_col, "fakturalinje": text_col}, null_text=null_text)
    if on_null == "skip":
        prompt = F.when(F.col(text_col).isNotNull(), prompt)
    staged = structured_answers(df, prompt, backend, A.PURCHASE_SIMPLE, slots)
    outputs = {"label": OUT_LABEL, "secure": OUT_SCORE, "reason": OUT_REASON}
    return _finish(staged, outputs, df.columns)


def classify_freetext(
    df: DataFrame,
    text_col: str,
    backend: BackendSpec,
    labels: Sequence[str],
    template: str = FREETEXT_TEMPLATE,
    remove_thinking: bool = True,
    slots: int | str | None = "auto",
) -> DataFrame:
    """Free-text job: prose answer -> label by word scan, reason, word counts."""
    prompt = F.when(F.col(text_col).isNotNull(), P.render(template, {"fakturalinje": text_col}))
    if slots == "auto":
        df = spread(df)
    staged = call_model(df.withColumn("prompt", prompt), backend, slots=slots)
    r = F.col("response")
    return staged.select(
        *[F.col(c) for c in df.columns],
        X.extract_label(r, labels, remove_thinking).alias("label"),
        X.answer_without_thinking(r, remove_thinking).alias("reason"),
        X.thinking_word_count(r).alias("thinking_words"),
        F.when(r.isNotNull(), X.word_count(r)).alias("total_words"),
        F.col("error"),
    )


#: Lines that stay together where few splits are spread over the cores: an invoice's lines mostly stand together.
LINE_RUN = 1 << 12


def classify_with_context(
    lines: DataFrame,
    creditor: str,
    invoice: str,
    line_no: str,
    text_col: str,
    quantity: str,
    unit_price: str,
    backend: BackendSpec,
    small_schema: bool = False,
    template: str = CONTEXT_TEMPLATE,
    tie_breakers: Sequence[str] = (),
    slots: int | str | None = "auto",
    chunk_rows: int = CHUNK_ROWS,
    invoices: DataFrame | None = None,
) -> DataFrame:
    """Advanced job: each line is classified with all lines of its invoice.

    ``invoices`` has all lines, where ``lines`` are only those still to classify.

    The invoice context is built once per invoice (J1, F15) and goes to the model
    stage beside what is left of its lines' prompts; the stage puts a prompt together when
    it sends it. Lines are shuffled once, by invoice, and all else is made where they meet
    (``invoice_requests``). An invoice of more than ``chunk_rows`` lines to classify is
    sent in chunks that are dealt over all tasks (``context_requests``). The lines are
    written once to the shared folder first, since they are counted and then read.
    """
    keys = [creditor, invoice]
    lines = written(lines, "invoice-lines")
    fields = {"fakturalinje": text_col, "antal": quantity, "stykpris": unit_price}
    parts = F.when(F.col(text_col).isNotNull(), P.render_around(template, "faktura", {"kreditor": creditor, "fakturalinje": text_col}))
    # Requests are dealt out evenly: adaptive coalescing goes by bytes, but the work is calls.
    setting = str(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    auto = max(lines.sparkSession.sparkContext.defaultParallelism, int(setting) if setting.isdigit() else 0)
    slots = auto if slots == "auto" else int(slots or 0)
    counted = lines.groupBy(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    large = written(counted.filter((F.col("_n") > chunk_rows) & F.col("_b0").isNotNull() & F.col("_b1").isNotNull()).drop("_n"), "large-invoices")
    is_large = [F.col(k) == F.col(f"_b{i}") for i, k in enumerate(keys)]
    none = large.isEmpty()
    usual = lines if none else lines.join(large, is_large, "left_anti")
    requests = invoice_requests(usual, keys, line_no, fields, parts, tie_breakers, invoices, slots)
    requests = requests.unionByName(keyless_requests(spread(lines), keys, parts))
    if not none:
        several = lines.join(large, is_large, "left_semi")
        groups = invoice_groups((lines if invoices is None else invoices).join(large, is_large, "left_semi"), keys, line_no, fields, tie_breakers)
        chunks = context_requests(spread(several, run_rows=LINE_RUN), keys, groups, parts, chunk_rows)
        requests = requests.unionByName(chunks.repartition(slots) if slots else chunks)
    staged = call_model_joined(requests, backend).withColumn("_sent", F.col(text_col).isNotNull())
    staged = A.with_parsed_answer(staged, "response", A.PURCHASE_SMALL if small_schema else A.PURCHASE_ADVANCED)
    outputs = {"label": OUT_LABEL, "secure": OUT_SCORE}
    if not small_schema:
        outputs.update({"reason_for": OUT_REASON_FOR, "reason_against": OUT_REASON_AGAINST})
    return _finish(staged, outputs, lines.columns)


def two_stage(
    df: DataFrame,
    prompt1: Column,
    backend1: BackendSpec,
    template2: str,
    answer_var: str,
    backend2: BackendSpec,
    schema2: A.AnswerSchema,
    keep: Sequence[str],
    remove_thinking: bool = True,
    checkpoint: bool = False,
) -> DataFrame:
    """M4: the first answer becomes a variable of the second prompt.

    With ``checkpoint`` the first stage's output is written to the shared
    checkpoint folder before the second stage reads it, so a failure in the
    second stage never repeats first-stage calls.
    """
    s1 = call_model(df.select(*keep, prompt1.alias("prompt")), backend1)
    r = F.col("response")
    s1 = s1.select(*keep, (X.strip_thinking(r) if remove_thinking else r).alias("_answer1"), F.col("error").alias("_error1"))
    if checkpoint:
        checkpoint_root(df.sparkSession)
        s1 = s1.checkpoint(eager=True)
    prompt2 = P.render(template2, {answer_var: "_answer1"}, null_text=None)
    s2 = structured_answers(s1, prompt2, backend2, schema2)
    return s2.select(*keep, "answer", F.coalesce("_error1", "error").alias("error"))


# Our own reader templates.
READER_TEMPLATE_1 = "Læs alle sider af fakturaen og skriv teksten ud side for side.\n"
READER_TEMPLATE_2 = "Kreditor: {kreditor}\nFakturatekst:\n{faktura_text}\nUdtræk kreditor og fakturalinjer som JSON.\n"


def read_documents(
    docs: DataFrame,
    creditor_col: str,
    pages_col: str,
    reader: BackendSpec,
    writer: BackendSpec,
    checkpoint: bool = False,
    request_rows: int = 8,
) -> DataFrame:
    """Reader job (M3 + M4 + F10): all pages of a document -> text -> invoice
    JSON -> one row per invoice line, numbered from 1.

    ``pages_col`` is ``ARRAY<BINARY>`` in page order. Output: all other input
    columns, the answer's creditor and score, the line fields and number, and
    ``status`` / ``error``. A document that fails anywhere (no readable page, a
    failed call, an answer that is no invoice) gives one row with null line fields,
    its status and error, as a sound answer without lines gives none.
    ``request_rows`` documents go to the reader at once, fewer of many bytes, which
    bounds the images that a worker holds.
    """
    nested = read_documents_nested(docs, creditor_col, pages_col, reader, writer, checkpoint, request_rows)
    lines = nested.select(*[c for c in nested.columns if c != LINES], F.posexplode_outer(LINES).alias("_pos", "_line"))
    lines = lines.filter(F.col("_pos").isNotNull() | F.col("error").isNotNull())
    fields = [F.col("_line")[f].alias(f) for f in ("fakturalinje_beskrivelse", "antal", "linje_beløb")]
    keep = [c for c in nested.columns if c not in (*READER_OWN, LINES)]
    number = (F.col("_pos") + 1).cast("int").alias("linjenummer")
    return lines.select(*[F.col(f"`{c}`") for c in keep], "answer_kreditor", "answer_secure", *fields, number, "status", "error")


#: The answer's lines in ``read_documents_nested``, and the columns of the reader job beside them.
LINES = "fakturalinjer"
READER_OWN = ("answer_kreditor", "answer_secure", "status", "error")


def read_documents_nested(
    docs: DataFrame, creditor_col: str, pages_col: str, reader: BackendSpec, writer: BackendSpec, checkpoint: bool = False, request_rows: int = 8
) -> DataFrame:
    """``read_documents`` before its lines are exploded: one row per document, its lines in the array ``fakturalinjer``."""
    keep = [c for c in docs.columns if c != pages_col]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")  # input names cannot clash with the stages' own
    s1 = call_model(
        docs.select(row, F.col(creditor_col).alias("_creditor"), pages_col, P.static_prompt(READER_TEMPLATE_1).alias("prompt")),
        reader, request_cols=[pages_col], passthrough=["_row", "_creditor"], request_rows=request_rows,
    )
    error1 = F.coalesce("error", F.when(F.col("response").isNull(), F.lit("no readable page")))
    s1 = s1.select("_row", "_creditor", F.col("response").alias("_text"), error1.alias("_error1"))
    if checkpoint:
        checkpoint_root(docs.sparkSession)
        s1 = s1.checkpoint(eager=True)
    prompt2 = F.when(F.col("_error1").isNull(), P.render(READER_TEMPLATE_2, {"kreditor": "_creditor", "faktura_text": "_text"}))
    s2 = call_model(s1.select("_row", "_error1", prompt2.alias("prompt")), writer)
    raw = s2.select("_row", "_error1", "error", "response", F.from_json("response", A.INVOICE_DDL, A.JSON_OPTIONS).alias("_a"))
    status = (
        F.when(F.col("response").isNull(), F.lit("missing"))
        .when(F.trim("response") == "", F.lit("empty"))
        .when(F.col("_a").isNull() | F.col(f"_a.{A.CORRUPT}").isNotNull(), F.lit("invalid"))
        .otherwise(F.lit("ok"))
    )
    judged = raw.select("_row", "_a", "_error1", "error", status.alias("status"))
    error = F.coalesce("_error1", "error", F.when(F.col("status") != "ok", F.concat(F.lit("answer "), F.col("status"))))
    good = F.col("status") == "ok"
    own = (*READER_OWN, LINES, "fakturalinje_beskrivelse", "antal", "linje_beløb", "linjenummer")
    line = lambda x: F.struct(x["fakturalinje_beskrivelse"].alias("fakturalinje_beskrivelse"), A.whole_int(x["antal"]).alias("antal"), x["linje_beløb"].alias("linje_beløb"))
    return judged.select(
        *[F.col("_row")[c].alias(c) for c in keep if c.lower() not in own],
        F.when(good, F.coalesce("_a.kreditor", F.lit(""))).alias("answer_kreditor"), F.when(good, A.whole_int(F.col("_a.secure"))).alias("answer_secure"),
        F.when(good, F.transform("_a.fakturalinjer", line)).alias(LINES), "status", error.alias("error"),
    )


def read_register(
    register: DataFrame, id_col: str, creditor_col: str, files: DataFrame, contents: DataFrame, decoder, reader: BackendSpec, writer: BackendSpec,
    path_col: str = "path", name: Column | None = None, request_rows: int = 8, nested: bool = False,
) -> DataFrame:
    """The reader job end to end: register row -> document by id -> pages -> model -> lines.

    ``files`` lists paths only, ``contents`` has path and content: a path is chosen
    first (J2), and the bytes of chosen files alone are read and joined. ``decoder``
    maps content to page rows, ``page_no`` and ``content`` (F12); rows of one document
    are put together again in page order (M3). A register row without a document, or
    whose document has no page, ends as a row with its error. With ``nested`` there is one
    row per register row, its lines in an array.
    """
    from ..operators.documents import lookup_documents, pages_of

    found = lookup_documents(register, id_col, files, path_col, name=name)
    paths = found.select(f"doc_{path_col}").filter(F.col(f"doc_{path_col}").isNotNull()).distinct()
    chosen = contents.join(paths, contents[path_col] == paths[f"doc_{path_col}"], "left_semi")
    pages = pages_of(decoder(chosen), path_col, "page_no", "content").withColumnRenamed(path_col, "_path")
    whole = found.join(pages, found[f"doc_{path_col}"] == pages["_path"], "left").drop("_path")
    read = read_documents_nested if nested else read_documents
    return read(whole, creditor_col, "pages", reader, writer, request_rows=request_rows)


CHAT_SYSTEM_PROMPT = "Klassificér hver fakturalinje som materialeindkøb eller tjenesteydelse. Svar som JSON.\n"
CHAT_USER_TEMPLATE = "Fakturalinje: {fakturalinje}"


def classify_chat(
    df: DataFrame,
    text_col: str,
    order_col: str,
    backend: BackendSpec,
    batch_rows: int = 25,
    system_prompt: str = CHAT_SYSTEM_PROMPT,
    slots: int | str | None = "auto",
) -> DataFrame:
    """Chat job (W2 + M2): rows in ``order_col`` order are cut into chats of
    ``batch_rows``; each call sees the system prompt, every earlier user message
    of its chat and its own (the model's replies are not added, as in the
    source). Positions come from the distributed ``row_index``; each chat is a
    window partition of at most ``batch_rows`` rows.
    """
    from ..operators.context import running_history
    from ..operators.ordering import row_index

    idx = row_index(df, [order_col], name="_chat_idx")
    idx = idx.withColumn("chat_no", F.floor(F.col("_chat_idx") / F.lit(batch_rows)).cast("long"))
    msg = P.render(CHAT_USER_TEMPLATE, {"fakturalinje": text_col})
    hist = running_history(idx, ["chat_no"], ["_chat_idx"], msg, name="_msgs", bounded=True)
    prompt = F.concat(F.lit(system_prompt), F.array_join("_msgs", "\n"))
    chats = hist.withColumn("_chat_prompt", prompt).drop("_msgs")
    staged = structured_answers(chats, "_chat_prompt", backend, A.PURCHASE_SIMPLE, slots)
    outputs = {"label": OUT_LABEL, "secure": OUT_SCORE, "reason": OUT_REASON}
    return _finish(staged, outputs, [*df.columns, "chat_no"])


#: Kinds of jobs that ``run_job`` runs, with the templates they have of their own.
JOB_TEMPLATES = {
    "simple": SIMPLE_TEMPLATE,
    "freetext": FREETEXT_TEMPLATE,
    "context": CONTEXT_TEMPLATE,
    "context_small": CONTEXT_TEMPLATE,
    "reader": None,  # one model reads and writes
    "reader_dual": None,  # a vision model and a text model
}


@dataclass(frozen=True)
class Documents:
    """What a reader job reads besides its register: listed paths, paths with contents, and how contents become pages."""

    files: DataFrame
    contents: DataFrame
    decoder: Callable[[DataFrame], DataFrame]
    name: Column | None = None


def run_job(
    spark: SparkSession,
    config: JobConfig,
    key_col: str | Sequence[str] | None = None,
    backend: Callable[[ModelParams], BackendSpec] | None = None,
    template: str | None = None,
    schema=None,
    kind: str = "simple",
    documents: Documents | None = None,
    writer: Callable[[ModelParams], BackendSpec] | None = None,
) -> DataFrame:
    """A whole job of any kind: load, resume, work, save, report, write, clean up.

    The input is read by its suffix (S1); what earlier runs saved is left out (J3); the
    rest is saved every ``save_every`` rows in key order under ``<work_folder>/done``
    (``resume.run_resumable``), with columns that may differ from those of earlier runs
    (S9). ``backend`` gets the job's model settings (M6). Rows and errors so far can be
    read while the job runs (``job_progress``, T2). At the end the result is written to
    ``output_path`` by its suffix (S6), and the work folder goes if the job says so
    (S10). Returns the table as written.

    Columns come from the config: the text, the labels (``freetext``), creditor, invoice,
    line number, quantity and unit price (``context``; the prompt holds all lines of the
    invoice, those done before included), creditor and document id (``reader``). A reader
    job needs ``documents``; its result has a row per invoice line, and one for each
    document that failed; ``reader_dual`` has a model of its own, ``writer``, for the
    second stage. Keys are ``key_col``, by default the config's (the document id for readers).
    """
    from ..streaming import resume

    if kind not in JOB_TEMPLATES:
        raise ValueError(f"no job of kind {kind!r}; there are {sorted(JOB_TEMPLATES)}")
    reads = kind.startswith("reader")
    if backend is None or (reads and documents is None) or (kind == "reader_dual" and writer is None):
        raise ValueError(f"a {kind} job needs its model" + (", documents and, with two models, a writer" if reads else ""))
    done = f"{config.work_folder}/done"
    rows = load_table(spark, config.input_path, schema)
    model, template = backend(config.model), template or JOB_TEMPLATES[kind]
    keys = [key_col] if isinstance(key_col, str) else list(key_col or [config.document_id_col if reads else config.key_col])
    text_col, every = config.text_col, config.rows_between_saves()

    def work(part: DataFrame) -> DataFrame:
        if kind == "simple":
            return classify_simple(part, text_col, keys[0], model, template)
        if kind == "freetext":
            return classify_freetext(part, text_col, model, config.labels, template)
        if reads:
            second = writer(config.model) if writer is not None else model
            d = documents
            return read_register(part, config.document_id_col, config.creditor_col, d.files, d.contents, d.decoder, model, second, name=d.name, nested=True)
        return classify_with_context(
            part, config.creditor_col, config.invoice_col, config.line_col, text_col, config.quantity_col, config.unit_price_col, model,
            small_schema=kind == "context_small", template=template, tie_breakers=keys, invoices=rows,
        )

    if reads:
        failed = F.col("error").isNotNull()
        result = resume.run_resumable_exploded(spark, rows, keys, work, LINES, done, position="linjenummer", save_every=every, keep=failed)
    else:
        result = resume.run_resumable(spark, rows, keys, work, done, save_every=every)
    with shuffles_freed(spark):
        write_table(result, config.output_path, mode="overwrite")
    out = load_table(spark, config.output_path, result.schema)
    if config.delete_work:
        resume.delete_results(spark, config.work_folder)
    return out


def job_progress(spark: SparkSession, config: JobConfig, every: int | None = None) -> DataFrame:
    """``rows_done``, ``errors`` and ``message`` of a job, while it runs or later.

    A row for each save; with ``every`` (``config.rows_between_progress()`` is the job's
    own) for each multiple of so many rows.
    """
    from ..streaming.saves import SavedTable

    return SavedTable(spark, f"{config.work_folder}/done").progress(every)
