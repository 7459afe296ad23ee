"""The model stage (M1-M8): a pluggable backend called over Arrow batches.

``call_model`` wraps ``mapInArrow``. Spark keeps the stage a single physical
operator (a plain UDF could be duplicated by projection collapsing), so each row
is sent once per task attempt. Only the request columns are turned into pandas
for the backend; every other column passes through as Arrow. The backend is built from a hashable spec once per
Python worker (M7) and receives whole pandas batches; failures are isolated per
row (M5): a slice that raises is asked again one by one, and only the bad rows
get an ``error`` and null outputs. Rows whose prompt is null are never sent (P1).

Backends are user code; ``operators.standins`` has deterministic ones for tests,
the oracle queries and the benchmark.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE_FIELDS = (
    T.StructField("response", T.StringType()),
    T.StructField("n_tokens", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("stop_reason", T.StringType()),
    T.StructField("error", T.StringType()),
)
RESPONSE_COLUMNS = [f.name for f in RESPONSE_FIELDS]


class Backend(Protocol):
    """``respond`` gets a frame with a ``prompt`` column (plus any request
    columns) and returns a frame of the same length with some of
    ``response, n_tokens, seconds, stop_reason, error``."""

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame: ...


class BackendSpec(Protocol):
    """Hashable, picklable recipe; ``build()`` runs once per Python worker."""

    def build(self) -> Backend: ...


_WORKER_BACKENDS: dict = {}


def worker_backend(spec: BackendSpec) -> Backend:
    """M7: one backend per spec per Python worker process."""
    be = _WORKER_BACKENDS.get(spec)
    if be is None:
        be = spec.build()
        _WORKER_BACKENDS[spec] = be
    return be


#: Values of the response columns, a list each.
Answers = dict[str, list]


def _missing(v) -> bool:
    return v is None or v is pd.NA or v != v


def _number(v, kind):
    try:
        return None if _missing(v) else kind(v)
    except (TypeError, ValueError):
        return None


def _conform(out: pd.DataFrame, n: int, elapsed: float) -> Answers:
    """The response columns of a backend's frame, with None for what is missing or no number."""
    if len(out) != n:
        raise ValueError(f"backend returned {len(out)} answers for {n} requests")
    res: Answers = {}
    for c in RESPONSE_COLUMNS:
        given = out[c].tolist() if c in out.columns else [None] * n
        if c == "n_tokens":
            res[c] = [_number(v, lambda x: int(float(x))) for v in given]
        elif c == "seconds":
            res[c] = [_number(v, float) for v in given] if c in out.columns else [elapsed / n] * n
        else:
            res[c] = [None if _missing(v) else v for v in given]
    return res


def _failure(exc: Exception) -> Answers:
    return {c: [f"{type(exc).__name__}: {exc}" if c == "error" else None] for c in RESPONSE_COLUMNS}


def respond_isolated(backend: Backend, requests: pd.DataFrame) -> Answers:
    """M5: call the slice; if the call raises, ask for its requests one by one.

    A backend that knows which of its requests failed says so in ``error`` and no
    request is repeated. One that raises for a whole slice costs each request of
    that slice one more call, and never more: at most two calls a request.
    """
    n = len(requests)
    if n == 0:
        return {c: [] for c in RESPONSE_COLUMNS}
    req = requests.reset_index(drop=True)
    t0 = time.perf_counter()
    try:
        return _conform(backend.respond(req), n, time.perf_counter() - t0)
    except Exception as exc:  # noqa: BLE001 - isolated below
        failed = exc
    if n == 1:
        return _failure(failed)
    res: Answers = {c: [] for c in RESPONSE_COLUMNS}
    for i in range(n):
        t0 = time.perf_counter()
        try:
            one = _conform(backend.respond(req.iloc[i : i + 1].reset_index(drop=True)), 1, time.perf_counter() - t0)
        except Exception as exc:  # noqa: BLE001 - this request alone gets the error
            one = _failure(exc)
        for c in RESPONSE_COLUMNS:
            res[c] += one[c]
    return res


#: Requests sent to a backend at once, unless the job says otherwise.
REQUEST_ROWS = 64
#: Bytes of requests that are sent at once and that a worker holds as pandas; a larger request goes alone.
REQUEST_BYTES = 16 << 20
#: Rows of an Arrow batch that are pandas at one time.
SLICE_ROWS = 1024

_ARROW_TYPES = {"response": pa.string(), "n_tokens": pa.int32(), "seconds": pa.float64(), "stop_reason": pa.string(), "error": pa.string()}


def _arrays(answers: Answers) -> list[pa.Array]:
    return [pa.array(answers[c], _ARROW_TYPES[c]) for c in RESPONSE_COLUMNS]


def request_bytes(column: pa.Array) -> np.ndarray:
    """Bytes that each value of a column takes: texts, binary values and lists of them."""
    kind = column.type
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        inner = np.concatenate([[0], np.cumsum(request_bytes(column.flatten()))])
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
        return inner[ends] - inner[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0, np.int64)
    if pa.types.is_struct(kind):
        return sum((request_bytes(column.field(k)) for k in range(kind.num_fields)), np.zeros(len(column), np.int64))
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.full(len(column), 8, np.int64)


def cut(sizes: np.ndarray, rows: int, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``rows`` items and ``most`` bytes; a larger item is a range of its own."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        before = ends[i - 1] if i else 0
        j = min(i + rows, max(i + 1, int(np.searchsorted(ends, before + most, side="right"))))
        yield i, j
        i = j


def _answers(backend: Backend, requests: pd.DataFrame, sizes: np.ndarray, request_rows: int) -> list[pa.Array]:
    """The response columns for a frame of requests; a null prompt is never sent."""
    res: Answers = {c: [None] * len(requests) for c in RESPONSE_COLUMNS}
    rows = np.flatnonzero(requests["prompt"].notna().to_numpy())
    for i, j in cut(sizes[rows], request_rows, REQUEST_BYTES):
        some = rows[i:j]
        got = respond_isolated(backend, requests.iloc[some])
        for c in RESPONSE_COLUMNS:
            for k, v in zip(some.tolist(), got[c]):
                res[c][k] = v
    return _arrays(res)


def call_model(
    df: DataFrame,
    backend: BackendSpec,
    prompt_col: str = "prompt",
    request_cols: Sequence[str] = (),
    slots: int | str | None = "auto",
    keep_prompt: bool = False,
    passthrough: Sequence[str] | None = None,
    checkpoint: bool = False,
    dedupe: bool = False,
    request_rows: int = REQUEST_ROWS,
) -> DataFrame:
    """Run the model stage; output = input columns + RESPONSE_FIELDS.

    The prompt column is dropped from the output unless ``keep_prompt``: it is
    usually the widest column and would otherwise cross Arrow a second time.
    ``passthrough`` names the input columns to carry to the output (default:
    all but the prompt), e.g. to leave page images behind after the call.

    ``dedupe`` calls the model once per distinct request (prompt plus request
    columns) and joins the answers back: right only for a deterministic model
    (temperature 0), so it is off by default, as the source calls once per row.
    The distinct step combines map-side, and a prompt shared by a third of the
    rows is one call and one skew-split join key, not a hot task.

    ``request_rows`` caps how many requests go to one ``respond`` call (each
    Arrow batch is sliced): it bounds what a raising call repeats, and the memory
    of a call with page images.

    ``checkpoint`` runs the stage now and keeps its output in the shared
    checkpoint folder (a reliable checkpoint, lineage cut). Use it when the
    answers are shuffled on their own values or read twice: a real model is not
    deterministic, and a stage recomputed after an executor loss must not give
    a second, different answer for rows already routed by the first.

    Select only the columns you need before calling: ``mapInArrow`` is a
    column-pruning barrier, so everything that goes in crosses Arrow twice.

    ``slots`` is the number of concurrent calls. An int forces exactly that
    many partitions (an explicit repartition, so AQE coalescing cannot shrink
    model parallelism). ``"auto"`` repartitions only a shuffle-free input with
    fewer partitions than the cluster has cores (a small input read as one
    file split would otherwise call the model from a single task); a large
    input keeps its partitioning and nothing is shuffled. ``None`` never
    shuffles.
    """
    clash = {c.lower() for c in df.columns} & set(RESPONSE_COLUMNS)
    if clash:
        raise ValueError(f"input already has model output columns {sorted(clash)}; rename them first")
    if dedupe:
        req = [prompt_col, *request_cols]
        uniq = df.select(*req).filter(F.col(prompt_col).isNotNull()).dropDuplicates(req)
        answers = call_model(uniq, backend, prompt_col, request_cols, slots, keep_prompt=True, checkpoint=checkpoint,
                             request_rows=request_rows)
        keep = [c for c in df.columns if (keep_prompt or c != prompt_col)]
        if passthrough is not None:
            keep = [c for c in keep if c in set(passthrough) or (keep_prompt and c == prompt_col)]
        # Null request columns match too: a request is its prompt and all of them.
        right = answers.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(req)], *RESPONSE_COLUMNS)
        cond = [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(req)]
        joined = df.join(right, on=cond, how="left")
        return joined.select(*[F.col(c) for c in keep], *RESPONSE_COLUMNS)
    passed = [f for f in df.schema.fields if keep_prompt or f.name != prompt_col]
    if passthrough is not None:
        wanted = set(passthrough) | ({prompt_col} if keep_prompt else set())
        passed = [f for f in passed if f.name in wanted]
    schema = T.StructType(passed + list(RESPONSE_FIELDS))
    out_cols = [f.name for f in passed]
    req_cols = [prompt_col, *request_cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrow in, Arrow out: only the request columns become pandas for the
        # backend; pass-through columns go back untouched (no conversion).
        be = worker_backend(backend)
        for whole in batches:
            sizes = sum(request_bytes(whole.column(c)) for c in req_cols)
            for start, end in cut(sizes, SLICE_ROWS, REQUEST_BYTES):
                rb = whole.slice(start, end - start)
                req = pa.Table.from_batches([rb]).select(req_cols).to_pandas().rename(columns={prompt_col: "prompt"})
                arrays = [rb.column(c) for c in out_cols] + _answers(be, req, sizes[start:end], request_rows)
                yield pa.RecordBatch.from_arrays(arrays, names=out_cols + RESPONSE_COLUMNS)

    from ..session import ship_package

    ship_package(df.sparkSession)
    if slots == "auto":
        from ..sources.readers import spread

        df = spread(df)
    elif slots:
        df = df.repartition(int(slots))
    out = df.mapInArrow(run, schema)
    if checkpoint:
        from ..session import checkpoint_root

        checkpoint_root(df.sparkSession)  # the shared folder (created only in tests)
        out = out.checkpoint(eager=True)
    return out


def call_model_joined(requests: DataFrame, backend: BackendSpec, request_rows: int = REQUEST_ROWS) -> DataFrame:
    """The model stage for lines that share a context.

    ``requests`` has ``context`` (text) and ``lines``, an array of ``row`` (a struct)
    and ``parts`` (pieces of the prompt; null sends nothing). A line's prompt is its
    parts joined by the context, put together here, in the task that sends it: the
    context travels once for all lines of a row. Output: one row per line, the
    columns of ``row`` and the response fields.
    """
    from ..session import ship_package

    ship_package(requests.sparkSession)
    row = requests.schema["lines"].dataType.elementType["row"].dataType
    clash = {f.name.lower() for f in row.fields} & set(RESPONSE_COLUMNS)
    if clash:
        raise ValueError(f"input already has model output columns {sorted(clash)}; rename them first")
    names = [f.name for f in row.fields] + RESPONSE_COLUMNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        be = worker_backend(backend)
        for b in batches:
            lines, contexts = b.column("lines").flatten(), b.column("context")
            owner = np.repeat(np.arange(b.num_rows), pc.fill_null(pc.list_value_length(b.column("lines")), 0).to_numpy())
            shared = request_bytes(contexts)
            for k in range(0, len(lines), SLICE_ROWS):
                some, mine = lines.slice(k, SLICE_ROWS), owner[k : k + SLICE_ROWS]
                parts = some.field("parts")
                # A prompt's bytes: its parts, and the context between them.
                sizes = request_bytes(parts) + shared[mine] * np.maximum(0, pc.fill_null(pc.list_value_length(parts), 0).to_numpy() - 1)
                res: Answers = {c: [None] * len(some) for c in RESPONSE_COLUMNS}
                sent = np.flatnonzero(parts.is_valid().to_numpy(zero_copy_only=False))
                for i, j in cut(sizes[sent], request_rows, REQUEST_BYTES):
                    # Prompts exist for one call at a time.
                    rows, texts = sent[i:j].tolist(), {}
                    for r in rows:
                        if mine[r] not in texts:
                            texts[mine[r]] = contexts[int(mine[r])].as_py()
                    asked = pd.DataFrame({"prompt": pd.Series([texts[mine[r]].join(parts[r].as_py()) for r in rows], dtype=object)})
                    got = respond_isolated(be, asked)
                    for c in RESPONSE_COLUMNS:
                        for r, v in zip(rows, got[c]):
                            res[c][r] = v
                yield pa.RecordBatch.from_arrays([*some.field("row").flatten(), *_arrays(res)], names)

    return requests.select("context", "lines").mapInArrow(run, T.StructType([*row.fields, *RESPONSE_FIELDS]))


def deal_by_cost(df: DataFrame, cost: Column, slots: int) -> DataFrame:
    """M1, M3: the rows of ``df`` in ``slots`` partitions of about equal total ``cost``, for calls that take as long as they are large.

    A row of more than a share, of which there are fewer than slots, has a slot to itself.
    The costs of the others are summed up along the rows as they lie in the input (sums
    by input partition first, so only a number for each of these, the few large rows and
    a bound for each slot reach the driver), and the line of all costs is cut into equal
    parts. A row goes where its middle lies, so a slot has its share and at most one row
    more. ``df`` is read twice: give a table as it was written, not a plan that may come
    out in another order. Null and negative costs count as none.
    """
    spark = df.sparkSession
    weight = F.greatest(F.coalesce(cost.cast("double"), F.lit(0.0)), F.lit(0.0))
    costs = df.select(F.monotonically_increasing_id().alias("_id"), weight.alias("_cost"))
    costs = costs.withColumn("_part", F.shiftright("_id", 33))
    sums = {r["_part"]: r["s"] for r in costs.groupBy("_part").agg(F.sum("_cost").alias("s")).collect()}  # a number a partition
    total = sum(sums.values())
    if not total:
        return df.repartition(slots)
    is_large = F.col("_cost") > F.lit(total / slots)
    large = costs.filter(is_large).collect() if slots > 1 else []  # fewer than slots
    for r in large:
        sums[r["_part"]] -= r["_cost"]
    rest = slots - len(large)
    total = sum(sums.values())
    starts, before = {}, 0.0
    for part in sorted(sums):
        starts[part], before = before, before + sums[part]
    offsets = spark.createDataFrame(list(starts.items()), "_part LONG, _before DOUBLE")
    along = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    small = costs.filter(~is_large) if large else costs
    running = small.withColumn("_sum", F.sum("_cost").over(along)).join(offsets, "_part")
    middle = F.col("_before") + F.col("_sum") - F.col("_cost") / 2
    slot = F.least(F.floor(middle * rest / F.lit(max(total, 1e-300))), F.lit(rest - 1)).cast("int")
    firsts = {r["slot"]: r["first"] for r in running.groupBy(slot.alias("slot")).agg(F.min("_id").alias("first")).collect()}  # a bound a slot
    # Slots follow each other along the ids, so the last bound that is not after a row names its slot.
    bounds, numbers = F.lit([firsts[k] for k in sorted(firsts)]), F.lit([int(k) for k in sorted(firsts)])
    place = F.get(numbers, F.size(F.filter(bounds, lambda b: b <= F.col("_id"))) - 1) if firsts else F.lit(0)
    for k, r in enumerate(large):
        place = F.when(F.col("_id") == F.lit(r["_id"]), F.lit(rest + k)).otherwise(place)
    named = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_slot", place)
    return named.repartitionById(slots, "_slot").drop("_id", "_slot")
