"""Operator 10: packing by non-negative least squares on the length histogram.

1. Every text is encoded once, the end id appended, and cut at multiples of the
   window: whole windows, and one remainder. Pieces are written to the shared
   folder with their length class (length rounded up to ``UNIT`` ids) and their
   rank within (partition, class).
2. The histogram of the classes has at most ``window / UNIT`` rows: bounded,
   whatever the corpus holds. On it alone, all combinations of at most ``DEPTH``
   classes that fill a window are enumerated, and non-negative least squares
   gives how often each repeats. Counts are rounded down (and held to what there
   is), and what is left is packed greedily, largest class first, again on counts.
3. The plan is a short table: class, range of ranks, sequences. A piece's global
   rank in its class (its rank in the partition plus the pieces of earlier
   partitions) finds its sequence by a join with that table; offsets in a
   sequence are a running sum over its few pieces.

Every id lies in exactly one piece and no piece is dropped: the greedy step ends
only when the histogram is empty. Pieces of a sequence are never longer together
than the window, because classes round up.

Defined results: a null text counts as empty and is its end id alone, one piece
of length 1; a null key stays null; repeated rows are packed each on their own;
ties between pieces of one class go by partition and place; an empty table packs
into nothing; other input columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables
from .tokens import encoder, grouped, id_arrays, vocabulary_path

WINDOW = 2048
UNIT = 16
DEPTH = 3
END_ID = 1
#: Bytes of ids to a task that sorts pieces with their ids into sequences.
TASK_BYTES = 16 << 20


# -- the plan, on the histogram -------------------------------------------------


def combinations(total: int, depth: int, most: int | None = None) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` classes that sum to ``total``, largest class first."""
    most = min(most or total, total)
    found = [(total,)] if total <= most else []
    if depth > 1:
        for first in range(min(most, total - 1), 0, -1):
            if first * depth >= total:
                found += [(first, *rest) for rest in combinations(total - first, depth - 1, first)]
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative least squares by active sets: min |a x - b| with x >= 0."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    small = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= small:
            break
        active[best] = True
        while True:
            s = np.zeros_like(x)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (s <= 0)
            if not low.any():
                x = s
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = x + step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
    return x


def plan_sequences(histogram: dict[int, int], classes: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(classes of a sequence, how often): uses up the histogram exactly."""
    left = np.zeros(classes + 1, np.int64)
    for k, n in histogram.items():
        left[k] = n
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...], times: int) -> None:
        if times > 0:
            plan.append((combo, int(times)))
            for k, m in Counter(combo).items():
                left[k] -= m * times

    take((classes,), left[classes])
    combos = [c for c in combinations(classes, depth) if len(c) > 1 and all(left[k] >= m for k, m in Counter(c).items())]
    if combos:
        a = np.zeros((classes, len(combos)))
        for j, c in enumerate(combos):
            for k in c:
                a[k, j] += 1
        x = nnls(a, left[:classes].astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            take(combos[j], min(int(x[j]), *(left[k] // m for k, m in Counter(combos[j]).items())))
    while left.any():
        combo, room, rest = [], classes, left.copy()
        while room and (fits := np.flatnonzero(rest[: room + 1])).size:
            k = int(fits[-1])
            m = int(min(rest[k], room // k))
            combo += [k] * m
            rest[k] -= m
            room -= k * m
        take(tuple(combo), min(left[k] // m for k, m in Counter(combo).items()))
    return plan


def plan_rows(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple]:
    """The plan by class: (class, first rank, end rank, pieces a sequence, first sequence, first slot)."""
    rows, used, sequence = [], Counter(), 0
    for combo, times in plan:
        slot = 0
        for k, m in Counter(combo).items():
            rows.append((k, used[k], used[k] + m * times, m, sequence, slot))
            used[k] += m * times
            slot += m
        sequence += times
    return rows


# -- the jobs -------------------------------------------------------------------


def cut_pieces(
    docs: DataFrame, path: str, window: int = WINDOW, unit: int = UNIT, end_id: int = END_ID, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of at most a window: ``doc_id, start, length, doc_tokens, ids``, with class, partition and rank."""
    slim = docs.select(F.col(key_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], np.uint32)
    schema = tables.fields(slim.select("doc_id"), "start long, length long, doc_tokens long, class int, part int, nth long, ids binary")

    def cut(batches):
        own, part, seen = encoder(path), TaskContext.get().partitionId(), Counter()
        for b in batches:
            at = 0
            for rows in grouped((np.concatenate([x, end]) for x in own.texts(b.column(1))), len, 1 << 20):
                pieces = [(at + i, s, len(x), x[s : s + window]) for i, x in enumerate(rows) for s in range(0, len(x), window)]
                at += len(rows)
                kind = [-(-len(p[3]) // unit) for p in pieces]
                nth = []
                for k in kind:
                    nth.append(seen[k])
                    seen[k] += 1
                columns = [
                    b.column(0).take(pa.array([p[0] for p in pieces], pa.int64())), pa.array([p[1] for p in pieces], pa.int64()),
                    pa.array([len(p[3]) for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.int64()), pa.array(kind, pa.int32()),
                    pa.array([part] * len(pieces), pa.int32()), pa.array(nth, pa.int64()), id_arrays([p[3] for p in pieces]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return slim.mapInArrow(cut, schema)


def assign(pieces: DataFrame, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> DataFrame:
    """``sequence_id`` and ``offset`` for written pieces; their other columns are carried along."""
    if window % unit:
        raise ValueError("the window must be a multiple of the unit")
    spark, classes = pieces.sparkSession, window // unit
    each = pieces.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["class"]: r["n"] for r in each.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # <= classes rows
    rows = plan_rows(plan_sequences(histogram, classes, depth))
    plan = spark.createDataFrame(rows, "class int, low long, high long, many int, sequence long, slot int")
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that its true size decides how it is joined: a row for each partition and class.
    before = tables.written(each.select("part", "class", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")), "ranks")
    carried = [c for c in pieces.columns if c not in ("class", "part", "nth")]
    ranked = pieces.join(before, ["part", "class"]).select(*carried, "class", (F.col("_before") + F.col("nth")).alias("_rank"))
    # The plan has a few hundred rows, by the number of classes alone.
    hit = (ranked["class"] == plan["class"]) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    placed = ranked.join(F.broadcast(plan), hit).select(
        *carried,
        (F.col("sequence") + F.floor((F.col("_rank") - F.col("low")) / F.col("many"))).cast("long").alias("sequence_id"),
        (F.col("slot") + (F.col("_rank") - F.col("low")) % F.col("many")).alias("_slot"),
    )
    if "ids" in carried:
        # Ids make rows of up to four bytes a token: tasks go by them, whatever the session's number of partitions.
        held = 4 * unit * sum(k * n for k, n in histogram.items())
        placed = placed.repartition(max(1, -(-held // TASK_BYTES)), "sequence_id")
    inside = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*carried, "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, path: str, **cut) -> DataFrame:
    """Packed pieces with their ids: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``."""
    return assign(tables.written(cut_pieces(docs, path, **cut), "pieces"), cut.get("window", WINDOW), cut.get("unit", UNIT))


def packed_digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``pack`` with a digest of the ids instead of the ids, taken before pieces move."""
    pieces = tables.written(cut_pieces(docs, path), "pieces")
    return assign(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "class", "part", "nth"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(tables.table(spark, sf_dir, "documents"), vocabulary_path())
