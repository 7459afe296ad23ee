"""Operator 13: fill-in-middle transformation by displacement scatter.

A text is cut at two unit borders into prefix, middle and suffix, which change places
with a marker before each. All texts of an Arrow batch are handled as one run of bytes:
a scan finds units and cuts; a difference array holds, at the first byte of every part,
how far that part moves further than the one before it; its cumulative sum is the
displacement of every byte, and one numpy scatter puts the bytes into the output. The
way back finds the markers in the output, builds the displacements of the parts in the
same manner, and gathers the text from them; it needs the output and the form alone.
Displacements are worked out block by block, so beside the bytes themselves memory does
not grow with the length of a text.

The draws (two cuts, whether to transform, which form) come from the SHA-256 of a seed
and the key of the row, in Spark expressions. Units are lines with their line feed.

Defined results: a null text counts as empty; an empty text and one that holds a marker
stay plain (null ``prefix_chars`` and ``middle_chars``); a null key draws as an empty
one; rows are independent, so repeated rows repeat; a very long text is handled alone
and whole; an empty table gives an empty result. Columns of the input that bear a name
of the operator's own columns are left out, all others are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .tokens import text_bytes
from .wordtable import slices

SEED = 7
#: Percent of the texts that are transformed, and percent of these that have the suffix first.
RATE, SPM_RATE = 100, 50
# The markers before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
#: Order of the parts (0 prefix, 1 suffix, 2 middle, as their markers) in the output of a form.
ORDER = {PSM: (0, 1, 2), SPM: (1, 0, 2)}
#: Bytes that are moved at a time.
BLOCK = 1 << 22

_LETTERS = np.frombuffer("".join(m[1] for m in MARKERS).encode(), np.uint8)
_MARKS = np.frombuffer("".join(MARKERS).encode(), np.uint8).reshape(3, 3)


def marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, kind and text of every marker that lies inside one text."""
    if len(data) < 3:
        return (np.empty(0, np.int64),) * 3
    at = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")) & np.isin(data[1:-1], _LETTERS))
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 3 <= offsets[text + 1]
    at, text = at[inside], text[inside]
    return at, np.argmax(data[at + 1][:, None] == _LETTERS, axis=1), text


class Moves:
    """Displacement of every byte, from the parts' first bytes (ascending) and where these go."""

    def __init__(self, start: np.ndarray, to: np.ndarray, size: int):
        self.start, self.size = start, size
        self.delta = np.diff(to - start, prepend=0)

    def blocks(self):
        """Consecutive blocks of bytes: first place, and the target of each byte."""
        before = 0
        for lo in range(0, self.size, BLOCK):
            hi = min(lo + BLOCK, self.size)
            a, b = np.searchsorted(self.start, [lo, hi])
            difference = np.zeros(hi - lo, np.int64)
            np.add.at(difference, self.start[a:b] - lo, self.delta[a:b])
            shift = np.cumsum(difference)
            shift += before
            before = shift[-1]
            shift += np.arange(lo, hi)
            yield lo, hi, shift


class Cuts:
    """Units of a batch of texts and the cuts drawn for each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, rate: int = RATE, spm_rate: int = SPM_RATE):
        begin, end = offsets[:-1], offsets[1:]
        feeds = np.flatnonzero(data == ord("\n")) + 1  # where a unit that has its line feed ends
        first = np.searchsorted(feeds, begin, side="right")
        closed = np.searchsorted(feeds, end, side="right") - first
        last = np.where(closed > 0, feeds[np.maximum(first + closed - 1, 0)] if len(feeds) else 0, begin)
        self.units = closed + (last < end)

        def border(u):
            """Where the first ``u`` units end."""
            inner = feeds[np.clip(first + u - 1, 0, len(feeds) - 1)] if len(feeds) else begin
            return np.where(u == 0, begin, np.where(u <= closed, inner, end))

        one, two = draws[:, 0] % (self.units + 1), draws[:, 1] % (self.units + 1)
        self.begin, self.end = begin, end
        self.low, self.high = border(np.minimum(one, two)), border(np.maximum(one, two))
        form = np.where(draws[:, 3] % 100 < spm_rate, SPM, PSM)
        form[(begin == end) | (draws[:, 2] % 100 >= rate)] = PLAIN
        form[marks(data, offsets)[2]] = PLAIN
        self.form = form


def transformed(data: np.ndarray, cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of all texts as bytes and offsets."""
    whole = cuts.end - cuts.begin + np.where(cuts.form == PLAIN, 0, 9)
    offsets = np.concatenate([[0], np.cumsum(whole)])
    begins = np.stack([cuts.begin, cuts.high, cuts.low])  # prefix, suffix, middle
    sizes = np.stack([cuts.low, cuts.end, cuts.high]) - begins
    to = np.broadcast_to(offsets[:-1], begins.shape) + begins - cuts.begin  # plain: as it was
    out = np.empty(offsets[-1], np.uint8)
    for form, order in ORDER.items():
        rows = np.flatnonzero(cuts.form == form)
        at = offsets[rows]
        for part in order:
            out[at[:, None] + np.arange(3)] = _MARKS[part]
            to[part, rows] = at + 3
            at = at + 3 + sizes[part, rows]
    in_text = [0, 2, 1]  # the parts in the order of the text
    for lo, hi, target in Moves(begins[in_text].T.ravel(), to[in_text].T.ravel(), len(data)).blocks():
        out[target] = data[lo:hi]
    return out, offsets


def restored(out: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, from outputs and forms; an output that lacks its markers is an error."""
    sizes = np.diff(offsets)
    at, kind, text = marks(out, offsets)
    at, kind, text = (x[form[text] != PLAIN] for x in (at, kind, text))
    rows = np.flatnonzero(form != PLAIN)
    if len(at) != 3 * len(rows) or (text != np.repeat(rows, 3)).any():
        raise ValueError("an output in psm or spm form has each marker exactly once")
    source = np.broadcast_to(offsets[:-1], (3, len(sizes))).copy()  # of prefix, suffix, middle
    length = np.zeros((3, len(sizes)), np.int64)
    length[0] = np.where(form == PLAIN, sizes, 0)
    ends = at + 3
    until = np.empty_like(at)
    until[:-1] = at[1:]
    until[2::3] = offsets[rows + 1]
    source[kind, text], length[kind, text] = ends, until - ends
    size = np.where(form == PLAIN, sizes, sizes - 9)
    result_offsets = np.concatenate([[0], np.cumsum(size)])
    result = np.empty(result_offsets[-1], np.uint8)
    in_text = [0, 2, 1]
    parts = length[in_text].T.ravel()
    begin = np.concatenate([[0], np.cumsum(parts)])[:-1]
    for lo, hi, origin in Moves(begin, source[in_text].T.ravel(), len(result)).blocks():
        result[lo:hi] = out[origin]
    return result, result_offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _characters(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    count = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return count[end] - count[begin]


OWN = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` without its texts, with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    carried = [c for c in docs.columns if c.lower() not in {*OWN, text_col.lower()}]
    key = F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    draws = F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])
    # Own columns come first and by place, so no name of the input can clash.
    given = docs.select(draws, F.col(f"`{text_col}`"), *[F.col(f"`{c}`") for c in carried])
    schema = tables.fields(docs.select(*[F.col(f"`{c}`") for c in carried]), "n long, form string, prefix_chars long, middle_chars long, output string")

    def run(batches):
        for b in batches:
            offsets = text_bytes(b.column(1))[1]
            for i, j in slices(offsets):
                s = b.slice(i, j - i)
                data, starts = text_bytes(s.column(1))
                cuts = Cuts(data, starts, s.column(0).values.to_numpy()[4 * s.column(0).offset :][: 4 * len(s)].reshape(-1, 4), rate, spm_rate)
                plain = cuts.form == PLAIN
                own = [
                    pa.array(cuts.units), pa.array(np.array(FORMS)[cuts.form]),
                    pa.array(_characters(data, cuts.begin, cuts.low), mask=plain), pa.array(_characters(data, cuts.low, cuts.high), mask=plain),
                    _strings(*transformed(data, cuts)),
                ]
                yield pa.RecordBatch.from_arrays([*s.columns[2:], *own], names=schema.names)

    return given.mapInArrow(run, schema)


def texts_again(made: DataFrame, name: str = "restored") -> DataFrame:
    """``made`` (with ``output`` and ``form``) and the texts rebuilt from these two, as a last column ``name``."""
    name = tables.fresh(made, name)
    schema = tables.fields(made, f"`{name}` string")
    at = {f.lower(): k for k, f in enumerate(made.columns)}
    output, form = at["output"], at["form"]

    def run(batches):
        for b in batches:
            for i, j in slices(text_bytes(b.column(output))[1]):
                s = b.slice(i, j - i)
                kinds = np.array([FORMS.index(f) for f in s.column(form).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([*s.columns, _strings(*restored(*text_bytes(s.column(output)), kinds))], names=schema.names)

    return made.mapInArrow(run, schema)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    again = texts_again(fill_in_middle(docs))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    return again.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


SQL_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines,
    [CAST('0x' || substr(s, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM d),
c AS (SELECT *, len(lines) AS n, least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS lo, greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS hi FROM u),
p AS (SELECT *, array_to_string(lines[1:lo], '') AS pre, array_to_string(lines[lo + 1:hi], '') AS mid, array_to_string(lines[hi + 1:n], '') AS suf,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
