"""Operator 5: personal data by candidate gradient boosting.

1. Base rules give the spans that always stay: e-mail, IP, card (Luhn) and phone
   patterns, leftmost and non-overlapping for each kind.
2. High-recall generators propose further, overlapping spans: number groups inside
   longer runs, numbers without a plus sign, written-out addresses and the like.
3. Boosted trees (numpy, histogram splits, logistic loss) score a candidate by
   format features (digits, separators, groups, check digit, largest part, what
   stands next to it) and context features (words and digits around it).
   They learn from the corpus itself. Right ones are base spans, their copies next to
   another one, and base spans written anew in the forms the generators cover
   (:func:`varied`: plus dropped, other groups, '@' and dots written out), each in
   the span's own context. Wrong ones are candidates that fail a check of their kind
   (:func:`fails`) and damaged copies of right ones (:func:`damaged`). A candidate
   that touches no base span and fails no check is no example: it is what is sought.
   All of them are used. So that no kind decides alone, the right and the wrong ones of a
   kind count as at most ``SORT_WEIGHT`` examples together, each the same. Examples of
   equal bins are one row with their number; of more than ``IN_MEMORY`` such rows Spark
   sums the gradients by node, feature and bin, a job for each level of a tree, and the
   driver gets these sums alone. They are sums of whole numbers, the same in any order.
4. A third of them, by the span they come from, is held back to calibrate: for each
   kind the least threshold with a precision of ``PRECISION`` over it. A kind without
   such a threshold adds nothing.
   Candidates over the threshold that overlap no base span are added, best first.

All patterns are linear in the text: runs of number characters are found by one
scan and patterns are applied within them; addresses grow from their marker. A text
that is one long run of letters, digits or plus signs is no danger.

Defined results: a null text counts as empty and has no spans; offsets are code
points, end exclusive; rows are judged one by one, so repeated rows repeat; a null
key stays null; an empty table gives an empty result; other input columns are
carried along or not looked at, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables

KINDS = ("email", "ip", "card", "phone")
#: What the examples of a kind, right or wrong, count as together, however many more there are.
SORT_WEIGHT = 2_500
#: Weights and gradients are summed as multiples of 1 / UNIT: whole numbers that a double holds exactly.
UNIT = 2.0**38
PRECISION = 0.995
#: Rows of different bins up to which the driver sums them itself, as a job a level would take longer.
IN_MEMORY = 20_000
#: Steps of the score from 0 to 1: scores within one share a threshold.
SCORE_STEPS = 1 << 14
ROUNDS, DEPTH, BINS, RATE = 40, 3, 32, 0.25
#: Characters of context looked at on either side of a candidate.
CONTEXT = 24
#: Longer base spans are not written anew (no generator covers such a form).
LONGEST = 320

# The base patterns, in forms that cannot backtrack far.
_RUN = re.compile(r"\+?[0-9][0-9 ().+\-]*")  # every ip, card and phone match lies within one
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ \-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9\-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")

# Generators of further candidates, within a run of number characters or around a marker.
_MORE = (
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])")),
    (2, re.compile(r"(?<![0-9])(?:[0-9]{4}[ \-]){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])\+?[0-9]{1,3}[ .\-]?\(?[0-9]{2,4}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])")),
)
_MARKER = re.compile(r"@|\(at\)|\[at\]")
_BEFORE = re.compile(r"[\w.+%\-]")
_HOST = re.compile(r" ?[\w\-]++")
_PART = re.compile(r" ?(?:\.|\(dot\)|\[dot\]) ?[\w\-]++")
#: Parts of a host after the first at each of which it may end; a longer host ends there or with its last part.
ENDS = 4
_GOES_ON = re.compile(r"\.\w| ?(?:\(dot\)|\[dot\]) ?\w")
_SECRET = re.compile(r"token|password|secret|key|version|licen[sc]e", re.I)
_PERSON = re.compile(r"mail|tel|phone|call|fax|card|visa|contact|address|\bip\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules, by kind and start."""
    found: list[list[tuple[int, int, int]]] = [[], [], [], []]
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found[0].append((0, start, done := domain.end()))
        at = text.find("@", max(at + 1, done))
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 2:
            continue
        own, off = run.group(), run.start()
        if "." in own:
            found[1] += [(1, off + m.start(), off + m.end()) for m in _IP.finditer(own) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(own):
            if 16 <= m.end() - m.start() <= 40 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                found[2].append((2, off + m.start(), off + m.end()))
        if "+" in own:
            found[3] += [(3, off + m.start(), off + m.end()) for m in _PHONE.finditer(own) if 8 <= len(_digits(m.group())) <= 15]
    return [s for kind in found for s in kind]


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans the generators propose; they may overlap each other and the base spans."""
    found = []
    if "@" in text or "(at)" in text or "[at]" in text:
        done = 0  # no character is looked at for more than two markers
        for m in _MARKER.finditer(text):
            start = end = m.start() - (text[m.start() - 1 : m.start()] == " ")
            while start > done and _BEFORE.match(text[start - 1]):
                start -= 1
            done = m.end()
            part = _HOST.match(text, m.end()) if 0 <= start < end else None
            ends = []  # where the name of the host ends is for the trees
            while part and (part := _PART.match(text, part.end())):
                ends.append(part.end())
            found += [(0, start, e) for e in (ends if len(ends) <= ENDS else [*ends[:ENDS], ends[-1]])]
    for run in _RUN.finditer(text):
        if run.end() - run.start() >= 7:
            found += [(kind, run.start() + m.start(), run.start() + m.end()) for kind, p in _MORE for m in p.finditer(run.group())]
    return found


def issued(digits: str) -> bool:
    """Whether cards have numbers of this length and beginning; from 16 digits on any beginning."""
    return len(digits) >= 16 or digits.startswith({15: ("34", "37"), 14: ("30", "36", "38", "39"), 13: "4"}.get(len(digits), ()))


def fails(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a candidate fails a check of its kind."""
    own = text[start:end]
    if kind == 0:  # a number, or a dot that ends a sentence
        return ". " in own or not any(c.isalpha() for c in _last(own))
    if kind == 1:
        return any(int(p) > 255 for p in own.split("."))
    if kind == 2:
        return not luhn(_digits(own)) or not issued(_digits(own))
    return text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()


def _last(address: str) -> str:
    return re.split(r"[.)\]] ?", address)[-1]


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate; nothing of the document beyond CONTEXT characters."""
    own, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(own)
    groups = re.findall(r"[0-9]+", own)
    seps = [c for c in own if not c.isalnum()]
    near = before[-1:], after[:1]
    return [
        kind, len(own), len(digits), len(groups), max((len(g) for g in groups), default=0), min((len(g) for g in groups), default=0),
        float(luhn(digits)) if kind == 2 and digits else -1.0, float(min(999, max(int(g[:4]) for g in groups))) if kind == 1 and groups else -1.0,
        len(seps), len(set(seps)), float(own[:1] == "+"), float("(" in own and ")" in own), float("@" in own), len(own.rpartition(".")[2]) if kind == 0 else -1.0,
        float(near[0].isalnum()), float(near[1].isalnum()), float(near[0] in "+.-" and near[0] != ""), float(near[1] in ".-" and near[1] != ""),
        sum(c in "0123456789" for c in before) / max(1, len(before)), sum(c in "0123456789" for c in after) / max(1, len(after)),
        float(bool(_SECRET.search(before))), float(bool(_PERSON.search(before))),
        float(issued(digits)) if kind == 2 else -1.0, *_address(own, after, kind),
    ]


def _address(own: str, after: str, kind: int) -> list[float]:
    """How an address is written: its marker and the spaces beside it, its dots, its last part, whether it goes on."""
    marker = _MARKER.search(own) if kind == 0 else None
    if not marker:
        return [-1.0] * 7
    left, right = own[: marker.start()][-1:] == " ", own[marker.end() :][:1] == " "
    return [
        float(marker.group() != "@"), float(left), float(right), float("(dot)" in own or "[dot]" in own),
        float(". " in own), float(any(c.isalpha() for c in _last(own))), float(bool(_GOES_ON.match(after))),
    ]


N_FEATURES = 30


def crowded(text: str, kind: int, start: int, end: int) -> tuple[str, int, int, int]:
    """A right candidate next to another one: what a base rule may lose to a match across both."""
    a, own, b = text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT]
    if zlib.crc32(own.encode()) % 4 < 2:
        return a + own + " " + own + b, kind, len(a), len(a) + len(own)
    a += own + " "
    return a + own + b, kind, len(a), len(a) + len(own)


def _made(a: str, own: str, b: str, kind: int) -> tuple[str, int, int, int]:
    return a + own + b, kind, len(a), len(a) + len(own)


def _phones(digits: str) -> list[str]:
    """A number in other groups, with its country code and without."""
    own, forms = digits[-10:], []
    for sep in " -.":
        forms.append(sep.join((own[:3], own[3:6], own[6:])))
        if 10 < len(digits) <= 13:
            forms.append(sep.join((digits[:-10], *forms[-1].split(sep))))
    return forms + ([f"{digits[:-10]} ({own[:3]}) {own[3:6]}-{own[6:]}"] if 10 < len(digits) <= 13 else [])


def _with_check_digit(digits: str) -> str:
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def _hosts(host: str) -> list[str]:
    """A host and one with more or fewer parts, so that their number decides nothing."""
    parts = host.split(".")
    return [host, ".".join(parts[-2:]) if len(parts) > 2 else "mail." + host]


def varied(text: str, kind: int, start: int, end: int) -> list[tuple[str, int, int, int]]:
    """A base span in the other forms that the generators cover, in its own context."""
    a, own, b = text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT]
    digits, out = _digits(own), []
    if kind == 0:
        local, _, host = own.rpartition("@")
        for at, dot in (("(at)", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", "."), (" @ ", "."), ("(at)", "(dot)"), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("@", "[dot]"), ("@", " (dot) ")):
            out += [_made(a, local + at + h.replace(".", dot), b, kind) for h in _hosts(host)]
    elif kind == 2:
        for n, first in ((13, "4"), (14, "36"), (15, "34"), (15, "37")):
            out.append(_made(a, _with_check_digit((first + digits[len(first) :])[: n - 1]), b, kind))
        if len(digits) == 16:
            out += [_made(a, sep.join(digits[i : i + 4] for i in range(0, 16, 4)), b, kind) for sep in " -"]
        out.append(_made(a, digits, b, kind))
    elif kind == 3:
        out.append(_made(a, own.lstrip("+"), b, kind))
        if len(digits) >= 10:
            out += [_made(a, form, b, kind) for form in _phones(digits)]
            own = digits[-10:]
            out.append(_made(a + "(", f"{own[:3]}) {own[3:6]}-{own[6:]}", b, kind))
            cue = ("tel ", "phone: ", "call ", "fax ")[zlib.crc32(own.encode()) % 4]
            out += [_made(a + cue, own, b, kind), _made(a + cue, digits, b, kind)]
    # A number without any separator is a telephone's by what stands before it only.
    return [m for m in out if kind != 3 or not m[0][m[2] : m[3]].isdigit() or _PERSON.search(m[0][max(0, m[2] - CONTEXT) : m[2]])]


def damaged(text: str, kind: int, start: int, end: int) -> list[tuple[str, int, int, int]]:
    """Wrong copies of a right candidate, in its context."""
    a, own, b = text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT]
    digits = _digits(own)
    out = [_made(a + "x", own, "x" + b, kind)]  # glued to letters
    if kind == 0:
        local, _, host = own.rpartition("@")
        parts = host.split(".")
        said, number = ". ".join(p.capitalize() for p in parts), f"{len(own)}.{zlib.crc32(own.encode()) % 90 + 10}"
        for address in (f"{local} (at) {said}", f"{local}@{said}", f"{local} @ {number}", f"{local} (at) {number}", f"{local} @{host}"):
            out.append(_made(a, address, b, kind))
        for h in _hosts(host):
            for at, dot in ((" (at) ", "."), ("(at)", "(dot)"), (" [at] ", " [dot] ")):  # ends too early, runs on too far
                *first, last = h.split(".")
                if len(first) > 1:
                    out.append(_made(a, local + at + dot.join(first), dot + last + b, kind))
                out.append(_made(a, local + at + dot.join((*first, last)) + ". Then", b, kind))
    elif kind == 1:
        out.append(_made(a, re.sub(r"[0-9]+", lambda m: str(256 + int(m.group()[-3:]) % 700), own, count=1), b, kind))
    elif kind == 2:
        out.append(_made(a, own[:-1] + str((int(own[-1]) + 1) % 10), b, kind))
        for n in (13, 14, 15, 16):
            wrong = _with_check_digit(("9" + digits)[: n - 1])
            out.append(_made(a, wrong if n < 16 else wrong[:-1] + str((int(wrong[-1]) + 3) % 10), b, kind))
        out.append(_made(a + "key = ", digits, b, kind))
    elif len(digits) >= 10:
        last = digits[-10:]
        groups = "-".join((last[:3], last[3:6], last[6:]))
        out += [_made(a + "x", groups, "x" + b, kind), _made(a + "A-", groups, b, kind), _made(a + "key = ", groups, b, kind), _made(a + "token = ", last, b, kind)]
        out += [_made(a, f"{last[0]}.{(last + '0')[1:]}", b, kind), _made(a, f"{last[:2]}.{last[2:]}", b, kind)]  # a fraction
        if not _PERSON.search(a):
            out += [_made(a, last, b, kind), _made(a, digits, b, kind)]
    return out


# -- boosted trees ----------------------------------------------------------------


@dataclass
class Trees:
    """Boosted trees of equal depth over binned features, and a threshold for each kind."""

    edges: list[np.ndarray]
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # go right when the bin is greater
    leaf: np.ndarray
    bias: float
    thresholds: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.binned_scores(self.bins(x))

    def binned_scores(self, b: np.ndarray, trees: int = ROUNDS) -> np.ndarray:
        """Scores by the first so many trees."""
        total = np.full(len(b), self.bias)
        for f, c, leaf in zip(self.feature[:trees], self.cut[:trees], self.leaf):
            total += leaf[_descend(b, f, c)]
        return 1 / (1 + np.exp(-total))


def _descend(b: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Where each row stands in the level ``depth`` of a tree."""
    node = np.zeros(len(b), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
    return node - (2**depth - 1)


def level_sums(model: Trees, tree: int, depth: int, b: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Gradients and curvatures of the logistic loss (2, nodes, features, bins), in whole multiples of 1 / UNIT."""
    p = model.binned_scores(b, tree)
    g, h = np.rint(UNIT * weight * (p - y)), np.rint(UNIT * weight * np.maximum(p * (1 - p), 1e-6))
    node, width = _descend(b, model.feature[tree], model.cut[tree], depth), 2**depth
    out = np.empty((2, width, b.shape[1], BINS + 1))
    for j in range(b.shape[1]):
        at = node * (BINS + 1) + b[:, j]
        out[0, :, j], out[1, :, j] = (np.bincount(at, v, width * (BINS + 1)).reshape(width, -1) for v in (g, h))
    return out


def grown(edges: list[np.ndarray], rate: float, sums: Callable[[Trees, int, int], np.ndarray]) -> Trees:
    """Trees for the logistic loss; ``sums`` gives the ``level_sums`` of all examples for a level of the tree that grows."""
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    model = Trees(edges, np.zeros((ROUNDS, 2**DEPTH - 1), np.int64), np.full((ROUNDS, 2**DEPTH - 1), BINS), np.zeros((ROUNDS, 2**DEPTH)), float(np.log(rate / (1 - rate))), np.full(len(KINDS), np.inf))
    for t in range(ROUNDS):
        for depth in range(DEPTH):
            gl, hl = sums(model, t, depth).cumsum(axis=3) / UNIT
            gr, hr = gl[..., -1:] - gl, hl[..., -1:] - hl
            gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gl[..., -1:] ** 2 / (hl[..., -1:] + 1)
            first, nodes = 2**depth - 1, np.arange(2**depth)
            best = np.full(len(nodes), 1e-6)
            for j in range(len(edges)):
                top = gain[:, j].argmax(axis=1)
                better = gain[nodes, j, top] > best
                best = np.where(better, gain[nodes, j, top], best)
                model.feature[t, first : first + len(nodes)][better] = j
                model.cut[t, first : first + len(nodes)][better] = top[better]
        # The leaves are the two sides of the last level's splits.
        split = nodes, model.feature[t, first:], model.cut[t, first:]
        g, h = (np.stack([left[split], right[split]], axis=1).ravel() for left, right in ((gl, gr), (hl, hr)))
        model.leaf[t] = -RATE * g / (h + 1)
    return model


#: Which parts of the examples lie below the edges of the bins.
PARTS = np.linspace(0, 1, BINS + 1)[1:-1]


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees from examples in memory, each of weight 1."""
    edges = [np.unique(np.quantile(x[:, j], PARTS, method="lower")) for j in range(x.shape[1])]
    b = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int64)
    return grown(edges, float(y.mean()), lambda model, t, depth: level_sums(model, t, depth, b, y, np.ones(len(y))))


def _threshold(score: np.ndarray, right: np.ndarray, all_: np.ndarray, precision: float, least: float) -> float:
    """The least score over which the candidates are right often enough; ``right`` and ``all_`` are their weights."""
    order = np.argsort(-score, kind="stable")
    score, right, rank = score[order], right[order].cumsum(), all_[order].cumsum()
    last = np.append(score[1:] < score[:-1], True) if len(order) else np.empty(0, bool)  # equal scores stand together
    good = np.flatnonzero(last & (right >= precision * rank) & (right >= least))
    return max(0.5, float(score[good[-1]])) if len(good) else np.inf


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, precision: float = PRECISION, least: int = 20) -> None:
    """For each kind the least threshold over which the held-back candidates are right often enough."""
    p = model.scores(x)
    for k in range(len(KINDS)):
        own = x[:, 0] == k
        model.thresholds[k] = _threshold(p[own], y[own], np.ones(int(own.sum())), precision, least)


# -- the operator -----------------------------------------------------------------


class Taken:
    """The characters of a text that spans cover."""

    def __init__(self, text: str, spans: list[tuple] = ()):
        self.marks = bytearray(len(text))
        for _, start, end in spans:
            self.add(start, end)

    def add(self, start: int, end: int) -> None:
        self.marks[start:end] = b"\x01" * (end - start)

    def meets(self, start: int, end: int) -> bool:
        return self.marks.find(1, start, end) >= 0


def fit(docs: DataFrame, text_col: str = "text", sort_weight: int = SORT_WEIGHT, in_memory: int = IN_MEMORY) -> Trees | None:
    """Trees from all the corpus's candidates; None without right and wrong ones."""

    def label(batches):
        for b in batches:
            out = []
            for text in b.column(0).to_pylist():
                if not text:
                    continue
                base = base_spans(text)
                known, taken = set(base), Taken(text, base)
                for c in candidates(text):
                    if c in known:
                        out += [(c, text[c[1] : c[2]], (text, *c), True), (c, text[c[1] : c[2]], crowded(text, *c), True)]
                    elif not taken.meets(*c[1:]) and fails(text, *c):
                        out.append((c, text[c[1] : c[2]], (text, *c), False))
                for c in base:
                    own = text[c[1] : c[2]]
                    if len(own) <= LONGEST:
                        out += [(c, own, m, True) for m in varied(text, *c) if m[1:] in candidates(m[0])]
                        out += [(c, own, m, False) for m in damaged(text, *c)]
            rows = [np.array(features(*m), np.float32).tobytes() for _, _, m, _ in out]
            place = [zlib.crc32(m[0][m[2] : m[3]].encode(), zlib.crc32(row)) for (_, _, m, _), row in zip(out, rows)]
            columns = [pa.array([c[0] for c, *_ in out], pa.int32()), pa.array([good for *_, good in out], pa.bool_()), pa.array([zlib.crc32(own.encode()) % 3 == 0 for _, own, *_ in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(place, pa.int64()), pa.array(rows, pa.binary())], ["kind", "good", "held", "place", "row"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(label, "kind int, good boolean, held boolean, place long, row binary")
    found = tables.written(found.distinct(), "candidates")  # many copies of a document are one example
    counts = {(r["kind"], r["good"], r["held"]): r["count"] for r in found.groupBy("kind", "good", "held").count().collect()}
    if {good for _, good, held in counts if not held} != {False, True}:
        return None
    # What one example weighs, by kind and right or wrong, in multiples of 1 / UNIT.
    weights = np.array([[np.rint(UNIT * min(1.0, sort_weight / max(1, sum(counts.get((k, good, h), 0) for h in (False, True))))) for good in (False, True)] for k in range(len(KINDS))])
    learnt = {good: sum(weights[k, int(g)] * n for (k, g, held), n in counts.items() if g == good and not held) for good in (False, True)}
    edges = _edges(found.where(~F.col("held")), weights, sum(learnt.values()))
    examples = _binned(found, Trees(edges, *[np.empty(0)] * 3, 0.0, np.empty(0)))
    training = examples.where(~F.col("held")).drop("held")
    sums = lambda model, t, depth: _summed(training, model, t, depth, weights)
    if training.count() <= in_memory:
        b, y, weight = _weighted(training.toArrow().combine_chunks().to_batches()[0], weights)
        sums = lambda model, t, depth: level_sums(model, t, depth, b, y, weight)
    model = grown(edges, learnt[True] / sum(learnt.values()), sums)
    _calibrated(examples.where("held"), model, weights)
    return model


def _rows(b: pa.RecordBatch, kind: type) -> np.ndarray:
    """Features or bins of a batch of examples."""
    return np.frombuffer(b"".join(b.column("row").to_pylist()), kind).reshape(b.num_rows, N_FEATURES)


def _weights(b: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    """What one of each example weighs."""
    return weights[b.column("kind").to_numpy(), b.column("good").to_numpy(zero_copy_only=False).astype(np.int64)]


def _weighted(b: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, whether they are right, and weights of a batch of ``_binned``."""
    y = b.column("good").to_numpy(zero_copy_only=False).astype(float)
    return _rows(b, np.uint8).astype(np.int64), y, _weights(b, weights) / UNIT * b.column("n").to_numpy()


def _edges(found: DataFrame, weights: np.ndarray, total: float) -> list[np.ndarray]:
    """Edges of the bins of each feature: the values below which the ``PARTS`` of all examples lie, by weight.

    Features are counts, marks and shares of at most CONTEXT characters, so a feature has
    few different values, at most as many as there are lengths of candidates.
    """

    def count(batches):
        for b in batches:
            x, weight = _rows(b, np.float32), _weights(b, weights)
            for j in range(N_FEATURES):
                value, at = np.unique(x[:, j], return_inverse=True)
                summed = np.bincount(at, weight, len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), j, np.int32)), pa.array(value), pa.array(summed)], ["feature", "value", "weight"])

    values = found.mapInArrow(count, "feature int, value float, weight long").groupBy("feature", "value").agg(F.sum("weight").alias("weight"))
    below = F.sum("weight").over(Window.partitionBy("feature").orderBy("value"))
    places = F.lit([float(p) for p in PARTS * (total - UNIT)])
    edges = values.withColumn("below", below).where(F.exists(places, lambda p: (p < F.col("below")) & (p >= F.col("below") - F.col("weight"))))
    out: list[list[float]] = [[] for _ in range(N_FEATURES)]
    for r in edges.collect():  # at most BINS - 1 a feature
        out[r["feature"]].append(r["value"])
    return [np.array(sorted(e), float) for e in out]


def _binned(found: DataFrame, model: Trees) -> DataFrame:
    """(kind, good, held, row, n): the bins of the examples, a byte a feature, and how many have these."""

    def bin_(batches):
        for b in batches:
            if b.num_rows:
                rows = model.bins(_rows(b, np.float32).astype(float)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("kind", "good", "held")), pa.array([r.tobytes() for r in rows], pa.binary())], ["kind", "good", "held", "row"])

    binned = found.mapInArrow(bin_, "kind int, good boolean, held boolean, row binary")
    return tables.written(binned.groupBy("kind", "good", "held", "row").agg(F.count(F.lit(1)).alias("n")), "examples")


def _summed(examples: DataFrame, model: Trees, tree: int, depth: int, weights: np.ndarray) -> np.ndarray:
    """``level_sums`` over all examples: a task sums its own, Spark sums those of the tasks."""
    shape = 2, 2**depth, N_FEATURES, BINS + 1

    def sums(batches):
        total = np.zeros(shape)
        for b in batches:
            total += level_sums(model, tree, depth, *_weighted(b, weights))
        g, h = total.reshape(2, -1).astype(np.int64)
        cell = np.flatnonzero(h)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(g[cell]), pa.array(h[cell])], ["cell", "g", "h"])

    cells = examples.mapInArrow(sums, "cell int, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, int(np.prod(shape[1:]))))
    at = cells.column("cell").to_numpy()
    out[0, at], out[1, at] = cells.column("g").to_numpy(), cells.column("h").to_numpy()
    return out.reshape(shape)


def _calibrated(held: DataFrame, model: Trees, weights: np.ndarray, least: int = 20) -> None:
    """``calibrate`` over all held-back examples: their weights are summed by kind and step of the score."""

    def score(batches):
        for b in batches:
            rows, y, weight = _weighted(b, weights)
            p, weight = model.binned_scores(rows), (UNIT * weight).astype(np.int64)
            columns = [(p * SCORE_STEPS).astype(np.int32), p, weight * y.astype(np.int64), weight]
            yield pa.RecordBatch.from_arrays([b.column("kind"), *(pa.array(c) for c in columns)], ["kind", "step", "score", "good", "all"])

    scored = held.mapInArrow(score, "kind int, step int, score double, good long, all long").groupBy("kind", "step")
    steps = scored.agg(F.min("score").alias("score"), F.sum("good").alias("good"), F.sum("all").alias("all")).toArrow()
    kind, p, right, all_ = (steps.column(c).to_numpy() for c in ("kind", "score", "good", "all"))
    for k in range(len(KINDS)):
        own = kind == k
        model.thresholds[k] = _threshold(p[own], right[own] / UNIT, all_[own] / UNIT, PRECISION, least)


def added_spans(texts: list[str], base: list[list[tuple]], model: Trees | None) -> list[list[tuple]]:
    """(kind, start, end) of the candidates over their threshold, best first, clear of base spans and each other."""
    more: list[list[tuple]] = [[] for _ in texts]
    if model is None:
        return more
    at, spans, rows, taken = [], [], [], {}
    for i, text in enumerate(texts):
        known = set(base[i])
        found = candidates(text) if text else []
        if found:
            taken[i] = Taken(text, base[i])
        for c in found:
            if c not in known and not taken[i].meets(*c[1:]):
                at.append(i)
                spans.append(c)
                rows.append(features(text, *c))
    if rows:
        scores = model.scores(np.array(rows, float))
        for k in np.argsort(-scores, kind="stable"):
            if scores[k] >= model.thresholds[spans[k][0]] and not taken[at[k]].meets(*spans[k][1:]):
                more[at[k]].append(spans[k])
                taken[at[k]].add(*spans[k][1:])
    return more


def find_pii(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """``docs`` and ``_spans``: kind, start, end, and whether a base rule found it; by kind and start.

    The name gets more underscores where ``docs`` has it already (``tables.fresh``).
    """
    schema = tables.fields(docs, f"`{tables.fresh(docs, '_spans')}` array<struct<kind: string, start: int, end: int, base: boolean>>")
    at, kind = docs.columns.index(text_col), pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def find(batches):
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            base = [base_spans(t) for t in texts]
            spans = []
            for own, more in zip(base, added_spans(texts, base, model)):
                spans.append([{"kind": KINDS[k], "start": s, "end": e, "base": known} for k, s, e, known in sorted([(*x, True) for x in own] + [(*x, False) for x in more])])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, kind)], schema.names)

    return docs.mapInArrow(find, schema)


def _replaced(text: str, spans: list[tuple]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    parts, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def redacted(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets.

    Taking one away can set free a neighbour that a base pattern had run on into, so
    base rules are applied again until they find nothing.
    """
    at, names = docs.columns.index(text_col), docs.columns

    def redact(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            base = [base_spans(t) if t else [] for t in texts]
            out = []
            for text, own, more in zip(texts, base, added_spans([t or "" for t in texts], base, model)):
                spans = own + more
                while spans:
                    text = _replaced(text, spans)
                    spans = base_spans(text)
                out.append(text)
            yield pa.RecordBatch.from_arrays([c if i != at else pa.array(out, pa.string()) for i, c in enumerate(b.columns)], names)

    return docs.mapInArrow(redact, docs.schema)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document. The counts are of the base spans; ``n_added`` counts the others."""
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, fit(docs)).drop("text")
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.filter("_spans", lambda s: s["base"])), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"),
        F.size(F.filter("_spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
