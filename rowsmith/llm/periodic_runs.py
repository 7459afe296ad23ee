"""Operator 11: periodic runs of words by grammar compression.

The words of a text become ids, and Re-Pair compresses the ids: in rounds, every pair of
neighbours that occurs twice or more in its text and has a higher priority (frequency in
that round, ties by a hash of the pair) than the pairs it overlaps becomes a nonterminal,
the same pair always the same one. All texts of a slice are compressed together; ids are
of one text each, so no pair spans two texts. What no pair shortens any more is the start
rule; it is read as a balanced binary tree, whose inner nodes are nonterminals used once.

A run lies across the border of exactly one lowest node. So for every nonterminal, once,
the runs across its border inside its expansion are computed: a run of at least
``MIN_LENGTH`` words and twice its period has six words in a row around the border that
occur again one period off, which gives the candidate periods, and common extensions to
both sides (prefix fingerprints and binary search) give the interval. Intervals are
translated to all derivation positions of their nonterminal, intervals of one period that
overlap by a period are merged, and what remains is maximal. Every run reported is then
compared word by word; a fingerprint that lied means another base and a new pass.

A run is ``start, length, period`` in words from 0; a word is dropped if a run contains
it after that run's first ``period`` words.

Defined results: a null text counts as empty, has no runs and collapses to an empty text;
rows are independent, so repeated rows repeat and null keys stay; a very long text is
handled whole, alone in its slice; an empty table gives an empty result. Columns of the
input that bear a name of the operator's own columns are left out, others are carried.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .tokens import text_bytes
from .wordtable import slices

#: Least words of a run; a run also has at least two periods.
MIN_LENGTH = 12
#: So many words in a row match one period off in the shortest run, half of it.
GRAM = MIN_LENGTH // 2
# Two primes under 2^32: products of residues fit 64 bits.
_PRIMES = (4294967291, 4294967279)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """Re-Pair of a sequence of symbols whose texts do not share symbols.

    ``sym``, ``pos``: what is left, and the first word of each symbol. ``left``, ``right``,
    ``size``, ``at``: parts of the nonterminals (numbered from ``base``), words in their
    expansion, and the first word of one occurrence.
    """

    def __init__(self, ids: np.ndarray, text: np.ndarray, base: int):
        self.base = base
        self.sym, self.pos = ids.astype(np.int64), np.arange(len(ids), dtype=np.int64)
        self.text = text
        self.left, self.right, self.at = [], [], []
        self.twice = np.zeros(len(ids), bool)  # whether the pair at a word occurs again in its text
        self._compress()
        self.left, self.right, self.at = (np.array(x, np.int64) for x in (self.left, self.right, self.at))
        size = np.ones(base + len(self.left), np.int64)
        for r in range(len(self.left)):
            size[base + r] = size[self.left[r]] + size[self.right[r]]
        self.size = size

    def _compress(self) -> None:
        rules: dict[int, int] = {}
        width = self.base + len(self.sym) + 1
        live = self.text[1:] == self.text[:-1]
        first = True
        while live.any():
            at = np.flatnonzero(live)
            keys = self.sym[at] * width + self.sym[at + 1]
            different, which, found = np.unique(keys, return_inverse=True, return_counts=True)
            mixed = (different.astype(np.uint64) * _MIX) >> np.uint64(7)
            rank = np.empty(len(different), np.int64)
            rank[np.lexsort((different, mixed, found))] = np.arange(1, len(different) + 1)
            rank[found < 2] = 0
            priority = np.zeros(len(self.sym) + 1, np.int64)  # of the pair at 1..; a zero at both ends
            priority[at + 1] = rank[which]
            if first:
                self.twice[at] = found[which] > 1
                first = False
            mid = priority[1:-1]
            best = (mid > 0) & (mid >= priority[:-2]) & (mid >= np.append(priority[2:], 0)[: len(mid)])
            chosen = np.flatnonzero(best)
            if not len(chosen):
                break
            # Equal neighbours are one pair overlapping itself: every other one is taken.
            head = np.append(True, np.diff(chosen) > 1)
            begin = chosen[np.maximum.accumulate(np.where(head, np.arange(len(chosen)), 0))]
            chosen = chosen[(chosen - begin) % 2 == 0]
            pairs, use = np.unique(self.sym[chosen] * width + self.sym[chosen + 1], return_inverse=True)
            names = np.empty(len(pairs), np.int64)
            places = np.empty(len(pairs), np.int64)
            places[use[::-1]] = self.pos[chosen[::-1]]
            for k, pair in enumerate(pairs.tolist()):
                name = rules.get(pair)
                if name is None:
                    name = rules[pair] = self.base + len(self.left)
                    self.left.append(pair // width)
                    self.right.append(pair % width)
                    self.at.append(int(places[k]))
                names[k] = name
            changed = np.zeros(len(self.sym), bool)
            changed[chosen] = True
            self.sym[chosen] = names[use]
            stay = np.ones(len(self.sym), bool)
            stay[chosen + 1] = False
            # A pair lives on if it occurs again, or if one of its sides is new.
            alive = np.zeros(len(self.sym), bool)
            alive[:-1] = mid > 0
            self.sym, self.pos, self.text, changed, alive = (x[stay] for x in (self.sym, self.pos, self.text, changed, alive))
            live = (alive[:-1] | changed[:-1] | changed[1:]) & (self.text[1:] == self.text[:-1])

    def nodes(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word, border, end of the expansion, and the nonterminal (-1: of the start rule) of every node.

        ``ends``: the end of each text.
        """
        low, high = self.at, self.at + self.size[self.base :]
        border = low + self.size[self.left] if len(low) else low
        inner = np.flatnonzero(self.text[1:] == self.text[:-1]) + 1
        first = np.searchsorted(self.text, self.text, side="left")
        last = np.searchsorted(self.text, self.text, side="right")
        local = inner - first[inner]
        reach = local & -local
        until = inner + reach
        stop = np.append(self.pos, 0)[np.minimum(until, len(self.pos))]
        high2 = np.where(until < last[inner], stop, ends[self.text[inner]])
        return (
            np.concatenate([low, self.pos[inner - reach]]), np.concatenate([border, self.pos[inner]]), np.concatenate([high, high2]),
            np.concatenate([np.arange(len(low)), np.full(len(inner), -1)]),
        )

    def derived(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every derivation position of the nonterminals marked in ``wanted``: nonterminal, first word."""
        bears = np.append(np.zeros(self.base, bool), wanted)
        for r, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist()), self.base):
            if bears[a] or bears[b]:
                bears[r] = True
        own = np.append(np.zeros(self.base, bool), wanted)
        sym, pos, out = self.sym[bears[self.sym]], self.pos[bears[self.sym]], []
        while len(sym):
            out.append((sym[own[sym]] - self.base, pos[own[sym]]))
            rule = sym[sym >= self.base] - self.base
            pos = pos[sym >= self.base]
            sym = np.concatenate([self.left[rule], self.right[rule]])
            pos = np.concatenate([pos, pos + self.size[self.left[rule]]])
            sym, pos = sym[bears[sym]], pos[bears[sym]]
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))


class Extensions:
    """Common extensions of two places of a sequence, by fingerprints of its prefixes."""

    def __init__(self, ids: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.sums, self.powers = [], []
        for p in _PRIMES:
            prime, powers = np.uint64(p), np.ones(1, np.uint64)
            step = np.uint64(rng.integers(1 << 20, p - 1))
            while len(powers) < len(ids) + 1:
                powers = np.concatenate([powers, powers * step % prime])
                step = step * step % prime
            powers = powers[: len(ids) + 1]
            values = (ids.astype(np.uint64) + np.uint64(1)) * powers[:-1] % prime
            self.sums.append(np.append(np.uint64(0), np.cumsum(values)))
            self.powers.append(powers)

    def _same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` symbols from ``i`` equal those from ``j`` (``i < j``)."""
        same = np.ones(len(i), bool)
        for p, sums, powers in zip(_PRIMES, self.sums, self.powers):
            prime = np.uint64(p)
            same &= (sums[i + n] - sums[i]) % prime * powers[j - i] % prime == (sums[j + n] - sums[j]) % prime
        return same

    def longest(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How far places ``i < j`` agree onwards (themselves included), or backwards (themselves not), ``most`` at most."""
        got = np.zeros(len(i), np.int64)
        if not len(i):
            return got
        step = 1 << int(most.max()).bit_length()
        while step := step >> 1:
            at = np.flatnonzero(got + step <= most)
            d = got[at] + step if back else -got[at]
            fits = self._same(i[at] - d, j[at] - d, np.full(len(at), step))
            got[at[fits]] += step
        return got


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of the given sizes: the item of each element, and the element's number in its item."""
    item = np.repeat(np.arange(len(sizes)), sizes)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _candidates(ids: np.ndarray, twice: np.ndarray, low: np.ndarray, border: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and periods: ``GRAM`` words in a row that hold the word after the border occur again so far off in the node."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(ids) < 2 * GRAM:
        return none
    pairs = np.concatenate([[0], np.cumsum(twice)])
    at = np.flatnonzero(pairs[GRAM - 1 : len(ids)] - pairs[: len(ids) - GRAM + 1] == GRAM - 1)
    with np.errstate(over="ignore"):
        mark = np.zeros(len(at), np.uint64)
        for k in range(GRAM):
            mark = (mark ^ ids[at + k].astype(np.uint64)) * _MIX
            mark ^= mark >> np.uint64(31)
    # Equal marks that are not equal words only cost a look: extensions decide.
    _, gram, found = np.unique(mark, return_inverse=True, return_counts=True)
    again = found[gram] > 1
    at, gram = at[again], gram[again]
    of_word = np.full(len(ids) + GRAM, -1)
    of_word[at] = gram
    key = np.sort(gram * (len(ids) + 1) + at)
    places = key % (len(ids) + 1)
    nodes, periods = [], []
    big = np.flatnonzero(high - low >= MIN_LENGTH)
    for shift in range(GRAM):
        i = border[big] - shift
        ok = (i >= low[big]) & (i + GRAM <= high[big])
        node, i = big[ok], i[ok]
        ok = of_word[i] >= 0
        node, i = node[ok], i[ok]
        g = of_word[i] * (len(ids) + 1)
        a = np.searchsorted(key, g + low[node])
        b = np.searchsorted(key, g + high[node] - GRAM, side="right")
        item, nth = _spread(b - a)
        period = np.abs(places[a[item] + nth] - i[item])
        ok = (period > 0) & (2 * period <= (high - low)[node[item]])
        nodes.append(node[item][ok])
        periods.append(period[ok])
    both = np.unique(np.concatenate(nodes) * (len(ids) + 1) + np.concatenate(periods))
    return both // (len(ids) + 1), both % (len(ids) + 1)


def _crossing(ext: Extensions, low, border, high, node, period) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node, start, end, smallest period of the repetitions that lie across the border of their node."""
    out = []
    for i in (border[node], border[node] - period):
        ok = np.flatnonzero((i >= low[node]) & (i + period < high[node]))
        n, i, q = node[ok], i[ok], period[ok]
        start = i - ext.longest(i, i + q, i - low[n], back=True)
        end = i + q + ext.longest(i, i + q, high[n] - i - q, back=False)
        ok = (end - start >= np.maximum(MIN_LENGTH, 2 * q)) & (start < border[n]) & (end > border[n])
        out.append((n[ok], start[ok], end[ok], q[ok]))
    n, start, end, q = (np.concatenate(x) for x in zip(*out))
    # A multiple of the smallest period spans the same words.
    order = np.lexsort((q, end, start, n))
    n, start, end, q = (x[order] for x in (n, start, end, q))
    first = np.append(True, (np.diff(n) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0))[: len(n)]
    return n[first], start[first], end[first], q[first]


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that overlap by that period, as one."""
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    far = int(end.max()) + 1
    group = np.cumsum(np.append(0, np.diff(period) != 0))
    reach = np.maximum.accumulate(group * far + end) - group * far
    new = np.ones(len(start), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] + period[1:] > reach[:-1])
    head = np.flatnonzero(new)
    return start[head], np.maximum.reduceat(end, head), period[head]


def word_runs(ids: np.ndarray, text: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, in order of start and period.

    ``ids`` under ``base``, those of different texts different; ``text`` (ascending) of each
    word; ``ends`` of each text.
    """
    none = (np.empty(0, np.int64),) * 3
    if len(ids) < MIN_LENGTH:
        return none
    grammar = Grammar(ids, text, base)
    low, border, high, rule = grammar.nodes(ends)
    node, period = _candidates(ids, grammar.twice, low, border, high)
    if not len(node):
        return none
    for seed in count(1):
        n, start, end, q = _crossing(Extensions(ids, seed), low, border, high, node, period)
        if not len(n):
            return none
        # Found once for each nonterminal; now wherever that is derived.
        nonterminal = rule[n]
        own = nonterminal >= 0
        by_rule = np.argsort(nonterminal[own], kind="stable")
        r, s, e, p = (x[own][by_rule] for x in (nonterminal, start, end, q))
        s, e = s - grammar.at[r], e - grammar.at[r]
        wanted = np.zeros(len(grammar.left), bool)
        wanted[r] = True
        used, at = grammar.derived(wanted)
        a, b = np.searchsorted(r, used), np.searchsorted(r, used, side="right")
        item, nth = _spread(b - a)
        run, at = a[item] + nth, at[item]
        start, end, q = _merged(np.append(start[~own], at + s[run]), np.append(end[~own], at + e[run]), np.append(q[~own], p[run]))
        if all((ids[a : b - c] == ids[a + c : b]).all() for a, b, c in zip(start.tolist(), end.tolist(), q.tolist())):
            break
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def runs_of(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of some texts as ``word_runs`` gives them over the words of all, the text of each run, and where texts start."""
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, int(starts[-1]))
    text = np.repeat(np.arange(len(words)), sizes)
    different, ids = np.unique(text * (len(numbers) + 1) + ids, return_inverse=True)
    start, end, period = word_runs(ids, text, starts[1:], len(different))
    return start, end, period, text[start], starts


OWN = ("runs", "collapsed")


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its texts, with ``runs`` (``start, length, period`` by start, then period) and ``collapsed``, the kept words."""
    carried = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {*OWN, text_col.lower()}]
    schema = tables.fields(docs.select(*carried), "runs array<struct<start:long,length:long,period:long>>, collapsed string")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            for i, j in slices(text_bytes(b.column(0))[1]):
                s = b.slice(i, j - i)
                data, offsets = text_bytes(s.column(0))
                data = data.tobytes()
                words = [data[a:z].split() for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                start, end, period, text, begin = runs_of(words)
                gone = np.zeros(begin[-1] + 1, np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, end, -1)
                kept = np.cumsum(gone) == 0
                for t in np.unique(text).tolist():
                    words[t] = [w for w, k in zip(words[t], kept[begin[t] : begin[t + 1]].tolist()) if k]
                flat = pa.StructArray.from_arrays([pa.array(x) for x in (start - begin[text], end - start, period)], fields=list(kind.value_type))
                cuts = np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(cuts), flat)
                collapsed = pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*s.columns[1:], runs.cast(kind), collapsed], names=schema.names)

    return docs.select(F.col(f"`{text_col}`"), *carried).mapInArrow(run, schema)


def with_repeats(key: Column, text: Column) -> Column:
    """The texts of the query: one in ten, by the CRC-32 of its key, repeats a stretch of its words to its end."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), made).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.l").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.l") / -F.col("top.p")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
