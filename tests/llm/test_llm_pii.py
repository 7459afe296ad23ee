"""Operator 5: base rules against plain patterns, added spans, redaction."""

import random
import re
import time

import numpy as np
from llm_cases import documents, frame

from rowsmith.llm import pii

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    good = (
        lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")), lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s)), lambda s: 8 <= len(digits(s)) <= 15,
    )
    return [(k, *m.span()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text) if good[k](m[0])]


def test_base_rules_equal_the_patterns():
    rng = random.Random(2)
    parts = ["1", "2", "55", "255", "256", "4111111111111111", ".", " ", "-", "+", "(", ")", "@", "a", "b.c", "%", "\n", "é", "1.2.3.4", "x@y.z", "+1 (784) 555-8120", "0001"]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert pii.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("a" * 10**6, "1" * 10**6, "+" * 10**6, "1." * 300_000, "+1 " * 200_000, "a@" * 100_000):
        start = time.process_time()
        pii.base_spans(t)
        pii.candidates(t)
        assert time.process_time() - start < 10


def test_a_long_run_of_zeros_is_an_ip_part():
    t = "0" * 5000 + ".1.2.3"
    assert pii.base_spans(t) == [(1, 0, len(t))] and pii.candidates(t) is not None


def people(n=400):
    """Texts with personal data, often side by side, and the true pieces of each."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        card = str(rng.randrange(4 * 10**14, 5 * 10**14))
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        found = [f"u{i}.x@mail{i % 7}.example.com", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{i % 256}.7", card, f"+1 ({rng.randint(200, 999)}) 555-{i:04d}"]
        rng.shuffle(found)
        found = found[: 1 + i % 4]
        rows.append((i, "some words " + (" " if i % 3 else " then others ").join(found) + " and the end", found))
    return rows


def test_spans_lost_to_a_neighbour_are_added(spark):
    rows = people()
    plain = "plain words, 12 of them, in 2024"
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1001, plain)], "doc_id LONG, text STRING").repartition(3)
    model = pii.fit(df)
    assert np.isfinite(model.thresholds[1:]).all()
    out = {r["doc_id"]: r["_spans"] for r in pii.find_pii(df, model).collect()}
    added = 0
    for i, text, found in rows:
        assert [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in out[i] if s["base"]] == brute(text)
        for s in out[i]:
            if not s["base"]:  # a base rule ran across two neighbours and dropped them
                added += 1
                assert text[s["start"] : s["end"]] in found
    assert added > 0 and out[1001] == []
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(df, model).collect()}
    assert clean[1001] == plain and all(not brute(t) for t in clean.values())
    for i, text, _ in rows:
        assert all(text[s["start"] : s["end"]] not in clean[i] for s in out[i])


def test_awkward_documents(spark):
    model = pii.fit(frame(spark))
    out = pii.find_pii(frame(spark), model)
    assert out.columns[:-1] == frame(spark).columns and out.columns[-1] == "__spans"
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["__spans"] if s["base"]]) for r in out.collect())
    assert got == sorted((i is None, i or 0, brute(t or "")) for i, t, *_ in documents())
    clean = pii.redacted(frame(spark), model)
    assert clean.schema == frame(spark).schema and clean.where("text is null").count() == 1
    empty = frame(spark, [])
    assert pii.fit(empty) is None and pii.find_pii(empty, None).count() == 0


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, pii.N_FEATURES))
    x[:, 0] = rng.integers(0, 4, 3000)
    y = ((x[:, 1] > 0) & (x[:, 2] < 1)).astype(float)
    model = pii.boost(x[:2000], y[:2000])
    pii.calibrate(model, x[2000:], y[2000:], precision=0.98)
    p = model.scores(x[2000:])
    assert ((p > 0.5) == (y[2000:] > 0)).mean() > 0.97
    taken = p >= model.thresholds[x[2000:, 0].astype(int)]
    assert taken.sum() > 200 and y[2000:][taken].mean() >= 0.98


#: Personal data that no base rule matches, and what looks like it; the corpus has right ones in base forms only.
WRITTEN = ("212-555-0199", "1 415 555 0132", "415.555.0177", "44 (207) 946-0958", "jane (at) mail.example", "jane.doe[at]mail.example.com", "jo (at) uni (dot) example", "a.b@mail[dot]example", "371449635398431")
LOOK_ALIKE = ("4111111111111112", "300.1.2.3", "3.1415926535", "1700000000123", "1700000000", "x212-555-0199x", "met (at) noon. Then", "3 @ 2.50", "9011449635398434")


def test_forms_of_no_base_rule_are_added(spark):
    rows = [(i, t) for i, t, _ in people()]
    words = ("and some words ", "reach them under ", "it was ")
    rows += [(2000 + 10 * i + k, f"{w}{t}, they wrote") for i, t in enumerate(WRITTEN) for k, w in enumerate(words)]
    rows += [(3000 + 10 * i + k, f"{w}{t} they wrote") for i, t in enumerate(LOOK_ALIKE) for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    model = pii.fit(df)
    assert np.isfinite(model.thresholds).all()
    text = dict(rows)
    out = {r["doc_id"]: [(s["base"], text[r["doc_id"]][s["start"] : s["end"]]) for s in r["_spans"]] for r in pii.find_pii(df, model).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(df, model).collect()}
    for i, t in enumerate(WRITTEN):
        for k in range(len(words)):
            assert out[2000 + 10 * i + k] == [(False, t)] and t not in clean[2000 + 10 * i + k], (t, out[2000 + 10 * i + k])
    for i, t in enumerate(LOOK_ALIKE):
        for k in range(len(words)):
            assert out[3000 + 10 * i + k] == [] and clean[3000 + 10 * i + k] == text[3000 + 10 * i + k], (t, out[3000 + 10 * i + k])


def test_untouched_candidates_are_no_wrong_examples():
    for t in WRITTEN:
        found = [c for c in pii.candidates(t) if t[c[1] : c[2]] == t]
        assert found and not any(pii.fails(t, *c) for c in found), t
    assert pii.varied("at +12125550199 now", 3, 3, 15) and pii.varied("u@mail.example", 0, 0, 14)
    assert all(pii.candidates(t) for t in LOOK_ALIKE)


def test_two_megabytes_of_contacts_take_linear_time(spark):
    import time

    df = spark.createDataFrame([(i, t) for i, t, _ in people()], "doc_id LONG, text STRING").repartition(3)
    model = pii.fit(df)
    line = "Jo Doe: jo.doe{}@mail.example.com, tel 212-555-0{:03d}, jo (at) uni (dot) example, 10.0.{}.7, 4111 1111 1111 1111\n"

    def seconds(n):
        text = "".join(line.format(i, i % 1000, i % 256) for i in range(n))
        started = time.process_time()
        more = pii.added_spans([text], [pii.base_spans(text)], model)[0]
        assert len(more) >= n
        return time.process_time() - started, len(text)

    small, _ = seconds(1500)
    large, size = seconds(18_000)
    assert size > 2_000_000 and large < 12 * small * 2.5


def test_long_addresses_are_proposed_whole():
    host = ".".join(f"part{i}" for i in range(30)) + "." + "x" * 500
    own = "a" * 300 + " (at) " + host
    text = f"write to {own}, soon"
    assert (0, 9, 9 + len(own)) in pii.candidates(text)
    assert len(pii.candidates(text)) == pii.ENDS + 1
    for t in ("@" * 50_000, "a@" * 50_000, "a@b." * 50_000, "a (at) b" + " (dot) c" * 50_000):
        assert len(pii.candidates(t)) <= len(t)


def test_trees_learn_from_all_candidates(spark, monkeypatch):
    """However many there are of a sort: none is left out, and all of them together weigh no more than a sort may."""
    df = spark.createDataFrame([(i, t) for i, t, _ in people()], "doc_id LONG, text STRING").repartition(3)
    seen = []
    sums = pii.level_sums
    monkeypatch.setattr(pii, "level_sums", lambda m, t, d, b, y, w: seen.append((b, w)) or sums(m, t, d, b, y, w))
    pii.fit(df, sort_weight=10**6)
    whole, n = seen[0][0], seen[0][1].sum()  # weight 1 each
    seen.clear()
    model = pii.fit(df, sort_weight=25)
    assert len(seen[0][0]) > 8 * 25 and seen[0][1].sum() <= 8 * 25 < n
    assert len(whole) <= n and model is not None


def test_sums_by_spark_are_those_in_memory(spark):
    df = spark.createDataFrame([(i, t) for i, t, _ in people(100)], "doc_id LONG, text STRING").repartition(3)
    one, other = pii.fit(df, sort_weight=200), pii.fit(df.repartition(5), sort_weight=200, in_memory=0)
    assert all((getattr(one, a) == getattr(other, a)).all() for a in ("feature", "cut", "leaf", "thresholds"))


def test_weights_stand_for_repeated_examples():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, size=(300, pii.N_FEATURES)).astype(float)
    y = (x[:, 1] > 2).astype(float)
    n = rng.integers(1, 5, 300)
    many = pii.boost(np.repeat(x, n, axis=0), np.repeat(y, n))
    one = pii.grown(many.edges, float((y * n).sum() / n.sum()), lambda m, t, d: pii.level_sums(m, t, d, m.bins(x), y, n))
    assert (one.feature == many.feature).all() and (one.cut == many.cut).all() and np.allclose(one.leaf, many.leaf)
