"""Operator 13 against a plain version, and its way back."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, frame

from rowsmith.llm import fill_in_middle as fim
from rowsmith.llm.tokens import text_bytes


def plain_version(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in fim.MARKERS) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def awkward(n=3000):
    rng = random.Random(3)
    parts = ["\n", "\n\n", "<P>", "<", "<P", "P>", ">", "<S", "S>", "é", "日本", "😀", "word ", "\r\n", "\x00", " ", "a\nb\n"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(n)] + ["", None, "\n", "<M>", "x" * 3000]


@pytest.mark.parametrize("block", [5, 1 << 22])
@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (100, 100)])
def test_texts_and_way_back(monkeypatch, block, rate, spm):
    monkeypatch.setattr(fim, "BLOCK", block)
    texts = awkward(300 if block == 5 else 3000)
    wanted = [plain_version(k, t, 7, rate, spm) for k, t in enumerate(texts)]
    digests = [hashlib.sha256(f"7:{k}".encode()).hexdigest() for k in range(len(texts))]
    draws = np.array([[int(h[8 * k : 8 * k + 8], 16) for k in range(4)] for h in digests])
    data, offsets = text_bytes(pa.array(texts))
    cuts = fim.Cuts(data, offsets, draws, rate, spm)
    out, starts = fim.transformed(data, cuts)
    got = [out[a:b].tobytes().decode() for a, b in zip(starts, starts[1:])]
    assert got == [w[4] for w in wanted]
    assert cuts.units.tolist() == [w[0] for w in wanted]
    again, back = fim.restored(out, starts, cuts.form)
    assert again.tobytes() == data.tobytes() and (back == offsets).all()


def test_output_without_its_markers_is_an_error():
    data, offsets = text_bytes(pa.array(["<P>a<S>b"]))
    with pytest.raises(ValueError):
        fim.restored(data, offsets, np.array([fim.PSM]))


def test_frame_with_clashing_names(spark):
    rows = documents()
    made = fim.fill_in_middle(frame(spark, rows).withColumnRenamed("host", "form"))
    assert made.columns.count("form") == 1 and made.columns.count("n") == 1 and "lang" in made.columns
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in fim.texts_again(made).collect()]
    wanted = [(r[0], *plain_version(r[0], r[1]), r[1] or "") for r in rows]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    empty = fim.texts_again(fim.fill_in_middle(frame(spark, rows).limit(0)))
    assert empty.count() == 0
