"""Operator 3 against the library reading the same pieces as a unigram model, and round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, frame

from rowsmith.llm import sentencepiece_lattice as sl


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The model file as a unigram model. Placeholder scores of -1e9 become -1e5, below every real
    one: beside them the library's single precision has no digits left for the others."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(sl.vocabulary_path(sl.MODEL), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        p.score = max(p.score, -1e5)
    path = str(tmp_path_factory.mktemp("sp") / "unigram.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    return path, SentencePieceProcessor(model_file=path)


def test_fold_equals_the_library(unigram):
    path, library = unigram
    rng = random.Random(1)
    for _ in range(2000):
        t = "".join(rng.choices(list("aeiou tnrsTHE  .,'-=|é日😀0") + ["the", " of", "ing"], k=rng.randint(1, 25)))
        assert sl.fold_long(sl.SPACE + t.replace(" ", sl.SPACE), sl.pieces(path)) == library.encode(t), t


def test_lattice_equals_the_fold(spark, unigram):
    path, _ = unigram
    rng = random.Random(2)
    units = {"".join(rng.choices(list("aeioutnrsTHE▁▁.,'-=é日😀0\n") + ["the", "ing", "====", "\x00"], k=rng.randint(1, 20))) for _ in range(400)}
    units |= {"a" * 64, "a" * 65, "the" * 200}
    df = spark.createDataFrame([(u,) for u in [*units, "a", "a"]], "unit STRING").repartition(3)
    got = {r["unit"]: r["ids"] for r in sl.best_paths(df, path, 400).collect()}
    assert got == {u: sl.fold_long(u, sl.pieces(path)) for u in units | {"a"}}


@pytest.mark.parametrize("bounds", [{}, {"sample_docs": 10, "dictionary": 5}])
def test_documents(spark, unigram, bounds):
    path, library = unigram
    out = sl.decode(sl.encode(frame(spark).drop("text_crc32"), path, check=True, **bounds), path).collect()
    key = lambda i, t: (i is None, i or 0, t)
    got = sorted(key(r["doc_id"], r["text"]) + (np.frombuffer(r["ids"], "<u4").tolist(),) for r in out)
    text = lambda t: (t or "").replace(sl.SPACE, " ")
    want = sorted(key(i, text(t)) + (library.encode(t or ""),) for i, t, *_ in documents() if "\x00" not in (t or ""))
    assert [g for g in got if "\x00" not in g[2]] == want
    assert all(r["decoded_crc32"] == r["text_crc32"] and r["decoded_bytes"] == len(r["text"].encode()) for r in out)
    assert sorted(g[:3] for g in got) == sorted(key(i, text(t)) for i, t, *_ in documents())
    assert sl.encode(frame(spark, []), path, **bounds).count() == 0


def test_the_shipped_model_round_trips(spark):
    path = sl.vocabulary_path(sl.MODEL)
    out = sl.encode(frame(spark), path, check=True)
    assert out.where("decoded_crc32 != text_crc32").count() == 0 and out.count() == len(documents())


def _moved(plan) -> int:
    """Bytes of rows that the exchanges of an executed plan wrote."""
    kind = plan.nodeName()
    if kind == "AdaptiveSparkPlan":
        return _moved(plan.executedPlan())
    if kind.endswith("QueryStage"):
        return _moved(plan.plan())
    own = plan.metrics().apply("dataSize").value() if kind == "Exchange" else 0
    children = plan.children()
    return own + sum(_moved(children.apply(i)) for i in range(children.size()))


def test_a_block_asks_for_a_unit_once(spark):
    """Documents that share their unseen units: paths come back by block, not by document."""
    rng = random.Random(3)
    own = ["".join(rng.choices("aeioutnrs", k=12)) for _ in range(60)]
    rows = [(i, " ".join(rng.sample(own, 60))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = sl.encode(df, sl.vocabulary_path(sl.MODEL), sample_docs=1, dictionary=1, check=True)
    got = out.collect()
    assert len(got) == 3000 and all(r["decoded_crc32"] == r["text_crc32"] for r in got)
    assert _moved(out._jdf.queryExecution().executedPlan()) < 2 * sum(len(t) for _, t in rows)


def test_repeated_rows_and_keys(spark, unigram):
    """Equal blocks share a number; one key has many texts; null keys and texts stay."""
    path, library = unigram
    rows = [(None, "no key"), (None, None), (7, "one text"), (7, "another text"), (7, "one text"), (8, ""), (9, "x" * 200), (9, "the" * 40 + "日本語" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = sl.decode(sl.encode(df.union(df), path, check=True, sample_docs=1, dictionary=1), path).collect()
    key = lambda i, t: (i is None, i or 0, t or "")
    got = sorted(key(r["doc_id"], r["text"]) + (np.frombuffer(r["ids"], "<u4").tolist(),) for r in out)
    assert got == sorted(key(i, t) + (library.encode(t or ""),) for i, t in rows * 2)


def test_blocks_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(sl, "BLOCK_BYTES", 5000)
    texts = ["a" * 4000, "b" * 20_000, None, "c", "d" * 3000] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    blocks = list(sl._packed(iter([batch])))
    back = [sl._unpacked(pa.Table.from_batches([b])) for b in blocks]
    parts = [p for x in back for p in x]
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts and [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or p.nbytes <= 5100 for p in parts) and len({b.column(0)[0].as_py() for b in blocks}) == len(blocks)


def test_pieces_left_out_are_on_no_best_path(unigram):
    path, library = unigram
    model, kept = sl.pieces(path), {i for _, i, _ in sl._needed(path)}
    dropped = [(p, i) for p, (i, _) in model.table.items() if i not in kept]
    assert dropped and all(i not in sl.fold_long(p, model) for p, i in dropped)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices([p for p, _ in dropped], k=4)).replace(sl.SPACE, " ")
        assert set(library.encode(text)) <= kept | set(model.bytes)
