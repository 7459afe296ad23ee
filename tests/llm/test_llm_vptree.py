"""Operator 4 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import vptree as vp


def brute(rows, k):
    """Per query (id divisible by 3): (rank, id, score), rows as (id, vector) that take part."""
    out = []
    for q, x in rows:
        if q % 3 == 0:
            best = sorted((-float((np.array(x) * np.array(y)).sum()), i) for i, y in rows if i != q and len(x) == len(y))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 1024), (70, 20)])
def test_exact_search(spark, shard_rows, block_rows):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    good += [(400 + i, [0.5] * 8) for i in range(90)]  # ties
    good += [(600 + i, rng.normal(size=3).tolist()) for i in range(4)]  # another length
    bad = [(700, None), (701, [0.0] * 8), (702, [1.0, None] + [1.0] * 6), (703, [float("nan")] * 8), (704, [float("inf")] * 8), (705, []), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in [*good, *bad, good[5]]], "vec_id LONG, embedding ARRAY<DOUBLE>, rank INT, ids STRING").repartition(3)
    out = vp.nearest(df, F.col("vec_id") % 3 == 0, k=10, shard_rows=shard_rows, block_rows=block_rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())
    want = brute(good, 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)
    assert vp.nearest(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0


def test_of_one_id_the_least_vector_counts(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [1.0, 5.0])], "vec_id LONG, embedding ARRAY<DOUBLE>")
    out = vp.nearest(df, F.col("vec_id") == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in out] == [(1, 1.0)]


def test_the_factor_prunes_and_one_is_exact():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 4)) * 5
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 4)) * 0.1
    shard, q = vp.Shard(np.arange(3000), x), x[:200]
    kth = -np.sort(-np.where(np.arange(200)[:, None] == np.arange(3000), -np.inf, q @ x.T), axis=1)[:, 19]
    seen = {}
    plain = vp._Search.offer
    for factor in (1.0, 0.8):
        count = [0]

        def offer(self, rows, lo, hi):
            count[0] += len(rows) * (hi - lo)
            return plain(self, rows, lo, hi)

        vp._Search.offer = offer
        try:
            _, score = shard.search(np.arange(200), q, 20, factor)
        finally:
            vp._Search.offer = plain
        seen[factor] = count[0]
        recall = (score >= kth[:, None] - 1e-9).mean()
        assert recall == 1 if factor == 1 else recall > 0.5
    assert seen[0.8] < seen[1.0] < 200 * 3000
