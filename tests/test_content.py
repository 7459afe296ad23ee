"""Main content by text and link density."""

import random
import time

from pyspark.sql import functions as F

from rowsmith.functions import content as C


def _texts(spark, pages, **kw):
    df = spark.createDataFrame(list(enumerate(pages)), "i INT, h STRING")
    return [r.t for r in df.select("i", C.content_text("h", **kw).alias("t")).orderBy("i").collect()]


LONG = "This is a sentence of the text that people came to read, and there is more. "
NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">A link to page {i}</a></li>' for i in range(8)) + "</ul></nav>"


def test_the_best_run_is_kept(spark):
    page = f"<html><head><title>T</title></head><body>{NAV}<div class='ad'>Buy now</div><div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}&amp; <a href='x'>one link</a></p></div><footer>(c) us <a href='/'>home page of this site</a></footer>"
    nested = f"<article><p>{LONG}</p><article><p>Comment. {LONG}</p></article><p>After. {LONG}</p></article>{NAV}"
    bare = "<p>Hi</p><p>there</p>"
    got = _texts(spark, [page, nested, bare, "", None, "plain " * 20, "<script>x</script><!-- c -->"])
    s = LONG.strip()
    # The heading costs more than it brings; the short paragraph stands between longer ones.
    assert got[0] == f"{s} Short. {s} & one link"
    assert got[1] == f"{s} Comment. {s} After. {s}"
    assert got[2] == "Hi there" and got[3] == "" and got[4] is None and got[5] == ("plain " * 20).strip() and got[6] == ""
    assert _texts(spark, [nested], max_chars=10) == [LONG[:10]]


def test_best_run_equals_all_runs(spark):
    rng = random.Random(2)
    lists = [[rng.randint(-5, 5) for _ in range(rng.randint(0, 25))] for _ in range(300)] + [[0, 0], [-1], [5], [0, 3, 0, -3, 3]]
    df = spark.createDataFrame([(i, [("t", s) for s in x]) for i, x in enumerate(lists)], "i INT, b ARRAY<STRUCT<text: STRING, score: INT>>")
    got = {r.i: (r.r["first"], r.r["n"]) for r in df.select("i", C.best_run(F.col("b")).alias("r")).collect()}
    for i, x in enumerate(lists):
        runs = [(-sum(x[a:b]), b, b - a) for a in range(len(x)) for b in range(a + 1, len(x) + 1)]
        best = min(runs, default=(0, 0, 0))
        assert got[i] == ((best[1] - best[2], best[2]) if best[0] < 0 else (0, 0)), x


def test_linear_in_the_page(spark):
    def seconds(n):
        page = f"<p>{LONG}</p>" * n + "<p>" + "x" * n + "<a" * n
        started = time.perf_counter()
        assert len(_texts(spark, [page], max_chars=None)[0]) > 70 * n
        return time.perf_counter() - started

    seconds(2000)
    small, large = seconds(2000), seconds(32_000)
    assert large < 16 * max(small, 0.5) * 2
