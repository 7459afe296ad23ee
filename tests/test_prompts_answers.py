"""F1, F2, F7, F8, F9, F17, M9 edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import answers as A
from rowsmith.functions import prompts as P


def test_render_braces_nulls_numbers(spark):
    df = spark.createDataFrame(
        [(1, "{x} in data", 2.0, None), (2, None, float("nan"), 7), (3, "y", 1e7, 0)],
        "id INT, s STRING, d DOUBLE, n INT",
    )
    tpl = "{{lit}} {s} | {d} | {n} }}"
    out = dict(df.select("id", P.render(tpl, {"s": "s", "d": "d", "n": "n"}).alias("p")).collect())
    assert out[1] == "{lit} {x} in data | 2.0 | nan }"  # braces from data stay
    assert out[2] == "{lit} nan | nan | 7 }"
    assert out[3] == "{lit} y | 10000000.0 | 0 }"  # Spark prints 1e7 as 1.0E7 (Python: 10000000.0)


def test_render_errors():
    with pytest.raises(P.TemplateError):
        P.render("{missing}", {})
    with pytest.raises(P.TemplateError):
        P.render("{}", {})
    with pytest.raises(P.TemplateError):
        P.render("{x:>10}", {"x": "x"})
    assert P.template_fields("a {x} {y} {x} {{z}}") == ["x", "y"]


def test_render_null_text_none_makes_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "s STRING")
    got = [r[0] for r in df.select(P.render("v={s}", {"s": "s"}, null_text=None)).collect()]
    assert got == ["v=a", None]


def test_static_and_context_json(spark):
    df = spark.createDataFrame([(1, [(1.5, "a"), (float("nan"), None)])], "id INT, arr ARRAY<STRUCT<x: DOUBLE, s: STRING>>")
    arr = F.transform("arr", lambda e: F.struct(P.nan_to_null(e["x"]).alias("x"), e["s"].alias("s")))
    r = df.select(P.static_prompt("hej").alias("p"), P.context_json(arr).alias("j")).first()
    assert r["p"] == "hej"
    assert r["j"] == '[{"x":1.5,"s":"a"},{"x":null,"s":null}]'


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("automatisk tjeneste", "Materialeindkøb"),  # "mat" is checked first
        ("Tjenesteydelse", "Tjenesteydelse"),
        ("", "Ukendt"),
        ("noget andet", "Ukendt"),
        (None, None),
    ],
)
def test_normalise_label(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "l STRING")
    assert df.select(A.normalise_label("l")).first()[0] == expected


SCHEMA = A.AnswerSchema.of(("label", "str"), ("secure", "int"))

PARSE_CASES = [
    ('{"label": "mat", "secure": 7}', ("mat", 7, "ok", [])),
    ('{"label": "mat", "secure": 7, "extra": 1}', ("mat", 7, "ok", [])),
    ('{"label": "mat"}', ("mat", None, "ok", ["secure:missing"])),
    ('{"label": "mat", "secure": 7.5}', ("mat", None, "ok", ["secure:not_int"])),
    ('{"label": "mat", "secure": 2.0}', ("mat", 2, "ok", [])),
    ('{"label": "mat", "secure": NaN}', ("mat", None, "ok", ["secure:not_int"])),
    ('{"label": 5, "secure": 1}', ("5", 1, "ok", [])),
    ("null", (None, None, "invalid", [])),
    ('[{"label": "mat"}]', (None, None, "invalid", [])),
    ("", (None, None, "empty", [])),
    ("   ", (None, None, "empty", [])),
    ('{"label": "mat", "sec', (None, None, "invalid", [])),
    ('```json\n{"label": "mat"}\n```', (None, None, "invalid", [])),
    ("{'label': 'mat'}", (None, None, "invalid", [])),
    (None, (None, None, "missing", [])),
]


def test_parse_answer_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PARSE_CASES)], "i INT, r STRING")
    out = A.with_parsed_answer(df, "r", SCHEMA).orderBy("i").collect()
    for (text, want), row in zip(PARSE_CASES, out):
        a = row["answer"]
        got = (a["label"], a["secure"], a["status"], list(a["violations"]))
        assert got == want, text


def test_parse_string_number_is_violation(spark):
    df = spark.createDataFrame([('{"label": "x", "secure": "7"}',)], "r STRING")
    a = A.with_parsed_answer(df, "r", SCHEMA).first()["answer"]
    # "7" as text for a number: not taken as 7 (json.loads would keep a str).
    assert a["secure"] is None


def test_parse_repeated_key(spark):
    df = spark.createDataFrame([('{"label": "first", "label": "last", "secure": 3}',)], "r STRING")
    a = A.with_parsed_answer(df, "r", SCHEMA).first()["answer"]
    # json.loads keeps the last value of a repeated key; so does Spark's parser.
    assert (a["label"], a["secure"], a["status"]) == ("last", 3, "ok")


def test_score_bands(spark):
    df = spark.createDataFrame([(s,) for s in [0, 1, 2, 3, 7, 8, 10, 11, None]], "s INT")
    got = [tuple(r) for r in df.select(A.score_band("s"), A.score_in_range("s")).collect()]
    assert got == [("out_of_range", False), ("hard", True), ("hard", True), ("unsure", True), ("unsure", True),
                   ("clear", True), ("clear", True), ("out_of_range", False), (None, None)]


def test_nested_pick(spark):
    df = spark.createDataFrame([('{"books": [{"author": "A"}, {"author": "B"}]}',), ('{"books": [{"author": "A"}]}',)], "r STRING")
    p = df.select(F.from_json("r", A.BOOKS_DDL, A.JSON_OPTIONS).alias("a"))
    assert [r[0] for r in p.select(A.pick("a.books", 2, "author")).collect()] == ["B", None]


def test_whole_int(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (float("nan"),), (None,), (1e12,)], "d DOUBLE")
    assert [r[0] for r in df.select(A.whole_int(F.col("d"))).collect()] == [2, None, None, None, None]
    assert math.isnan(float("nan"))


def test_numbers_print_as_python_prints_them(spark):
    import random

    from rowsmith.functions.prompts import json_item, number_text

    rng = random.Random(5)
    values = [12345678.9, 1e7, 1e16, 1e15, 123456789012345680.0, 1e-4, 0.0001234, 1e-5, 9.5e-5, 0.001, 0.0, -0.0, -2.5e7, 1e22, 2.2250738585072014e-308,
              1.7976931348623157e308, 100.0, -1e-7, float("nan"), float("inf"), float("-inf"), None]
    values += [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-12, 20) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    got = {r["i"]: r["t"] for r in df.select("i", number_text("v").alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [None if v is None else str(v) for v in values]
    import json

    items = {r["i"]: r["j"] for r in df.select("i", json_item({"a b": F.col("v"), "n": F.col("i")}, {"a b"}).alias("j")).collect()}
    for i, v in enumerate(values):
        finite = v is not None and v == v and abs(v) != float("inf")
        assert items[i] == json.dumps({"a b": v if finite else None, "n": i}, separators=(",", ":"))
    # Other types are untouched, text that looks like a number included.
    t = spark.createDataFrame([("1.0E7", 5)], "s STRING, n LONG").select(number_text("s"), number_text("n")).first()
    assert tuple(t) == ("1.0E7", "5")
