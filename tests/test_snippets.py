"""Python parity for the snippet operators: each test restates the plain-Python
rule and compares it with the column operator on edge and random inputs."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelmart.functions import arrays as A
from parcelmart.functions import text as T


def py_word_search(documents, keyword):
    """Positions of the documents that hold the keyword among their words, case and final '.' and ',' aside."""
    words = [{w.rstrip(".,") for w in text.lower().split()} for text in documents]
    return [at for at, found in enumerate(words) if keyword.lower() in found]


DOCS = [
    "Casino, tonight.",
    ".casino is leading punctuation",
    "casinoville is a different word",
    "under the NBSP casino sign",
    "record\x1cseparator\x1ccasino",
    "...",
    "tail casino.,.,",
    "",
    "CASINO",
    "ca sino",
    "Le chat et LE chien",
]


@pytest.mark.parametrize("keyword", ["casino", "Casino", "le", "", "casino.", "ca sino", "sino"])
def test_word_search_matches_python_rule(spark, keyword):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "doc_id long, text string")
    got = [r.doc_id for r in T.word_search(df, "text", [keyword], "doc_id").collect()]
    assert got == py_word_search(DOCS, keyword)


def test_word_search_keeps_each_given_keyword(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "doc_id long, text string")
    rows = T.word_search(df, "text", ["le", "LE"], "doc_id").collect()
    assert sorted((r.keyword, r.doc_id) for r in rows) == [("LE", 10), ("le", 10)]


def test_contains_word_predicate(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "text string")
    got = [r.v for r in df.select(T.contains_word("text", "casino").alias("v")).collect()]
    assert [i for i, v in enumerate(got) if v] == py_word_search(DOCS, "casino")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=20),
       st.integers(min_value=0, max_value=6))
def test_format_fixed_matches_python(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.v for r in df.select(T.format_fixed("x", digits).alias("v")).collect()]
    assert got == [f"{v:.{digits}f}" for v in values]


def test_format_fixed_known_cases(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (None,)], "x double")
    assert [r.v for r in df.select(T.format_fixed("x", 2).alias("v")).collect()] == ["0.12", "2.67", None]
    dec = spark.createDataFrame([(0.125,)], "x double").select(F.col("x").cast("decimal(10,3)").alias("x"))
    assert dec.select(T.format_fixed_decimal("x", 2).alias("v")).first().v == "0.12"


@pytest.mark.parametrize("n", [3, -3, 7, -7])
def test_py_mod(spark, n):
    values = list(range(-20, 21))
    df = spark.createDataFrame([(v,) for v in values], "a long")
    got = [r.v for r in df.select(T.py_mod("a", n).alias("v")).collect()]
    assert got == [v % n for v in values]


def test_py_mod_default_divisor(spark):
    df = spark.createDataFrame([(-7,), (7,)], "a long")
    assert [r.v for r in df.select(T.py_mod("a").alias("v")).collect()] == [-7 % 3, 7 % 3]


def test_index_of(spark):
    planets = ["Mercury", "Venus", "Earth", "Mars", "Earth"]
    df = spark.createDataFrame([(planets,), (["Mars"],), ([],)], "p array<string>")
    got = [r.v for r in df.select(A.index_of("p", "Earth").alias("v")).collect()]
    assert got == [planets.index("Earth"), None, None]


def test_any_multiple(spark):
    cases = [[1, 2, 14], [1, 2, 3], [], [0]]
    df = spark.createDataFrame([(c,) for c in cases], "n array<int>")
    got = [r.v for r in df.select(A.any_multiple("n", 7).alias("v")).collect()]
    assert got == [any(x % 7 == 0 for x in c) for c in cases]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(*[st.integers(min_value=-30, max_value=30)] * 3), min_size=1, max_size=10),
       st.lists(st.booleans(), min_size=3, max_size=3))
def test_min_as_int(spark, triples, pad):
    rows = [tuple(("0" + str(v)) if p and v >= 0 else str(v) for v, p in zip(t, pad)) for t in triples]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r.v for r in df.select(A.min_as_int("a", "b", "c").alias("v")).collect()]
    assert got == [min(r, key=int) for r in rows]


def test_min_as_int_tie_first_wins_and_bad_value(spark):
    df = spark.createDataFrame([("9", "09", "10"), ("x", "1", "2")], "a string, b string, c string")
    assert [r.v for r in df.select(A.min_as_int("a", "b", "c").alias("v")).collect()] == ["9", None]


def test_nested_index_like_python(spark):
    random.seed(1)
    x = [[random.random() for _ in range(4)] for _ in range(3)]
    df = spark.createDataFrame([(x, sum(x, []))], "x array<array<double>>, flat array<double>")
    r = df.select(A.at("x", 2, -1).alias("a"), A.at("x", 1, -1).alias("b"), A.at("x", 5, 0).alias("oob"),
                  A.at(A.rows_of("flat", 4), 2, -1).alias("reshaped")).first()
    assert (r.a, r.b, r.oob, r.reshaped) == (x[2][-1], x[1][-1], None, x[2][-1])


def test_to_array_and_add(spark):
    df = spark.createDataFrame([([1.5, 2.0],)], "v array<float>")
    r = df.select(A.add_scalar(A.to_double_array("v"), 10).alias("v")).first()
    assert r.v == [11.5, 12.0]


@pytest.mark.parametrize("grade", [45, 50, 49, 100, None])
def test_grade_sentence(spark, grade):
    df = spark.createDataFrame([(grade,)], "g int")
    r = df.select(T.pass_or_fail("g").alias("o"), T.grade_sentence("g").alias("m")).first()
    if grade is None:
        assert (r.o, r.m) == (None, None)
    else:
        outcome = "failed" if grade < 50 else "passed"
        assert r.o == outcome
        assert r.m == " ".join(map(str, ["You", outcome, "the quiz with a grade of", grade]))


def test_dict_lines(spark):
    numbers = {"one": 1, "two": None}
    df = spark.createDataFrame([(numbers,)], "m map<string,int>")
    got = sorted(r.line for r in T.map_lines(df, "m").collect())
    assert got == sorted("{} = {}".format(k, numbers[k]) for k in numbers)


@pytest.mark.parametrize("planet", ["Earth", "Jupiter", "Mercury123", "AVeryLongPlanetName"])
def test_rjust_line(spark, planet):
    df = spark.createDataFrame([(planet, planet[0])], "k string, i string")
    got = df.select(T.begins_with_line("k", "i").alias("v")).first().v
    assert got == '{} begins with "{}"'.format(planet.rjust(10), planet[0])


_ALPHABET = "aAbB.,é É\n\t\x1c  -"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=30), min_size=1, max_size=8),
       st.lists(st.text(alphabet="aAbBéÉ.,", min_size=0, max_size=3), min_size=1, max_size=3))
def test_word_search_property(spark, docs, keywords):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id long, text string")
    got = sorted((r.keyword, r.doc_id) for r in T.word_search(df, "text", keywords, "doc_id").collect())
    want = sorted({(k, i) for k in keywords for i in py_word_search(docs, k)})
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=30), min_size=1, max_size=8),
       st.lists(st.text(alphabet="aAbBéÉ.,", min_size=0, max_size=3), max_size=4))
def test_keyword_table_property(spark, docs, keywords):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id int, text string")
    table = spark.createDataFrame([(k,) for k in [*keywords, None]], "k string")
    got = sorted((r.keyword, r.doc_id) for r in T.keyword_hits(df, "text", table, "k", "doc_id").collect())
    assert got == sorted({(k, i) for k in keywords for i in py_word_search(docs, k)})


@pytest.mark.parametrize("threshold", ["-1", "64m"])
def test_keyword_table_of_many_keywords(spark, threshold):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, threshold)
        keywords = spark.range(100_000).select(F.concat(F.lit("W"), "id").alias("k"))
        # Every text holds "w7"; the others hold one word of their own, with and without a mark behind it.
        docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.format_string("w7 W%d., x%d w7", F.col("id") * 50, F.col("id")).alias("text"))
        hits = T.keyword_hits(docs.union(spark.createDataFrame([(None, None)], "doc_id long, text string")), "text", keywords, "k", "doc_id")
        counts = {r.keyword: r.n for r in hits.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert counts.pop("W7") == 3_000
        assert counts == {f"W{50 * i}": 1 for i in range(2_000)}
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
