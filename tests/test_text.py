"""Golden strings for the parsers and text helpers."""

from pyspark.sql import functions as F

from tabulon.functions import text as X
from tabulon.functions.numeric import band, bucket_floor, finite, rounded


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_year(spark):
    assert run(spark, ["(2019)", "2019", "(19)", "(2019) ", None, "(20191)"], X.parse_year) == [2019.0, None, None, None, None, None]


def test_minutes(spark):
    assert run(spark, ["109 min", "2 min", "min", "109min", "x 5 min", None], X.parse_minutes) == [109.0, 2.0, None, None, None, None]


def test_grouped_int(spark):
    got = run(spark, ["25,732", "12345", "1,234,567", "$5.16M", "7", "1,23", None], X.parse_grouped_int)
    assert got == [25732.0, None, 1234567.0, None, 7.0, None, None]


def test_tokens(spark):
    got = run(spark, ["Drama, , Drama", ",", "b,a , b", None, " 　x "], X.split_tokens)
    assert got == [["Drama"], None, ["b", "a"], None, ["x"]]


def test_lenient_inputs(spark):
    assert run(spark, ["(2024)", "2024", " 2024.0 ", "(2024.5)", "soon", None], X.lenient_year) == [2024.0, 2024.0, 2024.0, None, None, None]
    assert run(spark, ["120 min", "120", "120.0", "2 hours", None], X.lenient_minutes) == [120.0, 120.0, 120.0, None, None]


def test_strict_number(spark):
    got = run(spark, [" 1.5 ", "true", "NaN", "inf", "-3e2", "1,5", "", None, "."], X.strict_number)
    assert got == [1.5, None, None, None, -300.0, None, None, None, None]


def test_blank_and_padding(spark):
    assert run(spark, [" a ", "　", "", None], X.clean_text) == ["a", None, None, None]


def test_group_key_blank_titles_never_merge(spark):
    df = spark.createDataFrame([(1, "  The  FILM ", 2001.0), (2, "the film", 2001.0), (3, " ", 2001.0), (4, None, 2001.0), (5, "x", None)],
                               "id int, t string, y double")
    keys = [r[0] for r in df.orderBy("id").select(X.group_key("t", "y", "id")).collect()]
    assert keys == ["the film|2001", "the film|2001", "no title|3", "no title|4", "x|NA"]


def test_names(spark):
    df = spark.createDataFrame([(" b ", "a", "b"), (None, " ", "c")], "x string, y string, z string")
    got = df.select(X.name_set(["x", "y", "z"]), X.repeats_a_name(["x", "y", "z"])).collect()
    assert [tuple(r) for r in got] == [(["a", "b"], True), (["c"], False)]
    assert X.slug("Actor 1") == "actor_1"


def test_numeric_helpers(spark):
    df = spark.createDataFrame([(-5.0,), (5.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    got = df.select(finite("v")).collect()
    assert [r[0] for r in got] == [True, True, False, False, False]
    assert [r[0] for r in df.limit(2).select(bucket_floor("v", 10)).collect()] == [-10, 0]
    assert [r[0] for r in df.limit(2).select(band("v", [-10, 0, 10], ["neg", "pos"])).collect()] == ["neg", "pos"]
    assert str(spark.createDataFrame([(-1e-9,)], "v double").select(rounded("v")).first()[0]) == "0.0"
