"""The SQL helpers behave like the JDK calls they stand for (null where the JDK throws)."""

import pytest
from pyspark.sql import functions as F

from rulegrid.functions import parse_int, parse_long, register_functions, split_at, substr_strict

# Expected elements 0..2 of s.split(":") for edge strings; None = the call throws.
SPLIT_CASES = [
    ("a:", ["a", None, None]),
    ("a::", ["a", None, None]),
    (":", [None, None, None]),
    ("::", [None, None, None]),
    (":b", ["", "b", None]),
    ("a", ["a", None, None]),
    ("", ["", None, None]),
    ("a::b", ["a", "", "b"]),
    ("a:\n", ["a", "\n", None]),
    (None, [None, None, None]),
]


def test_split_at_edge_strings(spark):
    df = spark.createDataFrame([(s,) for s, _ in SPLIT_CASES], "s string")
    got = df.select("s", *[split_at("s", ":", k).alias(f"k{k}") for k in range(3)]).collect()
    by_input = {row.s: [row.k0, row.k1, row.k2] for row in got}
    for s, expected in SPLIT_CASES:
        assert by_input[s] == expected, s


def test_split_at_regex_delimiters(spark):
    register_functions(spark)
    row = spark.sql(
        r"""SELECT split_at('u1:SKM1|skm', '\\|', 1) AS bar,
                   split_at('y1s1.YYDS1', '\\.', 1) AS dot,
                   split_at('a1b22c', '[0-9]+', 2) AS digits,
                   split_at('a1b22c33', '[0-9]+', 2) AS digits_trailing,
                   split_at('x', ':', -1) AS negative"""
    ).first()
    assert row.bar == "skm"
    assert row.dot == "YYDS1"
    assert row.digits == "c"
    assert row.digits_trailing == "c"
    assert row.negative is None


@pytest.mark.parametrize(
    "s,b,e,expected",
    [("abcd", 0, 3, "abc"), ("ab", 0, 3, None), ("abc", 1, 1, ""), ("abc", 2, 1, None), ("abc", -1, 2, None),
     ("abc", 0, 3, "abc"), (None, 0, 1, None)],
)
def test_substr_strict(spark, s, b, e, expected):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(substr_strict("s", b, e).alias("v")).first().v == expected


def test_parse_int_and_long(spark):
    cases = ["12", "+5", "-7", "0012", " 12", "12 ", "1.5", "3000000000", "5\n", "", "+", None]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = {r.s: (r.i, r.l) for r in df.select("s", parse_int("s").alias("i"), parse_long("s").alias("l")).collect()}
    assert got["12"] == (12, 12)
    assert got["+5"] == (5, 5)
    assert got["-7"] == (-7, -7)
    assert got["0012"] == (12, 12)
    assert got["3000000000"] == (None, 3000000000)
    for bad in [" 12", "12 ", "1.5", "5\n", "", "+", None]:
        assert got[bad] == (None, None), repr(bad)


def test_helpers_stay_in_codegen(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("s"))
    plan = df.select(split_at("s", ":", 1), substr_strict("s", 0, 1), parse_int("s"))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    assert "*(" in text  # inside a WholeStageCodegen stage
