"""Randomised checks of the helpers against a Python model of the JDK calls.

Thousands of generated strings are evaluated in one Spark job per helper and
compared with a direct model of ``String.split``, ``String.substring`` and
``Integer.parseInt`` / ``Long.parseLong``.
"""

import random
import re

import pytest
from pyspark.sql import functions as F

from rulegrid.functions import parse_int, parse_long, register_functions, split_at


def java_split(s: str, pattern: str) -> list[str]:
    """``s.split(pattern)`` for a positive-width regex: [s] when nothing matches,
    otherwise the pieces with trailing empty strings removed."""
    if re.search(pattern, s) is None:
        return [s]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_element(s, pattern, k):
    if s is None or k < 0:
        return None
    parts = java_split(s, pattern)
    return parts[k] if k < len(parts) else None


def java_parse(s, bits):
    if s is None or not re.fullmatch(r"[+-]?[0-9]+", s, flags=re.ASCII):
        return None
    value = int(s)
    limit = 2 ** (bits - 1)
    return value if -limit <= value < limit else None


def java_substring(s, b, e):
    if s is None or b < 0 or b > e or e > len(s):
        return None
    return s[b:e]


def random_strings(seed: int, alphabet: str, n: int, max_len: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, max_len))) for _ in range(n)]


@pytest.mark.parametrize(
    "pattern,sql_pattern,alphabet",
    [(":", ":", "ab:"), (r"\|", r"\|", "a|:"), (r"\.", r"\.", "x.1"), ("[0-9]+", "[0-9]+", "ab12"), ("::", "::", "a::")],
)
def test_split_at_matches_java_model(spark, pattern, sql_pattern, alphabet):
    strings = sorted(set(random_strings(7, alphabet, 3000, 8))) + [None]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    ks = range(0, 5)
    got = df.select("s", *[split_at("s", sql_pattern, k).alias(f"k{k}") for k in ks]).collect()
    for row in got:
        for k in ks:
            assert row[f"k{k}"] == java_element(row.s, pattern, k), (row.s, k)


def test_parse_matches_java_model(spark):
    rng = random.Random(11)
    strings = random_strings(3, "0123456789+- ", 2000, 12)
    strings += [str(rng.randint(-(2**40), 2**40)) for _ in range(2000)]
    strings += ["2147483647", "2147483648", "-2147483648", "-2147483649", "00000000002147483647",
                "9223372036854775807", "9223372036854775808", "-9223372036854775808", "+0", "-0", None]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for row in df.select("s", parse_int("s").alias("i"), parse_long("s").alias("l")).collect():
        assert row.i == java_parse(row.s, 32), row.s
        assert row.l == java_parse(row.s, 64), row.s


def test_substr_strict_matches_java_model(spark):
    rng = random.Random(5)
    cases = [(s, rng.randint(-1, 6), rng.randint(-1, 8)) for s in random_strings(9, "abc", 1000, 6)]
    df = spark.createDataFrame(cases + [(None, 0, 1)], "s string, b int, e int")
    register_functions(spark)
    out = df.select("s", "b", "e", F.call_function("substr_strict", "s", "b", "e").alias("v"))
    for row in out.collect():
        assert row.v == java_substring(row.s, row.b, row.e), (row.s, row.b, row.e)
