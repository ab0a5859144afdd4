"""Rules that raise, whatever raises and wherever it stands, and the reasons told for it."""

import pytest
from pyspark.sql import functions as F

from rulegrid.operators import check_rules, rules_failures, rules_long, rules_reasons, rules_wide
from rulegrid.operators import attempts
from rulegrid.plans.rulebook import EXAMPLE_RULES


@pytest.fixture(scope="module")
def records(spark):
    rows = [(1, "12:", 0, 5), (2, "x:34", 1, 6), (3, "e:f", -5, None), (4, None, 2, 0)]
    return spark.createDataFrame(rows, "id int, t string, c int, n bigint").repartition(3)


def values(records, rules):
    return {r.id: tuple(r)[1:] for r in rules_wide(records, rules, keys=["id"]).collect()}


def test_a_record_that_fails_does_not_decide_over_others(records):
    got = values(records, {"i": "element_at(split(t, ':'), c)", "p": "split_part(t, ':', c)", "s": "size(sequence(1, 3, c))", "b": "if(c = 1, raise_error('x'), n)"})
    assert got == {1: (None, None, None, 5), 2: ("x", "x", 3, None), 3: (None, "", None, None), 4: (None, None, 2, 0)}


def test_what_several_rules_share_raises_inside_each(records):
    shared = "element_at(split(t, ':'), c)"
    got = values(records, {"a": shared, "b": f"{shared} || 'x'", "c": f"upper({shared})", "d": f"coalesce({shared}, t)", "e": f"between({shared}, 'a', 'z')"})
    assert got[1] == (None, None, None, None, None) and got[2] == ("x", "xx", "X", "x", True) and got[3] == (None, None, None, "e:f", None)


def test_an_argument_of_a_helper_may_raise(records):
    got = values(records, {"h": "split_at(element_at(split(t, ':'), c), 'y', 0)", "k": "CASE WHEN c = 0 THEN 'none' ELSE split_at(element_at(split(t, ':'), c), 'y', 0) END",
                           "m": "parse_int(substr_strict(split_part(t, ':', c), 0, 1))", "l": "parse_long(split_part(t, ':', c + 1))"})
    assert got == {1: (None, "none", None, 12), 2: ("x", "x", None, 34), 3: (None, None, None, None), 4: (None, None, None, None)}


def test_a_pattern_of_the_record_may_be_bad(records):
    rules = {"p": "split(t, repeat('(', c))[0]", "h": "split_at(t, repeat('(', c), 0)", "r": "t rlike repeat('[', c)"}
    assert values(records, rules)[2] == (None, None, None)
    assert not check_rules(records, rules)
    assert [p.rule_id for p in check_rules(records, {"x": "t rlike '['", "y": "regexp_replace(t, '(', '')", "z": "split(t, '(')"})] == ["x", "y", "z"]


def test_integers_wrap_and_the_session_keeps_its_mode(spark, records):
    assert values(records, {"w": "2147483647 + id"})[1] == (-(2**31),)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true" and spark.range(1).sparkSession is spark
    out = rules_wide(records, {"w": "id + 1"}, keys=["id"])
    assert out.sparkSession is spark and out.join(records, "id").count() == 4


def test_known_rules_stay_unguarded_in_one_compiled_stage(records):
    assert all(attempts.is_total(records, attempts.parse(records.sparkSession, r)) for r in EXAMPLE_RULES.values())
    plan = rules_wide(records, {"a": "split_at(t, ':', 1)", "b": "parse_int(t) + c"}, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "tryeval" not in plan
    plan = rules_wide(records, {"a": "element_at(split(t, ':'), c)"}, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "tryeval" in plan and "Exchange hash" not in plan and "Python" not in plan


def test_no_job_runs_to_build_rules(spark, records):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    rules_wide(records, {"a": "element_at(split(t, ':'), c)", "bad": "nope"}, ["id"])
    rules_reasons(records, {"a": "element_at(split(t, ':'), c)", "bad": "nope"}, ["id"])
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("", "")


REASONED = {
    "index": "element_at(split(t, ':'), c)", "meant": "nullif(c, 0)", "case": "CASE WHEN c > 5 THEN c END", "cast": "cast(split(t, ':')[0] AS int)", "zero": "10 div c",
    "inner": "upper(split_at(t, ':', 1)) || cast(10 / c AS string)", "raise": "if(c = 1, raise_error('no'), NULL)", "strict": "substr_strict(t, 0, 4)",
    "number": "parse_int(split_at(t, ':', 0))", "tried": "try_divide(1, c)", "branch": "CASE WHEN c = 0 THEN 1 div c WHEN c = 1 THEN cast(t AS int) END", "bad": "nope",
    "step": "sequence(1, 3, c)",
}


def test_reasons_tell_failures_from_nulls_that_are_meant(records):
    got = {(r.id, r.rule_id): r.reason for r in rules_reasons(records, REASONED, ["id"]).collect()}
    expected = {
        (1, "index"): "INVALID_INDEX_OF_ZERO", (3, "index"): "INVALID_ARRAY_INDEX_IN_ELEMENT_AT", (2, "cast"): "CAST_INVALID_INPUT", (3, "cast"): "CAST_INVALID_INPUT",
        (1, "zero"): "DIVIDE_BY_ZERO", (1, "inner"): "NO_SUCH_ELEMENT", (4, "inner"): "NULL_ARGUMENT", (2, "raise"): "USER_RAISED_EXCEPTION",
        (1, "strict"): "SUBSTRING_OUT_OF_RANGE", (3, "strict"): "SUBSTRING_OUT_OF_RANGE", (4, "strict"): "NULL_ARGUMENT", (2, "number"): "NUMBER_FORMAT", (3, "number"): "NUMBER_FORMAT",
        (4, "number"): "NULL_ARGUMENT", (1, "branch"): "DIVIDE_BY_ZERO", (2, "branch"): "CAST_INVALID_INPUT", (1, "step"): "ILLEGAL_SEQUENCE", (3, "step"): "ILLEGAL_SEQUENCE",
        **{(i, "bad"): "DOES_NOT_COMPILE" for i in range(1, 5)},
    }
    assert got == expected


def test_reasons_of_odd_input(spark, records):
    assert rules_reasons(records, {}, ["id"]).count() == 0 and rules_reasons(records, {}, ["id"]).columns == ["id", "rule_id", "reason"]
    assert rules_reasons(records.where("false"), REASONED, ["id"]).count() == 0
    clashing = records.withColumnsRenamed({"c": "_null0", "n": "_r0", "t": "_key0"})
    got = rules_reasons(clashing, {"x.y": "10 div _null0", "z": "cast(_key0 AS int)"}, ["id", "_r0"])
    assert got.columns == ["id", "_r0", "rule_id", "reason"]
    assert {(r.id, r.rule_id) for r in got.collect()} == {(1, "x.y"), (1, "z"), (2, "z"), (3, "z")}
    long = rules_long(clashing, {"x": "element_at(split(_key0, ':'), _null0)"}, ["id"])
    assert long.where("result is not null").count() == 1
    assert rules_failures(records, {"x": "element_at(split(t, ':'), c)"}).first().n_failed == 3


def test_precise_arithmetic_of_any_rule(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(1, 7, 2, 0.1, "a:5")], "id int, x int, y bigint, f double, t string")
    rules = {"q": "x / 3", "d": "x div y", "m": "-x * 3 + y", "f": "f + f + f", "p": "parse_int(split_at(t, ':', 1)) / 8", "c": "CASE WHEN x / 3 > 2.3333333332 THEN 'more' ELSE 'less' END",
             "s": "substr_strict(t, 0, 1)", "n": "x IN (7, 8)", "z": "x / (y - 2)", "e": "element_at(split(t, ':'), x - 7)", "l": "1.5 * y"}
    row = rules_wide(df, rules, precise=True).first()
    assert (row.q, row.d, row.m, row.f, row.p) == tuple(map(Decimal, ("2.3333333333", "3.5000000000", "-19.0000000000", "0.3000000000", "0.6250000000")))
    assert (row.c, row.s, row.n, row.z, row.e, row.l) == ("more", "a", True, None, None, Decimal("3.0000000000"))
    assert rules_wide(df, {"q": "x / 3"}).first().q == 7 / 3
