"""Rule evaluation: the example rules on the example record, failures, bad rules, shapes."""

from decimal import Decimal

from pyspark.sql import functions as F

from rulegrid.operators import check_rules, evaluate_record, rules_failures, rules_long, rules_wide
from rulegrid.plans.rulebook import EXAMPLE_RULES, EXAMPLE_RULES_DECIMAL, EXAMPLE_RULES_LONG

# The example evaluation record and the results it must give.
CONTEXT = {
    "text1": "step1:abc",
    "text2": "step1:thisIsNil",
    "text3": "u1:SKM1|skm",
    "text4": "y1s1.YYDS1|superStar",
    "text5": "a:123",
    "text6": "a:1024",
    "length": 6,
    "a": 1,
    "b": 2,
    "c": -3,
    "d": 10,
    "e": 12,
    "f": 4,
}
EXPECTED = {
    "r1": "abc.step",
    "r2": "thisIsNil.step",
    "r3": "skm.SKM.UNIT",
    "r4": "superStar.YYDS.UNIT",
    "r5": 128,
    "r6": 1029,
    "r7_int": 2,
    "r7_dec": Decimal("2.0000000000"),
    "r8": "2",
    "r9": 134,
    "r10": True,
}

SCHEMA = (
    "id bigint, text1 string, text2 string, text3 string, text4 string, text5 string, text6 string, "
    "length int, a int, b int, c int, d int, e int, f int"
)


def context_df(spark, **overrides):
    values = {**CONTEXT, **overrides}
    return spark.createDataFrame([(1, *values.values())], SCHEMA)


def test_example_rules_on_example_record(spark):
    row = rules_wide(context_df(spark), EXAMPLE_RULES, keys=["id"]).first().asDict()
    assert {k: row[k] for k in EXPECTED} == EXPECTED


def test_ternary_other_branch(spark):
    row = rules_wide(context_df(spark, c=3), {"r8": EXAMPLE_RULES["r8"]}).first()
    assert row.r8 == "1 or 0"


def test_long_parse(spark):
    row = rules_wide(context_df(spark, text6="a:3000000000"), {**EXAMPLE_RULES_LONG, "r6": EXAMPLE_RULES["r6"]}).first()
    assert row.r5_long == 128
    assert row.r6_long == 3000000005
    assert row.r6 is None  # beyond 32 bits: the 32-bit parse fails


def test_decimal_arithmetic(spark):
    row = rules_wide(context_df(spark), EXAMPLE_RULES_DECIMAL).first()
    assert row.r9_dec == Decimal("134.0000000000")
    row = rules_wide(context_df(spark, e=13), EXAMPLE_RULES_DECIMAL).first()
    assert row.r9_dec == Decimal("144.3333333333")


def test_failing_records_give_null(spark):
    df = context_df(spark, text1="step1:", text4="y1.5|x", text5="a: 1", a=2**31 - 1, f=None)
    row = rules_wide(df, EXAMPLE_RULES).first()
    assert row.r1 is None  # trailing empty element does not exist
    assert row.r4 is None  # substring past the end
    assert row.r5 is None  # blank inside the number
    assert row.r8 is None  # overflow in the discriminant
    assert row.r10 is False  # null is not in the list
    assert row.r2 == "thisIsNil.step"


def test_bad_rules_are_reported_not_raised(spark):
    rules = {
        "ok": "a + b",
        "unknown_column": "nope + 1",
        "unbalanced": "split_at(text1, ':', 1",
        "wrong_types": "array(1) + 1",
        "aggregate": "sum(a)",
        "generator": "explode(array(1, 2))",
    }
    df = context_df(spark)
    problems = {p.rule_id for p in check_rules(df, rules)}
    assert problems == set(rules) - {"ok"}
    wide = rules_wide(df, rules, keys=["id"])
    assert wide.count() == 1
    row = wide.first()
    assert row.ok == 3
    assert all(row[r] is None for r in problems)


def test_long_form_and_failures(spark):
    df = spark.createDataFrame(
        [(1, *CONTEXT.values()), (2, *{**CONTEXT, "text1": "x:"}.values())], SCHEMA
    )
    rules = {"r1": EXAMPLE_RULES["r1"], "r5": EXAMPLE_RULES["r5"], "r10": EXAMPLE_RULES["r10"], "bad": "nope"}
    long = rules_long(df, rules, keys=["id"])
    assert long.columns == ["id", "rule_id", "result"]
    got = {(r.id, r.rule_id): r.result for r in long.collect()}
    assert got[(1, "r1")] == "abc.step" and got[(2, "r1")] is None
    assert got[(1, "r5")] == "128" and got[(1, "r10")] == "true"
    assert got[(1, "bad")] is None and len(got) == 8
    failures = {r.rule_id: (r.n, r.n_failed) for r in rules_failures(df, rules).collect()}
    assert failures == {"r1": (2, 1), "r5": (2, 0), "r10": (2, 0), "bad": (2, 2)}


def test_rule_projection_is_one_narrow_stage(spark):
    df = context_df(spark)
    plan = rules_long(df, EXAMPLE_RULES, keys=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_rules_on_many_rows_match_row_by_row(spark):
    # Same rules on 200 generated records: each row equals evaluating it alone.
    df = spark.range(200).select(
        F.col("id"),
        F.concat(F.lit("k:"), (F.col("id") % 7).cast("string")).alias("text1"),
        F.lit("p:q").alias("text2"),
        F.lit("u1:SKM1|skm").alias("text3"),
        F.concat(F.lit("y1."), (F.col("id") * 37).cast("string"), F.lit("|z")).alias("text4"),
        F.concat(F.lit("a:"), F.col("id").cast("string")).alias("text5"),
        F.lit("a:1").alias("text6"),
        F.col("id").cast("int").alias("length"),
        (F.col("id") % 7).cast("int").alias("a"),
        (F.col("id") % 5).cast("int").alias("b"),
        (F.col("id") % 4 - 1).cast("int").alias("c"),
        (F.col("id") % 11).cast("int").alias("d"),
        (F.col("id") % 13).cast("int").alias("e"),
        (F.col("id") % 9).cast("int").alias("f"),
    )
    got = {r.id: r for r in rules_wide(df, EXAMPLE_RULES, keys=["id"]).collect()}
    for i in (0, 1, 26, 27, 28, 199):
        e, d, a, b, c = i % 13, i % 11, i % 7, i % 5, i % 4 - 1
        assert got[i].r4 == (None if i * 37 < 1000 else f"z.{str(i * 37)[:4]}.UNIT")
        assert got[i].r5 == i + 5
        assert got[i].r7_int == i // 3
        assert got[i].r9 == d + e // 3 + d * e
        assert got[i].r8 == ("2" if (a + b) ** 2 - 4 * a * c > 0 else "1 or 0")
        assert got[i].r10 == (1 <= i % 9 <= 5)


def test_evaluate_one_record(spark):
    got = evaluate_record(spark, {**EXAMPLE_RULES, "bad": "nope(1)"}, CONTEXT)
    assert {k: got[k] for k in EXPECTED} == EXPECTED
    assert got["bad"] is None
    # With 32-bit variables, as in the source's contexts, a + b overflows at 2^31.
    schema = SCHEMA.split(", ", 1)[1]
    record = {**CONTEXT, "a": 2**31 - 1, "b": 1}
    assert evaluate_record(spark, {"s": "try_add(a, b)"}, record, schema)["s"] is None
    assert evaluate_record(spark, {"s": "try_add(a, b)"}, record)["s"] == 2**31


def test_empty_rule_set_and_clashing_ids(spark):
    import pytest

    df = context_df(spark)
    assert rules_wide(df, {}, keys=["id"]).columns == ["id"]
    assert rules_long(df, {}, keys=["id"]).count() == 0
    assert rules_long(df, {}, keys=["id"]).columns == ["id", "rule_id", "result"]
    assert rules_failures(df, {}).count() == 0
    with pytest.raises(ValueError):
        rules_wide(df, {"id": "a + b"}, keys=["id"])
