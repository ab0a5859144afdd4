"""Results that keep their types, and variables of dynamic type."""

import pytest
from pyspark.sql import functions as F

from rulegrid.operators import dynamic, rules_long_typed, rules_variant


def typed(frame, *keys):
    assert frame.schema["result"].dataType.simpleString() == "variant"
    rows = frame.withColumn("result", F.to_json("result")).collect()
    assert len(rows) == len({(*[r[k] for k in keys], r.rule_id) for r in rows})
    return {(*[r[k] for k in keys], r.rule_id): (r.type, r.result) for r in rows}


@pytest.fixture(scope="module")
def records(spark):
    rows = [(1, '{"a": 2, "t": "x:7", "n": {"k": 1}}'), (2, '{"a": "5", "t": "y"}'), (3, '{"a": 1.5, "t": 9}'), (4, '{"a": null, "l": [1, 2, 3]}'), (5, "[1]"), (6, None),
            (7, '{"a": [1], "a b": 3, "it\'s": 4}'), (8, '{"A": 2}')]
    return spark.createDataFrame(rows, "id int, j string").select("id", F.parse_json("j").alias("v"), F.lit("real").alias("a")).repartition(3)


def test_branches_of_a_result_keep_their_types(spark):
    df = spark.createDataFrame([(1, 5, "x"), (2, -1, None), (3, None, "z")], "id int, n bigint, s string")
    rules = {"case": "CASE WHEN n > 0 THEN 2 WHEN n < 0 THEN '1 or 0' END", "if": "if(n > 0, s, n)", "first": "coalesce(s, n, true)", "deep": "coalesce(if(n > 0, 1.50BD, null), s, false)",
             "plain": "n + 1", "raise": "CASE WHEN n < 0 THEN raise_error('x') ELSE date'2024-02-03' END", "bad": "nothing + 1", "list": "array(n, 1L)"}
    got = typed(rules_long_typed(df, rules, ["id"]), "id")
    null = (None, None)
    assert [got[i, "case"] for i in (1, 2, 3)] == [("bigint", "2"), ("string", '"1 or 0"'), null]
    assert [got[i, "if"] for i in (1, 2, 3)] == [("string", '"x"'), ("bigint", "-1"), null]
    assert [got[i, "first"] for i in (1, 2, 3)] == [("string", '"x"'), ("bigint", "-1"), ("string", '"z"')]
    assert [got[i, "deep"] for i in (1, 2, 3)] == [("decimal", "1.5"), ("boolean", "false"), ("string", '"z"')]
    assert [got[i, "raise"] for i in (1, 2, 3)] == [("date", '"2024-02-03"'), null, ("date", '"2024-02-03"')]
    assert [got[i, "bad"] for i in (1, 2, 3)] == [null] * 3 and got[1, "list"] == ("array", "[5,1]") and got[1, "plain"] == ("bigint", "6")
    precise = typed(rules_long_typed(df, {"q": "if(s = 'x', n / 2, 'none')"}, ["id"], precise=True), "id")
    assert precise[1, "q"] == ("decimal", "2.5") and precise[3, "q"] == ("string", '"none"')
    assert rules_long_typed(df, {}, ["id"]).count() == 0 and rules_long_typed(df.where("false"), rules, ["id"]).count() == 0


def test_variables_have_the_type_of_their_record(records):
    rules = {"add": "a + 1", "text": "split_at(t, ':', 1)", "id": "id", "size": "size(cast(l AS array<int>))", "quoted": "`a b` * 2", "quote": "`it's` + 1", "none": "42",
             "broken": "a +", "pattern": "split_at(t, '(', 0)", "any": "coalesce(a, 'no a')", "map": "transform(array(1, 2), x -> x + a)[1]", "own": "transform(array(6), a -> a)[0]"}
    got = typed(rules_variant(records, "v", rules, ["id"]), "id")
    null = (None, None)
    assert len(got) == 8 * len(rules)
    assert [got[i, "add"] for i in range(1, 9)] == [("bigint", "3"), ("double", "6.0"), ("decimal", "2.5"), null, null, null, null, null]
    assert [got[i, "text"] for i in (1, 2, 3, 4)] == [("string", '"7"'), null, null, null]
    assert got[1, "map"] == ("bigint", "4") and got[3, "map"] == ("decimal", "3.5") and got[4, "map"] == null and got[2, "own"] == ("bigint", "6")
    assert got[4, "size"] == ("bigint", "3") and got[7, "quoted"] == ("bigint", "6") and got[7, "quote"] == ("bigint", "5")
    assert all(got[i, "none"] == ("bigint", "42") and got[i, "broken"] == got[i, "pattern"] == got[i, "id"] == null for i in range(1, 9))
    assert got[7, "any"] == ("array", "[1]") and all(got[i, "any"] == ("string", '"no a"') for i in (4, 5, 6, 8))


def test_given_kinds_spare_the_pass_and_bound_the_types(records):
    rules = {"add": "a + 1", "none": "1"}
    given = typed(rules_variant(records, "v", rules, ["id"], kinds={"a": ["bigint", "decimal"]}), "id")
    assert [given[i, "add"] for i in (1, 2, 3, 4)] == [("bigint", "3"), (None, None), ("decimal", "2.5"), (None, None)] and given[5, "none"] == ("bigint", "1")


def test_one_narrow_pass_and_a_stated_bound(records, monkeypatch):
    plan = rules_variant(records, "v", {"add": "a + 1", "b": "a || t"}, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan  # the fixture's own repartition
    assert rules_variant(records.where("false"), "v", {"add": "a + 1"}, ["id"]).count() == 0
    assert rules_variant(records, "v", {}, ["id"]).count() == 0
    monkeypatch.setattr(dynamic, "MAX_COMBINATIONS", 2)
    with pytest.raises(ValueError, match="combinations"):
        rules_variant(records, "v", {"add": "a + 1"}, ["id"])


def test_names_of_helpers_do_not_clash(records):
    odd = records.withColumns({"_kind0": F.col("id"), "__r0": F.lit("k")})
    got = typed(rules_variant(odd, "v", {"_kind0": "a + 1", "v": "t"}, ["_kind0", "__r0"]), "_kind0", "__r0")
    assert got[1, "k", "_kind0"] == ("bigint", "3") and got[3, "k", "v"] == ("bigint", "9")
