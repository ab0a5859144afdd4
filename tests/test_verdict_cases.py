"""Cases where results or plans once went wrong: restarts, wide decimals, long lists, failing rules, hot keys."""

import os
import subprocess
import sys
from decimal import Decimal, localcontext

import pytest

from conftest import REPO
from rulegrid.operators import check_rules, evaluate_record, in_list_group_sum, join_group_sum, rules_failures, rules_long, rules_wide
from rulegrid.operators import keyed_sums
from rulegrid.operators.rules import project_rules
from pyspark.sql.types import IntegerType

APPLICATION = """
import sys
sys.path.insert(0, {repo!r})
from rulegrid.session import build_session
from rulegrid.streaming import start_rules_to_parquet
spark = build_session("local[2]", shuffle_partitions=2, conf={{"spark.checkpoint.dir": {ckpt!r}}})
spark.range({start}, {end}).write.mode("append").parquet({src!r})
stream = spark.readStream.schema("id bigint").parquet({src!r})
start_rules_to_parquet(stream, {{"r": "id + 1"}}, ["id"], {out!r}, name="restart", available_now=True).awaitTermination(120)
"""


def test_stream_restarted_in_a_new_application_loses_nothing(spark, tmp_path):
    places = {k: str(tmp_path / k) for k in ("ckpt", "src", "out")}
    for start, end in ((0, 400), (400, 1000)):
        code = APPLICATION.format(repo=REPO, start=start, end=end, **places)
        subprocess.run([sys.executable, "-c", code], check=True, timeout=180, env={**os.environ, "PYTHONPATH": REPO}, capture_output=True)
    assert spark.read.parquet(places["out"]).distinct().count() == 1000


@pytest.mark.parametrize("kind,places", [("decimal(18,8)", 8), ("decimal(20,10)", 10), ("decimal(38,10)", 10), ("decimal(38,30)", 30)])
def test_joined_decimal_sums_are_exact(spark, kind, places):
    a = spark.createDataFrame([(1, 1, 1)] * 3, "sch_org_id bigint, org_id int, inv_item_id bigint")
    small = "0." + "0" * (places - 1) + "1"
    b = spark.sql(f"SELECT 1L AS org_id, 1L AS item_id, explode(array(cast('0.12345678' AS {kind}), cast('{small}' AS {kind}))) AS shuju")
    with localcontext(prec=60):
        assert join_group_sum(a, b).first().m == 3 * (Decimal("0.12345678") + Decimal(small))


def test_overflow_counts_only_where_keys_join(spark):
    a = spark.createDataFrame([(1, 1, 1)], "sch_org_id bigint, org_id int, inv_item_id bigint")
    big = 2**63 - 1
    b = spark.createDataFrame([(1, 1, 5), (2, 2, big), (2, 2, big)], "org_id bigint, item_id bigint, shuju bigint")
    assert [r.m for r in join_group_sum(a, b).collect()] == [5]


def test_hot_key_of_the_joined_sum_is_split(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("10k", "10k", "-1", "-1", "false")):
            spark.conf.set(k, v)
        a = spark.range(60000).repartition(8).selectExpr("if(id % 3 = 0, 1, id) as sch_org_id", "cast(id as int) as org_id", "if(id % 3 = 0, 1, id) as inv_item_id")
        b = spark.range(60000).selectExpr("id as org_id", "id as item_id", "1.0D as shuju")
        out = join_group_sum(a, b)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("items", [["100"], [100.0], [100], [2**40, 100]])
def test_long_lists_behave_like_short_ones(spark, items):
    b = spark.createDataFrame([(1, 100, 5.0), (1, 101, 7.0)], "org_id int, item_id int, shuju double")
    more = [type(items[0])(str(k)) if isinstance(items[0], str) else type(items[0])(k) for k in range(1000, 1000 + keyed_sums.LITERAL_MAX_KEYS + 100)]
    short = [tuple(r) for r in in_list_group_sum(b, items, [1]).collect()]
    assert short == [tuple(r) for r in in_list_group_sum(b, items + more, [1]).collect()] == [(1, "oi001", 100, 5.0)]


def test_large_string_keys_are_not_broadcast(spark):
    from rulegrid.plans.keysets import BROADCAST_MAX_BYTES, KeySets

    keys = spark.createDataFrame([("x",)], "item_id string")
    sets = KeySets(keys, keys, 10, 10, BROADCAST_MAX_BYTES + 1, 5)
    judged = list(keyed_sums._each_set(sets, 1000))
    assert [(c, small) for _, c, _, small in judged] == [("org_id", True), ("item_id", False)]


PLAIN = {"cast": "cast(t as int)", "zero": "a / z", "index": "split(t, ':')[9]", "wrap": "2147483647 + a", "ok": "a + 1"}


def test_plain_rules_give_null_instead_of_stopping(spark):
    df = spark.createDataFrame([(1, "x:y", 0)], "a int, t string, z int")
    row = rules_wide(df, PLAIN).first()
    assert (row["cast"], row["zero"], row["index"], row["wrap"], row["ok"]) == (None, None, None, -(2**31), 2)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_bad_patterns_and_windows_are_reported(spark):
    df = spark.createDataFrame([(1, "x:y")], "a int, t string")
    rules = {"pattern": "split_at(t, '(', 1)", "window": "sum(a) over ()", "ok": "a"}
    assert {p.rule_id for p in check_rules(df, rules)} == {"pattern", "window"}
    assert tuple(rules_wide(df, rules).first()) == (None, None, 1)


def test_any_rule_id(spark):
    df = spark.createDataFrame([(1, 2)], "event_id int, a int")
    rules = {"r.1": "a", "n": "a + 1", "R1": "a + 2", "r1": "a + 3", "EVENT_ID": "a + 4"}
    long = {r.rule_id: r.result for r in rules_long(df, rules, ["event_id"]).collect()}
    assert long == {"r.1": "2", "n": "3", "R1": "4", "r1": "5", "EVENT_ID": "6"}
    assert {r.rule_id for r in rules_failures(df, rules).collect()} == set(rules)
    with pytest.raises(ValueError):
        rules_wide(df, rules, ["event_id"])
    assert rules_wide(df, {"r.1": "a", "n": "a"}, ["event_id"]).columns == ["event_id", "r.1", "n"]


def test_fallback_types_and_null_variables(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rules_wide(df, {"bad": "nope + 1"}, fallback_types={"bad": IntegerType()}).schema["bad"].dataType == IntegerType()
    assert evaluate_record(spark, {"r": "coalesce(x, 'none')", "s": "a + 1"}, {"x": None, "a": 1}) == {"r": "none", "s": 2}
    assert project_rules(df, {"x": "a"}).rule_ids == ["x"]
