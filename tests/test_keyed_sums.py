"""Grouped sums on a hand-made fixture with duplicates, null keys and null values."""

import pytest

from rulegrid.operators import (
    filter_in_lists,
    group_sum,
    in_keys_group_sum,
    in_list_group_sum,
    in_list_group_sum_from_keys,
    join_group_sum,
    join_two_keys,
)
from rulegrid.operators.keyed_sums import filter_in_lists_from_keys

A_ROWS = [(1, 10, 100), (1, 10, 100), (1, 11, 100), (2, 10, 101), (None, 10, 100)]
B_ROWS = [(1, 100, 5.0), (1, 100, 7.0), (2, 101, None), (2, 100, 3.0), (1, 101, 4.0), (None, 100, 9.0)]


@pytest.fixture()
def a(spark):
    return spark.createDataFrame(A_ROWS, "sch_org_id bigint, org_id int, inv_item_id bigint")


@pytest.fixture()
def b(spark):
    return spark.createDataFrame(B_ROWS, "org_id bigint, item_id bigint, shuju double")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_join_group_sum(a_rows, b_rows):
    """The joined sum by definition: every matching pair contributes once."""
    out = {}
    for s, o, i in a_rows:
        for bo, bi, v in b_rows:
            if s is not None and i is not None and bo == s and bi == i:
                key = (s, o, i)
                prev = out.get(key, "absent")
                if prev == "absent":
                    out[key] = v
                elif v is not None:
                    out[key] = v if prev is None else prev + v
    return sorted(((*k, v) for k, v in out.items()), key=repr)


def test_join_group_sum_fan_out(a, b):
    assert rows(join_group_sum(a, b)) == sorted(
        [(1, 10, 100, 24.0), (1, 11, 100, 12.0), (2, 10, 101, None)], key=repr
    )
    assert rows(join_group_sum(a, b)) == brute_join_group_sum(A_ROWS, B_ROWS)


def test_join_group_sum_never_materialises_pairs(spark, a, b):
    # Many a rows and many b rows on one key: the result must not need the pairs.
    hot_a = spark.createDataFrame([(7, k % 3, 70) for k in range(3000)], a.schema)
    hot_b = spark.createDataFrame([(7, 70, 1.0) for _ in range(3000)], b.schema)
    got = rows(join_group_sum(hot_a, hot_b))
    assert got == [(7, 0, 70, 3000000.0), (7, 1, 70, 3000000.0), (7, 2, 70, 3000000.0)]
    plan = join_group_sum(hot_a, hot_b)._jdf.queryExecution().optimizedPlan().toString()
    # Both inputs are aggregated below the join.
    assert plan.count("Aggregate") >= 2


def test_join_group_sum_integer_and_decimal_types(spark):
    a = spark.createDataFrame([(1, 1, 1), (1, 1, 1)], "sch_org_id bigint, org_id int, inv_item_id bigint")
    for sql_type, value, expected_type in [("bigint", 5, "bigint"), ("decimal(10,2)", "2.50", "decimal(20,2)")]:
        b = spark.sql(f"SELECT 1L AS org_id, 1L AS item_id, CAST('{value}' AS {sql_type}) AS shuju")
        out = join_group_sum(a, b)
        assert out.schema["m"].dataType.simpleString() == expected_type
        assert float(out.first().m) == 2 * float(value)


def test_join_two_keys(a, b):
    # The pairs (1,10,100,5), (1,10,100,7) each occur twice: the duplicate a row.
    got = rows(join_two_keys(a, b))
    assert got == sorted(
        [(1, 10, 100, 5.0, 2), (1, 10, 100, 7.0, 2), (1, 11, 100, 5.0, 1), (1, 11, 100, 7.0, 1),
         (2, 10, 101, None, 1)],
        key=repr,
    )


def test_join_two_keys_hot_key_is_not_expanded(spark, a, b):
    hot_a = spark.createDataFrame([(7, k % 3, 70) for k in range(3000)], a.schema)
    hot_b = spark.createDataFrame([(7, 70, float(k % 4)) for k in range(3000)], b.schema)
    got = rows(join_two_keys(hot_a, hot_b))
    assert len(got) == 12  # 3 distinct a tuples x 4 distinct values, not 9,000,000 pairs
    assert sum(r[4] for r in got) == 3000 * 3000


def test_group_sum_nulls(b):
    got = rows(group_sum(b, ["org_id", "item_id"]))
    assert got == sorted(
        [(1, 100, 12.0), (2, 101, None), (2, 100, 3.0), (1, 101, 4.0), (None, 100, 9.0)], key=repr
    )


EXPECTED_IN_LIST = sorted(
    [(1, "oi001", 100, 12.0), (1, "oi001", 101, 4.0), (2, "oi001", 100, 3.0), (2, "oi001", 101, None)], key=repr
)


def test_in_list_group_sum(b):
    assert rows(in_list_group_sum(b, [100, 101], [1, 2])) == EXPECTED_IN_LIST


def test_in_list_group_sum_lists_are_independent(spark, b):
    # Pairs (100, 1) and (101, 2) still admit (100, 2) and (101, 1).
    keys = spark.createDataFrame([(100, 1), (101, 2)], "inv_item_id bigint, sch_org_id bigint")
    assert rows(in_keys_group_sum(b, keys)) == EXPECTED_IN_LIST
    assert rows(in_list_group_sum_from_keys(b, keys)) == EXPECTED_IN_LIST


def test_in_list_null_and_empty(b):
    assert rows(in_list_group_sum(b, [100, 101, None], [1, 2, None])) == EXPECTED_IN_LIST
    assert rows(in_list_group_sum(b, [], [1, 2])) == []
    assert rows(in_list_group_sum(b, [100], [])) == []
    assert rows(filter_in_lists(b, [], [])) == []


def test_in_keys_empty_and_null_keys(spark, b):
    schema = "inv_item_id bigint, sch_org_id bigint"
    assert rows(in_keys_group_sum(b, spark.createDataFrame([], schema))) == []
    keys = spark.createDataFrame([(100, None), (None, 1), (101, 2)], schema)
    assert rows(in_keys_group_sum(b, keys)) == EXPECTED_IN_LIST


@pytest.mark.parametrize("broadcast_max", [0, 1, 10])
def test_in_keys_plan_shapes_agree(spark, b, broadcast_max):
    # 0: both sets applied after the aggregation; 1: orgs/items mixed; 10: both broadcast.
    keys = spark.createDataFrame([(100, 1), (101, 2)], "inv_item_id bigint, sch_org_id bigint")
    assert rows(in_keys_group_sum(b, keys, broadcast_max_keys=broadcast_max)) == EXPECTED_IN_LIST


def test_long_lists_leave_the_plan(spark, b, monkeypatch):
    from rulegrid.operators import keyed_sums

    monkeypatch.setattr(keyed_sums, "LITERAL_MAX_KEYS", 1)
    assert rows(in_list_group_sum(b, [100, 101], [1, 2])) == EXPECTED_IN_LIST
    keys = spark.createDataFrame([(100, 1), (101, 2)], "inv_item_id bigint, sch_org_id bigint")
    assert rows(in_list_group_sum_from_keys(b, keys, literal_max_keys=1)) == EXPECTED_IN_LIST
    assert rows(filter_in_lists_from_keys(b, keys, literal_max_keys=1)) == rows(
        filter_in_lists(b, [100, 101], [1, 2])
    )


def test_in_list_filter_reaches_parquet_scan(spark, tmp_path, b):
    path = str(tmp_path / "b.parquet")
    b.write.parquet(path)
    plan = in_list_group_sum(spark.read.parquet(path), [100, 101], [1, 2])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "PushedFilters: [In(item_id" in text or "PushedFilters: [IsNotNull" in text
    assert "In(item_id" in text and "In(org_id" in text


def test_named_statements(spark, a, b):
    from pyspark.sql import Row

    from rulegrid.plans.statements import pluck, run_statement

    assert rows(run_statement("join_group_sum", table_a=a, table_b=b)) == rows(join_group_sum(a, b))
    elements = [{"inv_item_id": 100, "sch_org_id": 1}, Row(inv_item_id=101, sch_org_id=2)]
    assert pluck(elements, "sch_org_id") == [1, 2]
    assert rows(run_statement("in_list_group_sum", table_b=b, list=elements)) == EXPECTED_IN_LIST
    keys = spark.createDataFrame([(100, 1), (101, 2)], "inv_item_id bigint, sch_org_id bigint")
    assert rows(run_statement("in_list_group_sum", table_b=b, list=keys)) == EXPECTED_IN_LIST
    with pytest.raises(ValueError):
        run_statement("nope")


def test_in_list_string_keys_with_quotes(spark):
    b = spark.createDataFrame(
        [("o'1", "it\\em", 1.0), ("o'1", "it\\em", 2.0), ("o2", "x", 4.0)],
        "org_id string, item_id string, shuju double",
    )
    assert rows(in_list_group_sum(b, ["it\\em", "x"], ["o'1"])) == [("o'1", "oi001", "it\\em", 3.0)]


def test_join_group_sum_null_group_key(spark, b):
    # org_id is grouped on, not joined on: a null org_id forms its own group.
    a = spark.createDataFrame([(1, None, 100), (1, None, 100), (1, 10, 100)], "sch_org_id bigint, org_id int, inv_item_id bigint")
    assert rows(join_group_sum(a, b)) == sorted([(1, None, 100, 24.0), (1, 10, 100, 12.0)], key=repr)
    assert rows(join_group_sum(a, b)) == brute_join_group_sum([tuple(r) for r in a.collect()], B_ROWS)
