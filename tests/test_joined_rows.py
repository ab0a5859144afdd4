"""Joined rows with hot keys split, and Bloom filters of large key sets."""

import collections
import re
import statistics

import pytest
from pyspark.sql import functions as F

from rulegrid.operators import bloom, join_rows, joined_rows, keyed_sums
from rulegrid.plans.keysets import key_sets

A = "sch_org_id bigint, org_id int, inv_item_id bigint"
B = "org_id bigint, item_id bigint, shuju double"


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def plain(a, b):
    return collections.Counter((x[0], x[1], x[2], y[2]) for x in a for y in b if None not in (x[0], x[2]) and (x[2], x[0]) == (y[1], y[0]))


@pytest.mark.parametrize("hot", [(0, 0), (60, 60), (200, 1), (1, 200), (150, 0)])
def test_rows_are_those_of_the_join(spark, hot):
    a = [(i % 7, i % 3, i % 5) for i in range(80)] + [(1, 9, 1)] * hot[0] + [(None, 1, 1), (1, 1, None)]
    b = [(i % 6, i % 4, float(i)) for i in range(70)] + [(1, 1, 0.5)] * hot[1] + [(None, 1, 1.0), (1, 1, None)]
    left = spark.createDataFrame([(*r, 1, "x") for r in a], A + ", h int, grid_rows string").repartition(3)
    right = spark.createDataFrame([(*r, 1, 2) for r in b], B + ", k1 int, cell_row int").repartition(3)
    assert bag(join_rows(left, right).collect()) == plain(a, b)
    assert join_rows(left.where("false"), right).count() == join_rows(left, right.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["int", "decimal(20,2)", "double", "string"])
def test_keys_of_other_types_still_meet(spark, kind):
    a = spark.createDataFrame([(1, 1, 1)] * 50 + [(2, 1, 3)], A)
    b = spark.createDataFrame([(1, 1, 2.0)] * 50 + [(2, 3, 1.0)], B).withColumns({"org_id": F.col("org_id").cast(kind), "item_id": F.col("item_id").cast(kind)})
    assert bag(join_rows(a, b).collect()) == {(1, 1, 1, 2.0): 2500, (2, 1, 3, 1.0): 1}


def test_only_hot_keys_are_split_and_none_is_a_task_of_its_own(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        a = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) as sch_org_id", "1 as org_id", "if(id % 3 = 0, 1, id) as inv_item_id").repartition(5)
        b = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) as org_id", "if(id % 3 = 0, 1, id) as item_id", "1.0D as shuju").repartition(5)
        hot = joined_rows.hot_keys(*joined_rows._keyed(a, b), 8)
        assert len(hot) == 1 and hot[0][1] > 4 and hot[0][2] > 4
        out = join_rows(a, b)
        loads = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(loads) == 8 and sum(loads) == 1001 * 1001 + 1999 and max(loads) <= 2 * statistics.median(loads)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_million_keys_drop_rows_before_the_first_exchange(spark, tmp_path):
    n = 2_000_000
    spark.range(n).selectExpr("id * 5 as inv_item_id", "id % 1000 as sch_org_id").write.parquet(str(tmp_path / "keys"))
    spark.range(400_000).selectExpr("id % 1500 as org_id", "id * 25 + (id % 5) as item_id", "1.0D as shuju").write.parquet(str(tmp_path / "b"))
    b, keys = spark.read.parquet(str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "keys"))
    sets = key_sets(keys, "inv_item_id", "sch_org_id")
    passed = bloom.bloom_prefilter(b, sets.items, "item_id", sets.n_items)
    wanted = b.where("item_id % 5 = 0").count()
    assert wanted == 80_000 and wanted <= passed.count() <= wanted + 0.03 * 320_000
    for out in (keyed_sums.filter_in_lists_from_keys(b, keys, literal_max_keys=0, broadcast_max_keys=0), keyed_sums.in_keys_group_sum(b, keys, broadcast_max_keys=0)):
        text = plan_of(out)
        first = re.split(r"Exchange", text)[-1]
        assert text.count("might_contain") >= 2 and not re.search(r"\bIN \(|In\(|InSet|BroadcastExchange", text), text
        assert "Exchange" in text and first
    assert keyed_sums.filter_in_lists_from_keys(b, keys, literal_max_keys=0, broadcast_max_keys=0).count() == b.where("item_id % 5 = 0 and org_id < 1000").count()


def test_filters_of_odd_sets(spark):
    b = spark.createDataFrame([(1, 100, 5.0), (2, None, 1.0), (None, 100, 2.0)], B)
    none = spark.createDataFrame([], "inv_item_id bigint, sch_org_id bigint")
    nulls = spark.createDataFrame([(None, 1), (100, None)], "inv_item_id bigint, sch_org_id bigint")
    for keys, rows in ((none, []), (nulls, [(1, 100, 5.0)])):
        assert [tuple(r) for r in keyed_sums.filter_in_lists_from_keys(b, keys, literal_max_keys=0, broadcast_max_keys=0).collect()] == rows
    wide = spark.range(3).select(F.col("id").cast("decimal(20,0)").alias("k"))
    assert bloom.bloom_prefilter(b, wide, "item_id", 3) is b  # other type: no filter, the exact join decides
    assert bloom.bloom_prefilter(b, none.select("inv_item_id"), "item_id", bloom.MAX_BITS) is b
