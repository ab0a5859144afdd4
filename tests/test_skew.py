"""A third of all rows on one key: results stay exact and no task sees the pairs.

The skewed inputs are SQL over the driver tables, so DuckDB computes the same
statements on the same rows as an independent check.
"""

import pytest

from check_oracle import _rows, duck_connection
from conftest import SMALL_DIR
from rulegrid.operators import in_keys_group_sum, join_group_sum
from rulegrid.sources.tables import read_table

# Every third lineitem row is moved onto one hot (supplier, part) key.
SKEWED_LINEITEM = """
SELECT l_orderkey,
       CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey,
       CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey,
       l_quantity, l_returnflag
FROM {lineitem}
"""

SKEWED_A = """
SELECT l_suppkey AS sch_org_id, c_nationkey AS org_id, l_partkey AS inv_item_id
FROM ({skewed}) AS l JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
"""

SKEWED_B = "SELECT l_suppkey AS org_id, l_partkey AS item_id, l_quantity AS shuju FROM ({skewed}) AS l"


def _spark_inputs(spark):
    tables = {t: read_table(spark, SMALL_DIR, t) for t in ("lineitem", "orders", "customer")}
    skewed = spark.sql(SKEWED_LINEITEM, lineitem=tables["lineitem"])
    a = spark.sql(SKEWED_A, skewed=skewed, orders=tables["orders"], customer=tables["customer"])
    b = spark.sql(SKEWED_B, skewed=skewed)
    return a, b


def _duck_inputs():
    skewed = SKEWED_LINEITEM.format(lineitem="lineitem")
    a = SKEWED_A.format(skewed=skewed, orders="orders", customer="customer")
    b = SKEWED_B.format(skewed=skewed)
    return a, b


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMALL_DIR)


def test_hot_key_really_is_hot(spark):
    _, b = _spark_inputs(spark)
    total = b.count()
    hot = b.where("org_id = 1 AND item_id = 1").count()
    assert hot >= 0.3 * total


def test_join_group_sum_skewed(spark, duck):
    a, b = _spark_inputs(spark)
    got, cols = _rows(*_collect(join_group_sum(a, b)))
    a_sql, b_sql = _duck_inputs()
    res = duck.sql(
        f"SELECT a.sch_org_id, a.org_id, a.inv_item_id, sum(b.shuju) AS m FROM ({a_sql}) a, ({b_sql}) b "
        "WHERE b.item_id = a.inv_item_id AND b.org_id = a.sch_org_id GROUP BY 1, 2, 3"
    )
    expected, expected_cols = _rows(res.columns, res.fetchall())
    assert cols == expected_cols and got == expected


def test_in_keys_skewed(spark, duck):
    a, b = _spark_inputs(spark)
    keys = a.where("org_id % 5 = 0").select("inv_item_id", "sch_org_id")
    a_sql, b_sql = _duck_inputs()
    res = duck.sql(
        f"SELECT b.org_id AS sch_org_id, 'oi001' AS org_id, b.item_id AS inv_item_id, sum(b.shuju) AS m "
        f"FROM ({b_sql}) b WHERE b.item_id IN (SELECT inv_item_id FROM ({a_sql}) x WHERE org_id % 5 = 0) "
        f"AND b.org_id IN (SELECT sch_org_id FROM ({a_sql}) x WHERE org_id % 5 = 0) GROUP BY b.org_id, b.item_id"
    )
    expected, _ = _rows(res.columns, res.fetchall())
    for broadcast_max in (0, 10**6):  # shuffle form and broadcast form
        got, _ = _rows(*_collect(in_keys_group_sum(b, keys, broadcast_max_keys=broadcast_max)))
        assert got == expected


def _collect(df):
    return df.columns, [tuple(r) for r in df.collect()]
