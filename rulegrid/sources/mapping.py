"""Stand-ins for the statement tables and the evaluation contexts.

The statements read ``table_a (sch_org_id, org_id, inv_item_id)`` and
``table_b (org_id, item_id, shuju)``; rules read a record of named variables.
None of these exist in the driver's data, so they are derived from it here,
as SQL text with ``{table}`` placeholders.  Spark runs the text through
``spark.sql(text, table=DataFrame)``; the DuckDB oracle formats the same text
with its view names, so both engines read identical inputs.  The key list is
the exception: Spark builds it with the DataFrame API in a better join order
(see :func:`key_list`); it yields the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulegrid.sources.tables import read_table

TABLE_A_SQL = """
SELECT l_suppkey AS sch_org_id, c_nationkey AS org_id, l_partkey AS inv_item_id
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
"""

TABLE_B_SQL = """
SELECT l_suppkey AS org_id, l_partkey AS item_id, l_quantity AS shuju
FROM {lineitem}
"""

# The parameter list of the IN-list statement: (inv_item_id, sch_org_id) pairs.
KEY_LIST_SQL = """
SELECT DISTINCT l_partkey AS inv_item_id, l_suppkey AS sch_org_id
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
WHERE c_nationkey = 7 AND l_returnflag = 'R'
"""

# The same statement's list over every nation: all pairs of all lines.
ALL_KEYS_SQL = "SELECT DISTINCT inv_item_id, sch_org_id FROM ({table_a}) AS a"

# One record per event, carrying the variables the example rules read.  Each
# column is built so that some records make a rule fail (see README).
CONTEXTS_SQL = """
SELECT
  event_id,
  CASE WHEN event_type = 'error' THEN 'error:'
       ELSE event_type || ':' || CAST(user_id AS VARCHAR(20)) END AS text1,
  props AS text2,
  'u' || CAST(user_id AS VARCHAR(20)) || ':' || upper(event_type) || '|' || event_type AS text3,
  'y1.' || CAST(event_id * 37 AS VARCHAR(20)) || '|' || event_type AS text4,
  CASE WHEN event_type = 'view' THEN 'a: ' ELSE 'a:' END || CAST(user_id AS VARCHAR(20)) AS text5,
  'a:' || CAST(event_id * 400000 AS VARCHAR(20)) AS text6,
  event_id AS length,
  user_id % 7 AS a,
  user_id % 5 AS b,
  event_id % 4 - 1 AS c,
  event_id % 11 AS d,
  event_id % 13 AS e,
  CASE WHEN event_type = 'signup' THEN NULL ELSE user_id % 9 END AS f
FROM {events}
"""

# The variables of a record, one VARIANT each: d is a number, a text, a decimal or a truth value.  To be selected from records.
DYNAMIC_SQL = """
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN to_variant_object(named_struct('d', d, 'text1', text1, 'length', length, 'f', f))
  WHEN 1 THEN to_variant_object(named_struct('d', cast(d AS string), 'text1', text1, 'length', length, 'f', f))
  WHEN 2 THEN to_variant_object(named_struct('d', cast(d + 0.25BD AS decimal(10, 2)), 'text1', text1, 'length', length))
  ELSE to_variant_object(named_struct('d', d > 5, 'text1', d, 'length', length, 'f', f)) END AS record
FROM {contexts}
"""


def for_duckdb(template: str, **subqueries: str) -> str:
    """Fill a template for DuckDB: base tables by view name, derived ones as subqueries."""
    names = {t: t for t in ("lineitem", "orders", "customer", "events")}
    names.update({k: f"({v})" for k, v in subqueries.items()})
    return template.format(**names)


def table_a(spark: SparkSession, data_dir: str) -> DataFrame:
    return spark.sql(
        TABLE_A_SQL,
        lineitem=read_table(spark, data_dir, "lineitem"),
        orders=read_table(spark, data_dir, "orders"),
        customer=read_table(spark, data_dir, "customer"),
    )


def table_b(spark: SparkSession, data_dir: str) -> DataFrame:
    return spark.sql(TABLE_B_SQL, lineitem=read_table(spark, data_dir, "lineitem"))


def key_list(spark: SparkSession, data_dir: str, nation: int = 7) -> DataFrame:
    """The statement's ``list`` parameter: ``(inv_item_id, sch_org_id)`` pairs.

    The same pairs as ``KEY_LIST_SQL`` (up to duplicates, which an IN list
    ignores), joined most selective input first: the nation's customers, then
    their orders, then their returned lines.  Catalyst keeps the written join
    order (cost-based reordering is off by default and Parquet reads carry no
    statistics); ``table_a``'s order would shuffle all returned lines joined to
    all orders before the nation filter could apply.
    """
    customer = read_table(spark, data_dir, "customer").where(F.col("c_nationkey") == nation)
    orders = read_table(spark, data_dir, "orders")
    lineitem = read_table(spark, data_dir, "lineitem").where(F.col("l_returnflag") == "R")
    nation_orders = customer.join(orders, customer.c_custkey == orders.o_custkey).select("o_orderkey")
    lines = lineitem.join(nation_orders, lineitem.l_orderkey == nation_orders.o_orderkey)
    return lines.select(F.col("l_partkey").alias("inv_item_id"), F.col("l_suppkey").alias("sch_org_id"))


def contexts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Evaluation records: a projection of the events, with the events' own partitions."""
    return spark.sql(CONTEXTS_SQL, events=read_table(spark, data_dir, "events"))


def dynamic_contexts(spark: SparkSession, data_dir: str) -> DataFrame:
    """The evaluation records with their variables in one VARIANT column, ``record``, of types that differ by record."""
    return spark.sql(DYNAMIC_SQL, contexts=contexts(spark, data_dir))
