"""A Bloom filter over a key set, built by one aggregate and applied where a table is scanned.

The filter is Spark's own: bits set per task and merged, then a scalar subquery that the scan's stage tests every row
against.  No key becomes a literal and no key set is broadcast; the filter is at most ``MAX_BITS`` whatever the number of keys.
A filter passes some rows whose key is not in the set, so an exact semi-join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10  # 1 % of the other keys pass
MAX_BITS = 1 << 26  # 8 MB
USELESS = 2  # bits a key; with fewer most other keys pass


def bloom_filter(keys: DataFrame, n: int) -> DataFrame:
    """One row with the filter (binary) of the ``n`` distinct values in the only column of ``keys``."""
    jvm = keys.sparkSession._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    bits = max(64, min(MAX_BITS, BITS_PER_KEY * n))
    parts = [utils.expression(c._jc) for c in (F.xxhash64(keys.columns[0]), F.lit(max(1, n)).cast("long"), F.lit(bits).cast("long"))]
    aggregate = jvm.org.apache.spark.sql.catalyst.expressions.aggregate.BloomFilterAggregate(*parts)
    return keys.agg(Column(utils.column(aggregate.toAggregateExpression())).alias("filter"))


def might_hold(found: DataFrame, column: str) -> Column:
    """Whether the filter ``found`` may hold the value of ``column``; null for a filter of no keys."""
    jvm = found.sparkSession._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    subquery, value = (utils.expression(c._jc) for c in (found.scalar(), F.xxhash64(column)))
    return Column(utils.column(jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain(subquery, value)))


def bloom_prefilter(rows: DataFrame, keys: DataFrame, column: str, n: int) -> DataFrame:
    """``rows`` without most of those whose ``column`` is none of the ``n`` distinct ``keys``, before any shuffle."""
    if n == 0 or MAX_BITS < USELESS * n or rows.schema[column].dataType != keys.schema[0].dataType:
        return rows
    return rows.where(might_hold(bloom_filter(keys, n), column))
