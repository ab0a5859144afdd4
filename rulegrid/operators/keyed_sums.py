"""Grouped sums over a two-key join and over key-list filters.

Data model (column names as in the statements):

* ``table_a (sch_org_id, org_id, inv_item_id)``
* ``table_b (org_id, item_id, shuju)``; ``shuju`` is numeric and summed.
* result ``(sch_org_id, org_id, inv_item_id, m)`` for both statements.

Plans are written for data far larger than memory, where any one key may
carry a third of all rows:

* Every sum is aggregated map-side (partial aggregation) before its shuffle,
  so a hot key costs one row per map task, not a third of the data.
* :func:`join_group_sum` never makes join pairs: its grouping key contains both
  join keys, so all ``table_a`` rows of a group meet the same ``table_b`` rows and
  ``m = (rows of the group in a) * (sum of b for the key)``: ``table_b`` is summed
  first and the join matches one row per key.  :func:`join_two_keys` returns the
  join as a bag (distinct row + pair count) from both sides reduced to distinct
  tuples with counts; a key still makes (distinct ``a`` tuples) x (distinct
  values) rows, which is the size of its distinct result.
* Key sets are applied before the shuffle when their measured size allows a
  broadcast, and to the already-summed ``table_b`` (one row per key) when not.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
)

from rulegrid.operators.bloom import bloom_prefilter
from rulegrid.plans.keysets import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_KEYS,
    LITERAL_MAX_KEYS,
    KeySets,
    key_lists_or_sets,
    key_sets,
)

RESULT_COLUMNS = ("sch_org_id", "org_id", "inv_item_id", "m")

# Fixed value: the constant org_id of the IN-list statement.
DEFAULT_ORG_CONSTANT = "oi001"

def join_two_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner equi-join ``b.item_id = a.inv_item_id and b.org_id = a.sch_org_id``, as a bag.

    ``(sch_org_id, org_id, inv_item_id, shuju, n_pairs)``: each distinct joined
    row once, with the number of times the SQL join produces it.  The bag is
    the join's result without loss (null keys never match; ``a.org_id`` is
    carried, not joined on), but it is built without materialising the pairs:
    both sides are first reduced to distinct tuples with their counts (partial
    aggregation map-side), so a key holding a third of each side costs
    (distinct ``a`` tuples x distinct ``b`` values) rows, not ``|a_key| x |b_key|``.
    The join of the reduced sides has no aggregate above it, so AQE can still
    split a skewed key's partition.
    """
    a_counts = a.groupBy("sch_org_id", "org_id", "inv_item_id").agg(F.count(F.lit(1)).alias("_n_a"))
    b_counts = b.groupBy(
        F.col("org_id").alias("_b_org"), F.col("item_id").alias("_b_item"), "shuju"
    ).agg(F.count(F.lit(1)).alias("_n_b"))
    on = (a_counts.inv_item_id == b_counts._b_item) & (a_counts.sch_org_id == b_counts._b_org)
    return a_counts.join(b_counts, on, "inner").select(
        "sch_org_id", "org_id", "inv_item_id", "shuju", (F.col("_n_a") * F.col("_n_b")).alias("n_pairs")
    )


def group_sum(df: DataFrame, keys: Sequence[str], value: str = "shuju", alias: str = "m") -> DataFrame:
    """``sum(value)`` per group: nulls skipped, null for an all-null group, null keys form a group."""
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def _sum_type(b: DataFrame, value: str):
    """Type Spark gives ``sum(value)``: BIGINT for integers, DOUBLE for floats,
    DECIMAL(p + 10, s) for decimals; anything else is asked of the analyser."""
    dtype = b.schema[value].dataType
    if isinstance(dtype, DecimalType):
        return DecimalType(min(38, dtype.precision + 10), dtype.scale)
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return LongType()
    if isinstance(dtype, (FloatType, DoubleType)):
        return DoubleType()
    return b.select(F.sum(value)).schema[0].dataType


def join_group_sum(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join ``a`` and ``b`` on both keys, then ``sum(b.shuju)`` per ``(sch_org_id, org_id, inv_item_id)``.

    Duplicate ``a`` rows multiply ``m`` (fan-out), exactly as the joined sum
    does; ``a`` is never de-duplicated.  ``m`` is null when every matching
    ``shuju`` is null; a group without a matching ``b`` row is absent.

    Decimals are never multiplied (a product of full width would lose places):
    the key's sum is joined to the ``a`` rows and added up per group.  Integers
    are summed as decimals, so only a joined group can overflow, not a key that
    joins nothing.  Both sides are shuffled for the join alone (``_salt`` is no
    aggregate's key), so AQE splits a key with very many ``org_id``s.
    """
    group_keys = ["sch_org_id", "org_id", "inv_item_id"]
    result = _sum_type(b, "shuju")
    value = F.col("shuju")
    if isinstance(result, LongType):
        value = value.cast(DecimalType(20, 0))
    elif isinstance(result, DecimalType):
        value = value.cast(DecimalType(38, result.scale))
    added = F.try_sum(value) if isinstance(result, DecimalType) else F.sum(value)
    b_sums = b.groupBy(F.col("org_id").alias("_b_org"), F.col("item_id").alias("_b_item")).agg(
        added.alias("_sum"), F.count("shuju").alias("_present")
    )
    b_sums = b_sums.withColumn("_b_salt", F.pmod(F.xxhash64("_present"), F.lit(1)))
    decimals = isinstance(result, DecimalType)
    left = a.select(*group_keys) if decimals else a.groupBy(*group_keys).agg(F.count(F.lit(1)).alias("_rows"))
    left = left.withColumn("_salt", F.pmod(F.xxhash64("org_id"), F.lit(1)))
    on = (
        (left.inv_item_id == b_sums._b_item) & (left.sch_org_id == b_sums._b_org) & (left._salt == b_sums._b_salt)
    )
    joined = left.join(b_sums, on, "inner")
    if not decimals:
        return joined.select(*group_keys, (F.col("_rows") * F.col("_sum")).cast(result).alias("m"))
    too_large = F.col("_sum").isNull() & (F.col("_present") > 0)
    total = F.when(too_large, F.raise_error(F.lit("the sum of a joined key exceeds 38 digits"))).otherwise(F.col("_sum"))
    summed = joined.withColumn("_sum", total).groupBy(*group_keys).agg(F.sum("_sum").alias("m"))
    return summed.select(*group_keys, F.col("m").cast(result).alias("m"))


def _result(summed: DataFrame, org_constant: str) -> DataFrame:
    return summed.select(
        F.col("org_id").alias("sch_org_id"),
        F.lit(org_constant).alias("org_id"),
        F.col("item_id").alias("inv_item_id"),
        "m",
    )


def _in_values(column: str, values: list) -> Column:
    """``column IN (values)`` built in one call.

    ``Column.isin`` makes one Py4J round trip per value (seconds for 10,000
    keys); integer and string lists are instead handed over as one SQL text
    that the JVM parses.  Nulls are left out: in a filter, a null list entry
    matches nothing either way.
    """
    present = [v for v in values if v is not None]
    if present and all(isinstance(v, int) and not isinstance(v, bool) for v in present):
        return F.expr(f"`{column}` IN ({', '.join(str(v) for v in present)})")
    if present and all(isinstance(v, str) for v in present):
        quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in present)
        return F.expr(f"`{column}` IN ({', '.join(quoted)})")
    return F.col(column).isin(present)


def filter_in_lists(b: DataFrame, items: Iterable, orgs: Iterable) -> DataFrame:
    """``b.item_id in (items) and b.org_id in (orgs)``; the lists are independent.

    Every item x org combination passes, not only pairs that came from the same
    list element.  A null in a list matches nothing; an empty list matches
    nothing.  The predicate reaches the Parquet reader (``PushedFilters: In``).
    """
    item_list = list(dict.fromkeys(items))
    org_list = list(dict.fromkeys(orgs))
    return b.where(_in_values("item_id", item_list) & _in_values("org_id", org_list))


def _each_set(sets: KeySets, broadcast_max_keys: int):
    """``(keys, column, n, small)``, the sets small enough to broadcast (by keys and bytes) first."""
    every = (
        (sets.items, "item_id", sets.n_items, sets.item_bytes),
        (sets.orgs, "org_id", sets.n_orgs, sets.org_bytes),
    )
    judged = [(k, c, n, n <= broadcast_max_keys and size <= BROADCAST_MAX_BYTES) for k, c, n, size in every]
    return sorted(judged, key=lambda x: not x[3])


def _semi_join(rows: DataFrame, keys: DataFrame, column: str, small: bool = False) -> DataFrame:
    """Rows whose ``column`` equals a key; the key's own type decides with the column's, as in an IN list."""
    keys = keys.toDF("_key")
    return rows.join(F.broadcast(keys) if small else keys, rows[column] == keys["_key"], "left_semi")


def _semi_join_sets(rows: DataFrame, sets: KeySets, broadcast_max_keys: int) -> DataFrame:
    judged = _each_set(sets, broadcast_max_keys)
    for keys, column, n, small in judged:
        rows = _semi_join(rows, keys, column, True) if small else bloom_prefilter(rows, keys, column, n)
    for keys, column, _, small in judged:
        if not small:
            rows = _semi_join(rows, keys, column)
    return rows


def filter_in_lists_from_keys(
    b: DataFrame,
    keys: DataFrame,
    item_col: str = "inv_item_id",
    org_col: str = "sch_org_id",
    literal_max_keys: int = LITERAL_MAX_KEYS,
    broadcast_max_keys: int = BROADCAST_MAX_KEYS,
) -> DataFrame:
    """:func:`filter_in_lists` with the lists computed by Spark from key pairs.

    Lists within ``literal_max_keys`` (measured) become IN literals pushed into
    the scan; larger ones are applied as semi-joins, broadcast when within
    ``broadcast_max_keys`` and shuffled otherwise; then a Bloom filter of each drops
    most unwanted rows where ``b`` is scanned.
    """
    found = key_lists_or_sets(keys, item_col, org_col, literal_max_keys)
    if isinstance(found, KeySets):
        return _semi_join_sets(b, found, broadcast_max_keys)
    return filter_in_lists(b, *found)


def _key_frame(b: DataFrame, column: str, values: list) -> DataFrame:
    """A list as a DataFrame of the list's own type, so that long lists coerce like short ones."""
    spark = b.sparkSession
    if not values:
        return b.select(column).limit(0)
    if any(isinstance(v, float) for v in values) and all(isinstance(v, (int, float)) for v in values):
        values = [float(v) for v in values]
    return spark.createDataFrame([(v,) for v in values], ["_key"])


def in_list_group_sum(
    b: DataFrame, items: Iterable, orgs: Iterable, org_constant: str = DEFAULT_ORG_CONSTANT
) -> DataFrame:
    """IN-list statement: filter ``b`` by two key lists, then sum per ``(org_id, item_id)``.

    Output ``(sch_org_id = b.org_id, org_id = org_constant, inv_item_id = b.item_id, m)``.
    Lists longer than ``LITERAL_MAX_KEYS`` are not written into the plan; they
    go through :func:`in_keys_group_sum` as a DataFrame instead.
    """
    item_list = [k for k in dict.fromkeys(items) if k is not None]
    org_list = [k for k in dict.fromkeys(orgs) if k is not None]
    if max(len(item_list), len(org_list)) > LITERAL_MAX_KEYS:
        sets = KeySets(
            items=_key_frame(b, "item_id", item_list),
            orgs=_key_frame(b, "org_id", org_list),
            n_items=len(item_list),
            n_orgs=len(org_list),
            item_bytes=sum(len(str(k)) for k in item_list),
            org_bytes=sum(len(str(k)) for k in org_list),
        )
        return _sum_by_key_sets(b, sets, org_constant, BROADCAST_MAX_KEYS)
    filtered = filter_in_lists(b, item_list, org_list)
    return _result(group_sum(filtered, ["org_id", "item_id"]), org_constant)


def _sum_by_key_sets(b: DataFrame, sets: KeySets, org_constant: str, broadcast_max_keys: int) -> DataFrame:
    """Apply both key sets to ``b`` and sum per ``(org_id, item_id)``.

    A set whose measured size is within ``broadcast_max_keys`` is broadcast and
    applied to raw ``b`` rows before the aggregation shuffle (a map-side
    filter).  A larger set is applied after the aggregation, to one row per
    key: filtering on the grouping keys commutes with summing per those keys,
    and the aggregated side is skew-free.  Before that, a Bloom filter drops
    most unwanted rows without a shuffle.  AQE chooses that join's strategy
    from measured sizes.
    """
    rows = b
    for keys, column, n, small in _each_set(sets, broadcast_max_keys):
        rows = _semi_join(rows, keys, column, True) if small else bloom_prefilter(rows, keys, column, n)
    summed = group_sum(rows, ["org_id", "item_id"])
    for keys, column, _, small in _each_set(sets, broadcast_max_keys):
        if not small:
            summed = _semi_join(summed, keys, column)
    return _result(summed, org_constant)


def in_keys_group_sum(
    b: DataFrame,
    keys: DataFrame,
    item_col: str = "inv_item_id",
    org_col: str = "sch_org_id",
    org_constant: str = DEFAULT_ORG_CONSTANT,
    broadcast_max_keys: int = BROADCAST_MAX_KEYS,
) -> DataFrame:
    """IN-list statement with the list given as a DataFrame of key pairs.

    Same result as :func:`in_list_group_sum` on the pairs' columns, for key
    lists of any size.  The two key sets are computed once, checkpointed and
    counted (see :mod:`rulegrid.plans.keysets`), then applied by size.
    """
    return _sum_by_key_sets(b, key_sets(keys, item_col, org_col), org_constant, broadcast_max_keys)


def in_list_group_sum_from_keys(
    b: DataFrame,
    keys: DataFrame,
    item_col: str = "inv_item_id",
    org_col: str = "sch_org_id",
    org_constant: str = DEFAULT_ORG_CONSTANT,
    literal_max_keys: int = LITERAL_MAX_KEYS,
) -> DataFrame:
    """IN-list statement where the caller's list is itself computed by Spark.

    The lists are written into the plan as literals (pushed into the Parquet
    scan) only after their measured size proved them within
    ``literal_max_keys``; larger lists take the DataFrame form.
    """
    found = key_lists_or_sets(keys, item_col, org_col, literal_max_keys)
    if isinstance(found, KeySets):
        return _sum_by_key_sets(b, found, org_constant, BROADCAST_MAX_KEYS)
    return in_list_group_sum(b, *found, org_constant)
