"""The two-key inner join as rows, with measured hot keys split over many tasks.

A sketch of frequent items (Misra-Gries counters, kept per task and merged) names the keys that may be hot on either
side; one exact count of those gives their rows and so their share of the join's output.  Only such keys are split: a hot
key's join is a grid of cells, each row of one side goes to one row of cells and is repeated along it, each row of the other
to one column.  All other rows are joined as they are.  The number of cells follows from the key's share of all work, so a
key of few rows on one side is split on the other side alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

CELLS = 16  # per shuffle partition, if all work fell on one key
MOST_KEYS = 10_000  # of a side that the sketch names; rarer ones are left to adaptive execution
_SIDES = ("a", "b")


def _keyed(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Rows with both keys and ``h``, a hash of the keys that is the same on both sides; None where the types don't allow one."""
    left = a.select("sch_org_id", "org_id", "inv_item_id", F.col("inv_item_id").alias("k1"), F.col("sch_org_id").alias("k2"))
    right = b.select(F.col("item_id").alias("k1"), F.col("org_id").alias("k2"), "shuju")
    for k in ("k1", "k2"):
        kinds = left.schema[k].dataType, right.schema[k].dataType
        if kinds[0] != kinds[1]:
            if not all(isinstance(t, NumericType) for t in kinds):
                return None
            common = left.select(k).limit(0).union(right.select(k).limit(0)).schema[0].dataType
            left, right = left.withColumn(k, F.col(k).cast(common)), right.withColumn(k, F.col(k).cast(common))
    return tuple(side.where("k1 is not null and k2 is not null").withColumn("h", F.xxhash64("k1", "k2")) for side in (left, right))


def hot_keys(left: DataFrame, right: DataFrame, partitions: int) -> list[tuple[int, int, int]]:
    """``(hash, rows of cells, columns of cells)`` of the keys to split: at most ``MOST_KEYS`` of each side."""
    both = left.select(F.lit("a").alias("side"), "h").union(right.select(F.lit("b").alias("side"), "h"))
    most = min(2 * partitions, MOST_KEYS)
    sketch = F.expr(f"approx_top_k(h, {most}, {max(10_000, 10 * most)})")
    found = {r["side"]: r for r in both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).collect()}
    sizes = {s: found[s]["n"] if s in found else 0 for s in _SIDES}
    named = sorted({x["item"] for s in found for x in found[s]["top"] if 2 * partitions * x["count"] >= sizes[s]})
    if not named or not all(sizes.values()):
        return []
    wanted = left.sparkSession.createDataFrame([(h,) for h in named], "h long")
    counts = dict.fromkeys(named, (0, 0))
    exact = both.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(*[F.count_if(F.col("side") == s).alias(s) for s in _SIDES])
    counts.update({r["h"]: (r["a"], r["b"]) for r in exact.collect()})
    total = sum(sizes.values()) + sum(x * y for x, y in counts.values())
    out = []
    for h, (x, y) in counts.items():
        cells = math.ceil((x + y + x * y) * CELLS * partitions / total)
        rows = min(x, cells, max(1, round(math.sqrt(cells * x / max(y, 1)))))
        columns = min(y, math.ceil(cells / max(rows, 1)))
        if rows * columns > 1:
            out.append((h, rows, columns))
    return out


def join_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(sch_org_id, org_id, inv_item_id, shuju)``: every joined row, as often as the SQL join gives it.

    Null keys match nothing.  Runs two small jobs on the key columns when called (the sketch, and the exact count of the keys it
    names).  A hot key costs each side its rows times the other side's cells, which is little beside the rows it joins to.
    """
    spark = a.sparkSession
    columns = ["sch_org_id", "org_id", "inv_item_id", "shuju"]
    sides = _keyed(a, b)
    if sides is None:  # keys that compare after a cast only
        right = b.select("item_id", F.col("org_id").alias("b_org_id"), "shuju")
        return a.select(*columns[:3]).join(right, (F.col("inv_item_id") == F.col("item_id")) & (F.col("sch_org_id") == F.col("b_org_id"))).select(*columns)
    left, right = sides
    hot = hot_keys(left, right, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not hot:
        return left.join(right, ["k1", "k2"]).select(*columns)
    grid = F.broadcast(spark.createDataFrame(hot, "h long, grid_rows int, grid_columns int"))

    def placed(side: DataFrame, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
        """A hot row gets one place along its own axis and all places along the other's; every other row gets place 0, 0."""
        known = side.join(grid, "h", "left")
        # The row number of a task's input spreads equal rows as well, and is the same when the task runs again.
        place = F.when(F.col(own).isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col(own))).otherwise(F.lit(0)).cast("int")
        along = F.when(F.col(other) > 1, F.sequence(F.lit(0), F.col(other) - 1)).otherwise(F.array(F.lit(0)))
        return known.withColumn(own_cell, place).withColumn(other_cell, F.explode(along)).drop("h", "grid_rows", "grid_columns")

    split_left = placed(left, "grid_rows", "grid_columns", "cell_row", "cell_column")
    split_right = placed(right, "grid_columns", "grid_rows", "cell_column", "cell_row")
    return split_left.join(split_right, ["k1", "k2", "cell_row", "cell_column"]).select(*columns)
