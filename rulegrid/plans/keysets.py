"""Key sets with a measured size, for choosing between plan shapes.

The IN-list statement filters ``table_b`` by two independent key sets (items
and orgs).  How to apply a key set depends on how big it is, and that is only
known after computing it, so the sets are computed once, written to the
cluster's checkpoint folder (lineage cut: a lost executor re-reads the files
instead of re-running the upstream joins), and measured.  Keys reach the
driver only in bounded reads (at most ``limit + 1`` per set), and are kept
there only when that read proved the whole set within the bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrid.session import checkpoint_dir

# A semi-join side of up to this many distinct keys and bytes is broadcast.
BROADCAST_MAX_KEYS = 200_000
BROADCAST_MAX_BYTES = 8 << 20

# Above this many values an IN list is no longer written into the plan.
LITERAL_MAX_KEYS = 10_000

_ITEM, _ORG = "i", "o"


@dataclass(frozen=True)
class KeySets:
    """Distinct non-null item keys and org keys, materialised and counted."""

    items: DataFrame  # one column: item_id
    orgs: DataFrame  # one column: org_id
    n_items: int
    n_orgs: int
    item_bytes: int = 0  # of the keys as text: a bound for numbers, the measure for strings
    org_bytes: int = 0


def _tagged_distinct(keys: DataFrame, item_col: str, org_col: str) -> DataFrame:
    """Distinct ``(kind, item_id, org_id)`` entries, checkpointed: one pass over ``keys``.

    A single distinct over ``(kind, key)`` yields both sets; its partial
    aggregation removes duplicates before the shuffle, so a key repeated in a
    third of all rows costs one row per map task, not a third of the data.
    """
    checkpoint_dir(keys.sparkSession)
    item_type = keys.schema[item_col].dataType
    org_type = keys.schema[org_col].dataType
    # Each input row yields an item entry and an org entry; the unused field of
    # each entry is a typed null so both sets keep their own key type.
    tagged = keys.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit(_ITEM).alias("kind"),
                    F.col(item_col).alias("item_id"),
                    F.lit(None).cast(org_type).alias("org_id"),
                ),
                F.struct(
                    F.lit(_ORG).alias("kind"),
                    F.lit(None).cast(item_type).alias("item_id"),
                    F.col(org_col).alias("org_id"),
                ),
            )
        ).alias("k")
    ).select("k.kind", "k.item_id", "k.org_id")
    present = F.col("item_id").isNotNull() | F.col("org_id").isNotNull()
    return tagged.where(present).distinct().checkpoint(eager=True)


def _counted(distinct: DataFrame) -> KeySets:
    size = F.octet_length(F.coalesce(F.col("item_id").cast("string"), F.col("org_id").cast("string")))
    found = distinct.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size")).collect()
    counts = {row["kind"]: (row["n"], row["size"] or 0) for row in found}
    (n_items, item_bytes), (n_orgs, org_bytes) = counts.get(_ITEM, (0, 0)), counts.get(_ORG, (0, 0))
    return KeySets(
        items=distinct.where(F.col("kind") == _ITEM).select("item_id"),
        orgs=distinct.where(F.col("kind") == _ORG).select("org_id"),
        n_items=n_items,
        n_orgs=n_orgs,
        item_bytes=item_bytes,
        org_bytes=org_bytes,
    )


def key_sets(keys: DataFrame, item_col: str, org_col: str) -> KeySets:
    """Split key pairs into two independent distinct key sets.

    Runs jobs when called: the sets are checkpointed and counted at once.
    """
    return _counted(_tagged_distinct(keys, item_col, org_col))


def key_lists_or_sets(
    keys: DataFrame, item_col: str, org_col: str, limit: int
) -> tuple[list, list] | KeySets:
    """The two key sets as driver lists when each has at most ``limit`` keys, else as :class:`KeySets`.

    Each set is read with ``limit(limit + 1).collect()`` from the checkpoint,
    which Spark runs as an incremental take (a few partitions at a time, stopping
    once enough rows arrived), so the driver never receives more than a small
    multiple of ``limit`` rows; that read alone proves whether the set fits.
    (A union of two limits would instead funnel up to ``limit`` rows from every
    partition into one task.)  Only when a set does not fit are the sets counted
    (for the broadcast decision) and left on the cluster.
    """
    distinct = _tagged_distinct(keys, item_col, org_col)
    items = [r["item_id"] for r in distinct.where(F.col("kind") == _ITEM).limit(limit + 1).collect()]
    if len(items) <= limit:
        orgs = [r["org_id"] for r in distinct.where(F.col("kind") == _ORG).limit(limit + 1).collect()]
        if len(orgs) <= limit:
            return items, orgs
    return _counted(distinct)

