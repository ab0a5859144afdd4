"""Rules over a stream of records, with Structured Streaming.

Evaluating rules is a per-record projection, so on a streaming DataFrame it
is the same plan as in batch: no state, no watermark, every micro-batch one
narrow stage.  The one stateful piece is the running failure count per rule,
whose state is one row, whatever the stream's volume.

Progress lives in ``checkpoint_location``, or else under the configured
``spark.checkpoint.dir`` and the query's name: a place that is the same after a
restart, so the query resumes where it stopped and the file sink stays exactly-once.
Without either, starting a query is an error: a place of one application's own
would start at batch 0 again, and the sink would skip the batches it already has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from rulegrid.operators.rules import rules_failures, rules_wide
from rulegrid.session import configured_checkpoint_dir


def rules_stream(
    records: DataFrame,
    rules: Mapping[str, str],
    keys: Sequence[str],
    fallback_types: Mapping[str, DataType] | None = None,
) -> DataFrame:
    """Streaming ``rules_wide``: ``keys`` + one typed column per rule."""
    return rules_wide(records, rules, keys, fallback_types)


def rule_failure_counts(records: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Running ``(rule_id, n, n_failed)`` over everything the stream has delivered.

    One aggregate over the projection counts all rules at once; the state store
    holds a single row, which is unpivoted to one row per rule.  Use output mode
    ``update`` or ``complete``.
    """
    return rules_failures(records, rules).select("rule_id", "n", "n_failed")


def _location(records: DataFrame, name: str, given: str | None) -> str:
    if given:
        return given
    base = configured_checkpoint_dir(records.sparkSession)
    if not base:
        raise ValueError("give checkpoint_location, or set spark.checkpoint.dir to a folder that outlives the application")
    return f"{base.rstrip('/')}/streams/{name}"


def start_rules_to_parquet(
    records: DataFrame,
    rules: Mapping[str, str],
    keys: Sequence[str],
    path: str,
    name: str = "rules",
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    fallback_types: Mapping[str, DataType] | None = None,
) -> StreamingQuery:
    """Evaluate ``rules`` on every arriving record and append the results to Parquet.

    ``available_now`` processes what is there and stops (batch-style catch-up);
    otherwise micro-batches run every ``processing_time`` (default: as fast as
    data arrives).
    """
    writer = (
        rules_stream(records, rules, keys, fallback_types)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", _location(records, name, checkpoint_location))
        .outputMode("append")
        .queryName(name)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
