"""Rules over a stream give the batch results; failure counts accumulate across micro-batches."""

from conftest import SMALL_DIR
from rulegrid.operators import rules_failures, rules_wide
from rulegrid.plans.rulebook import EXAMPLE_RULES
from rulegrid.sources import contexts
from rulegrid.streaming import rule_failure_counts, start_rules_to_parquet


def _write_batches(spark, folder):
    ctx = contexts(spark, SMALL_DIR)
    # Two files, as if two drops had arrived.
    ctx.where("event_id % 2 = 0").coalesce(1).write.parquet(f"{folder}/part=0")
    ctx.where("event_id % 2 = 1").coalesce(1).write.parquet(f"{folder}/part=1")
    return ctx


def test_stream_matches_batch(spark, tmp_path):
    ctx = _write_batches(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(ctx.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in" / "*")
    )
    query = start_rules_to_parquet(
        stream, EXAMPLE_RULES, ["event_id"], str(tmp_path / "out"),
        name="rules_test", checkpoint_location=str(tmp_path / "ckpt"), available_now=True,
    )
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = rules_wide(ctx, EXAMPLE_RULES, keys=["event_id"])
    assert got.count() == expected.count() == 1000
    assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_running_failure_counts(spark, tmp_path):
    ctx = _write_batches(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(ctx.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in" / "*")
    )
    query = (
        rule_failure_counts(stream, EXAMPLE_RULES)
        .writeStream.format("memory").queryName("rule_failures_test").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "ckpt2"))
        .start()
    )
    try:
        query.processAllAvailable()
        got = {r.rule_id: (r.n, r.n_failed) for r in spark.table("rule_failures_test").collect()}
    finally:
        query.stop()
    expected = {r.rule_id: (r.n, r.n_failed) for r in rules_failures(ctx, EXAMPLE_RULES).collect()}
    assert got == expected


def test_restart_resumes_without_duplicates(spark, tmp_path):
    """A stopped query restarted on its checkpoint picks up only new files (exactly-once sink)."""
    ctx = contexts(spark, SMALL_DIR)
    src = tmp_path / "in"
    ctx.where("event_id < 400").coalesce(1).write.parquet(str(src / "drop=0"))
    common = dict(name="rules_restart", checkpoint_location=str(tmp_path / "ckpt"), available_now=True)

    def run():
        stream = spark.readStream.schema(ctx.schema).parquet(str(src / "*"))
        start_rules_to_parquet(stream, EXAMPLE_RULES, ["event_id"], str(tmp_path / "out"), **common).awaitTermination(120)

    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400
    ctx.where("event_id >= 400").coalesce(1).write.parquet(str(src / "drop=1"))
    run()  # same checkpoint: as if the first query had died after its last batch
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 1000
    assert out.select("event_id").distinct().count() == 1000
