"""The registered queries of this package: each applies one operator to its whole table and derives the result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulegrid.llm import align, chat, decontaminate, jaccard, licenses, lm, neighbours, packing, quality, repair, secrets, simhash, warc
from rulegrid.llm.shared import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """The vocabulary file of the packing tokeniser."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_nnls_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_text_classes(table(spark, folder, "documents"), k=3, threshold=90)


def op4_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("_repository", F.concat_ws("/", "source", "lang"))
    found = secrets.scan(docs, repository="_repository", owner="source", columns=["doc_id"])
    spans = F.col("_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE))
    counts = [F.expr(f"cast(size(filter(_spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(spans).alias("spans"),
        "n_example", "n_live", "most_owners",
    )


def op5_license_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


def op6_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    windows = chat.format_conversations(turns.unionByName(extra.select(*[F.col(c).cast(turns.schema[c].dataType).alias(c) for c in turns.columns])))
    sizes = windows.groupBy("conv_id").agg(F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"))
    turn = F.struct("place", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), F.when(F.col("loss"), F.col("text")).alias("loss"))
    back = chat.read_back(windows).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    loss = F.array_join("t.loss", "")
    back = back.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.array_join("t.turn", ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
    )
    return chat.null_safe_join(back, sizes, "conv_id")


def op7_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), every=100, k=10)


def op8_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derivatives(table(spark, folder, "pages"))


def op9_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_texts(table(spark, folder, "documents"))


def op10_quality_network(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", (quality.bucket(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= quality.KEEP).cast("int").alias("predicted")
    )


def op11_glr_repair(spark: SparkSession, folder: str) -> DataFrame:
    plans, repaired = repair.repair(repair.damaged(table(spark, folder, "conversations")), n="copies")
    whole = chat.null_safe_join(plans, repair.digests(repaired), "conv_id", how="left")
    return whole.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))


def op12_fragment_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, folder, "documents"), *files, digest=True).withColumnRenamed("groups", "groups_sha256")


def op13_vantage_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_classes(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nnls_packing": op1_nnls_packing,
    "op2_simhash_decontamination": op2_simhash_decontamination,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_secret_ownership": op4_secret_ownership,
    "op5_license_blocks": op5_license_blocks,
    "op6_chat_windows": op6_chat_windows,
    "op7_adaptive_scan": op7_adaptive_scan,
    "op8_warc_derivatives": op8_warc_derivatives,
    "op9_deleted_interpolation": op9_deleted_interpolation,
    "op10_quality_network": op10_quality_network,
    "op11_glr_repair": op11_glr_repair,
    "op12_fragment_alignment": op12_fragment_alignment,
    "op13_vantage_simhash": op13_vantage_simhash,
}

ORACLE_SQL: dict[str, str] = {"op8_warc_derivatives": warc.duckdb_sql()}
