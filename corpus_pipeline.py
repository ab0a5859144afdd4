"""A corpus pipeline of five operators: each stage works on all rows that the one before it kept.

1. quality classifier: rows that it scores below its threshold go;
2. n-gram Jaccard join: of each group of linked texts (Jaccard similarity of their 5-word shingles at least 0.8) the row of the
   smallest doc_id stays;
3. benchmark decontamination: rows with a passage of a benchmark item go;
4. secret scans: rows stay, owner-specific live-looking secrets are masked in their texts;
5. packing: the texts become sequences of tokens.

Odd input: stages 2 to 4 decide by doc_id and text together, so rows of one doc_id with different texts are judged one by one (linked
ones are one group, whose shortest text stays) and a null doc_id is judged like any other and comes last in its group; a null text counts
as empty (rows with one are scored, never linked, never leaking); of rows equal in doc_id and text (nulls being equal) one
stays in stage 2; further columns are carried along; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulegrid.llm import decontaminate, jaccard, packing, quality, secrets
from rulegrid.llm.queries import table, vocabulary
from rulegrid.llm.shared import delete_tables, free_name, small_batches, stored, tables_written
from rulegrid.operators.bloom import bloom_filter, might_hold

SHINGLE, NEAR = 5, 80  # the query op3 has a contract of its own: 3 words, 90 %


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return quality.score_quality(docs, model, score).where(F.col(score) >= quality.KEEP).drop(score)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a 64-bit identity of doc_id and text (nulls included), by which stages 2 to 4 decide, and that column's name."""
    key = free_name(docs, "_key")
    parts = [x for c, none in (("doc_id", F.lit(0)), ("text", F.lit(""))) for x in (F.coalesce(c, none), F.col(c).isNull())]
    return docs.withColumn(key, F.xxhash64(*parts)), key


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows, key = keyed(docs)
    goes = free_name(docs, "_goes")
    # What the operator reads: the key stands for the doc_id.
    classes = jaccard.similar_text_classes(rows.select(F.col(key).alias("doc_id"), "text"), k=SHINGLE, threshold=NEAR).withColumnRenamed("doc_id", key)
    classes = stored(classes.groupBy(key).agg(F.min("component_id").alias("component_id"), F.max("n_links").alias("links"), F.count(F.lit(1)).alias("n")), "pipeline-classes")
    linked = classes.where("links > 0").select(key, "component_id")
    # A null doc_id comes last; texts of one doc_id by length.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.length("text").alias("length"), F.col(key).alias("key"))
    first = rows.select(key, order.alias("o")).join(linked, key).groupBy("component_id").agg(F.min("o").alias("o"))
    # Few rows go: those whose class has a row before them, and equal rows after the first.
    later = linked.join(first.select(F.col("o.key").alias(key)), key, "left_anti").select(key, F.lit(True).alias(goes))
    again = classes.where("n > 1").select(key, F.lit(False).alias(goes))
    judged = stored(later.union(again).groupBy(key).agg(F.max(goes).alias(goes)), "pipeline-judged")
    met, others = met_and_others(rows, judged.select(key), key)
    kept = met.join(judged, key, "left").where(~F.coalesce(goes, F.lit(False)))
    once = kept.where(F.col(goes).isNotNull()).dropDuplicates([key])
    return others.select(*docs.columns).unionByName(kept.where(F.col(goes).isNull()).select(*docs.columns)).unionByName(once.select(*docs.columns))


def met_and_others(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` may be one of the distinct ``keys`` (a Bloom filter says so), and all others, which need no join."""
    may = F.coalesce(might_hold(bloom_filter(keys, keys.count()), key), F.lit(False))
    return rows.where(may), rows.where(~may)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.columns
    rows, key = keyed(docs)
    live, repository = free_name(docs, "_live"), free_name(docs, "_repository")
    held = rows.select(key, "text", "source", F.concat_ws("/", "source", "lang").alias(repository))
    found = secrets.scan(held, repository=repository, owner="source", columns=[key]).where("n_live > 0")
    spans = stored(found.groupBy(key).agg(F.max("live_spans").alias(live)), "pipeline-spans")
    met, others = met_and_others(rows, spans.select(key), key)
    joined = met.join(spans, key, "left")
    hit = F.col(live).isNotNull()
    out = joined.withColumn("text", F.when(hit, secrets.redacted(F.coalesce("text", F.lit("")), F.col(live))).otherwise(F.col("text")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(hit, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*columns).unionByName(others.select(*columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, vocabulary()).drop("ids").withColumnRenamed("offset", "sequence_offset")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

# The stages run trained models, tokenisers and graph algorithms, which SQL can't express; tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written to the shared folder and read again by the next.

    Once a stage's result is written, its intermediate tables and the result of the stage before are deleted.
    The stages that run Python bound the session's Arrow batches (``small_batches``).
    """
    docs = table(spark, sf_dir, "documents")
    done = tables_written()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        delete_tables(spark, done, tables_written() - 1)
        done = tables_written() - 1
    out = STAGES[-1][1](spark, docs, sf_dir)
    delete_tables(spark, done, done + 1)  # packing has read it once, into tables of its own
    return out
