"""From raw documents to a training mix, in five stages that are each stored before the next one.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame with the columns of ``docs``; the last
one adds how often a document is drawn. Rows are told apart by their id and a hash of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.llm.decontamination import contaminated, find_contamination
from dimkeeper.llm.mixing import mix_sources
from dimkeeper.llm.ngram_join import ngram_components
from dimkeeper.llm.quality import resample
from dimkeeper.llm.secret_scan import find_secrets, redacted
from dimkeeper.sources.scratch import materialise


def _mark() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _chosen(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` with (``left_semi``) or without (``left_anti``) their id and mark in ``keys``."""
    keys = keys.select(F.col("doc_id").alias("__key"), F.col("mark").alias("__mark")).distinct()
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["__key"]) & (_mark() == keys["__mark"]), how)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance draw towards good text selects; one without words goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _chosen(docs, resample(docs, labels).where("selected"), "left_semi")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more of their five-word shingles), the one with the smallest id; of repeated rows one."""
    groups = ngram_components(docs, n=5, percent=80).where("doc_id IS NOT NULL")
    first = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", "mark")).alias("one")).select("one.*")
    kept = _chosen(docs.where("doc_id IS NOT NULL"), first, "left_semi").withColumn("__mark", _mark())
    return kept.dropDuplicates(["doc_id", "__mark"]).drop("__mark").unionByName(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _chosen(docs, found.where(contaminated()), "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a label in the place of each secret; n_chars follows the text."""
    held = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = find_secrets(held)
    found = found.withColumn("clean", F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col("secret_spans"))))
    fresh = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(F.size("secret_spans") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))
    return found.select(*(fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated draw takes, with topic, n_tokens, factor and copies."""
    return mix_sources(docs).where("copies > 0")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
]

#: The draws follow hashes, the fit is iterated: SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
