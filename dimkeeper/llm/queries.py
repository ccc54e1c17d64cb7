"""The registered queries of this folder, and their DuckDB statements where SQL can express them.

Each query reads its whole table, applies one operator and derives the columns that are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.llm.decontamination import contaminated, find_contamination
from dimkeeper.llm.html_text import extract_text
from dimkeeper.llm.mixing import mix_sources
from dimkeeper.llm.neighbour_graph import near_duplicates
from dimkeeper.llm.ngram_join import ngram_components
from dimkeeper.llm.oracles import ORACLE_SQL
from dimkeeper.llm.periodic_runs import find_runs
from dimkeeper.llm.phrase_graph import mine_phrases
from dimkeeper.llm.preference import conversations, format_preferences, pair_replies
from dimkeeper.llm.quality import resample
from dimkeeper.llm.secret_scan import KINDS, find_secrets, joined
from dimkeeper.llm.substring_dedup import remove_repeated_words
from dimkeeper.llm.suffix_dedup import remove_repeated_bytes
from dimkeeper.llm.top_products import top_products


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def q_op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_of = [F.expr(f"CAST(size(filter(base_spans, s -> s.kind = {k})) AS long) AS n_{name}") for k, name in enumerate(KINDS[:3])]
    base = F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *n_of, base, joined(F.col("secret_spans")).alias("spans"))


def q_op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens", "factor", "copies")


def q_op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def q_op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def q_op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = conversations(_table(spark, sf_dir, "conversations"))
    return format_preferences(pair_replies(talks))


def q_op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_features", "weight", "key", "selected")


def q_op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def q_op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_words(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def q_op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def _folded(docs: DataFrame) -> DataFrame:
    """Documents as the query of periodic runs takes them: about one in ten repeats a stretch to its end.

    With h, the CRC-32 of the decimal id, a multiple of 10 and n > 0 words, word i >= a becomes word a + (i - a) % p.
    """
    h, g = F.crc32(F.col("doc_id").cast("string")), F.expr("h div 10")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    staged = docs.select("doc_id", "text", h.alias("h")).withColumn("ws", F.when(F.expr("h % 10 = 0"), words))
    staged = staged.withColumn("n", F.size("ws").cast("long")).withColumn("g", g).withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    staged = staged.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    folded = F.expr("array_join(transform(sequence(0, n - 1), i -> ws[CAST(IF(i < a, i, a + (i - a) % p) AS int)]), ' ')")
    return staged.select("doc_id", F.when(F.expr("h % 10 = 0 AND n > 0"), folded).otherwise(F.col("text")).alias("text"))


def q_op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_folded(_table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.expr("-longest.start AS start"),
        F.expr("longest.length AS length"),
        F.expr("-longest.period AS period"),
        F.expr("(1000 * longest.length) div (-longest.period) AS exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def q_op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents")).drop("path")


def q_op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
