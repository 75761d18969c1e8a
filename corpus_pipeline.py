"""A training-text pipeline out of the operators in ``creditmart.llm``.

Every stage takes the documents its predecessor kept and returns the columns of
documents; the last adds how the mix was drawn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import decontaminate, mixing, quality, secrets, simhash
from creditmart.llm.queries import MIX_BUDGET, MIX_TARGETS
from creditmart.session import scratch_path


def _columns(docs: DataFrame, changed: dict[str, Column] | None = None) -> list[Column]:
    """The documents' columns out of ``row``, some of them replaced; ``n_chars`` follows the text."""
    changed = dict(changed or {})
    if "text" in changed and "n_chars" in docs.columns:
        same = changed["text"].eqNullSafe(F.col("row.text"))
        length = F.char_length(changed["text"]).cast(docs.schema["n_chars"].dataType)
        changed.setdefault("n_chars", F.when(same, F.col("row.n_chars")).otherwise(length))
    return [changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).where("kept").select(*_columns(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: one with the least key.

    The documents are stored once with fingerprint and place, so what decides
    is joined back by place, and rows alike in every column stay apart.
    """
    path = scratch_path(spark, "fingerprints")
    placed = simhash.fingerprints(docs).withColumn("place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    stored = spark.read.parquet(path)
    groups = simhash.grouped(
        stored.select(F.col("row.doc_id").alias("doc_id"), "fingerprint", "place"), F.col("doc_id")
    )
    first = groups.where("doc_id <=> component_id").groupBy("component").agg(F.min("place").alias("place"))
    return stored.join(first, "place", "left_semi").select(*_columns(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every passage of the benchmark cut out of the texts."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts, also encoded ones, and what could not be scanned, replaced by a mask."""
    return secrets.find_secrets(docs).select(*_columns(docs, {"text": F.col("masked")}))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn into the mix, with ``expected`` and ``copies``."""
    mixed = mixing.mix(docs, MIX_TARGETS, MIX_BUDGET).where("copies > 0")
    return mixed.select(*_columns(docs), F.col("n_tokens").alias("mix_tokens"), "topic", "expected", "copies")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
