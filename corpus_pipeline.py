"""Corpus preparation over ``documents``: language, exact copies, near copies, mix, tokens.

Every stage takes all its predecessor kept, reread from Parquet. Stages that
drop or repeat documents return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, language, mixing, set_join
from tessera.llm.rows import keep_times
from tessera.session import apply_defaults, scratch_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language; those without a letter go."""
    model = language.fit(language.labelled(docs))
    found = docs.select(F.struct(*docs.columns).alias("row"), language.predict(spark, model, F.col("text")).alias("p"))
    return found.where(F.col("p.lang_pred") != language.UNKNOWN).select("row.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_times(docs, exact_dedup.dedup(docs).withColumn("kept_once", F.col("kept").cast("long")), "kept_once")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by 5-word Jaccard of 0.8 or more."""
    return keep_times(docs, set_join.components(docs).withColumn("kept_once", F.col("stays").cast("long")), "kept_once")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; not at all if it takes none."""
    return keep_times(docs, mixing.mix(docs), "copies")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, checked by decoding them; of the columns of documents only the id stays."""
    encoded = docs.select("doc_id", bpe.encode_checked(F.col("text")).alias("p"))
    return encoded.select("doc_id", "p.ids", F.size("p.ids").cast("long").alias("n_tokens"), "p.round_trip")


def with_defaults(stage):
    """The stage under the settings that the library assumes."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_defaults(spark)
        # stages write whole rows beside the Python workers of their operators: smaller batches on both sides
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, with_defaults(stage)) for name, stage in (
    ("language", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
)]

#: SQL cannot express language identification, the mix or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
