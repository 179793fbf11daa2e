"""The corpus pipeline: documents in, the rows of a training mix out. Each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import latent_leaks, odd_sketch, pair_rank, rule_ledger, source_mix
from cohortflow.plans.lineage import scratch_path

#: Whole texts lie in a batch, several times over: in the reader's vectors, in Arrow's, in the bytes sent and in the Python worker. Spark's
#: own bounds (4,096 rows read, 10,000 rows or 64 MB sent) often make one batch of a whole task, and an executor keeps what that took.
BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage under BATCHES. Its result is lazy, so the session keeps these settings, as for any job that sets its own."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; it learns from the labelled documents of its input that are not held out."""
    return pair_rank.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@small_batches
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return rule_ledger.keep_good(docs)


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): the one with the smallest id."""
    return odd_sketch.drop_near_duplicates(docs)


@small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark text."""
    return latent_leaks.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken."""
    return source_mix.mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("rules", rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]
#: No SQL: a learnt model decides in the first stage. tests/llm/test_pipeline.py holds the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
