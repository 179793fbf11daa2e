"""Run tracking: an append-only Parquet table with one row per run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = (
    "run_id string, parent_id string, name string, stage string, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>, logged_at timestamp"
)


def log_run(
    spark: SparkSession,
    path: str,
    name: str,
    stage: str,
    params: Mapping[str, str] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
    parent_id: str | None = None,
) -> str:
    """Append one run and return its id; ``parent_id`` nests it."""
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        parent_id,
        name,
        stage,
        {k: str(v) for k, v in (params or {}).items()},
        {k: float(v) for k, v in (metrics or {}).items() if v is not None},
        dict(tags or {}),
        datetime.now(timezone.utc),
    )
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def best_run_by_metric(runs: DataFrame, metric: str, by: str = "name", run_id: str = "run_id") -> DataFrame:
    """Per ``by`` the run with the largest metric (the smallest id among equals); runs without it, or with NaN, do not count.

    Value and id come out of the same struct. A min over structs combines map-side, so one name with most of the runs stays cheap.
    """
    value = F.col("metrics")[metric]
    measured = runs.withColumn("_metric", value).filter(value.isNotNull() & ~F.isnan(value))
    top = measured.groupBy(by).agg(F.min(F.struct((-F.col("_metric")).alias("_below"), F.col(run_id).alias("_id"))).alias("_best"))
    return top.select(by, F.col("_best")["_id"].alias(run_id), (-F.col("_best")["_below"]).alias(metric))
