"""Leakage screen: features that know the label too well."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortflow.learning.metrics import auc_from_totals, score_totals
from cohortflow.operators.profile import long_format


@dataclass(frozen=True)
class LeakageLimits:
    correlation: float = 0.6
    auc: float = 0.95
    pure_rate: float = 0.99
    min_rows: int = 1


def leakage_screen(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], limits: LeakageLimits = LeakageLimits()
) -> DataFrame:
    """feature, kind, correlation, auc, min_rate, max_rate, suspicious.

    Numeric features: |r| with the label and the AUC of the feature alone (direction-free). Categories:
    lowest and highest class rate among values with at least ``min_rows`` rows.
    """
    flag = F.col(label).cast("int")
    parts = []
    if numeric:
        strength = df.agg(
            *[
                F.struct(F.lit(c).alias("feature"), F.abs(F.corr(F.col(c).cast("double"), flag.cast("double"))).alias("correlation")).alias(f"_{i}")
                for i, c in enumerate(numeric)
            ]
        ).select(F.inline(F.array(*[f"_{i}" for i in range(len(numeric))])))
        scored = long_format(df.select(flag.alias("_label"), *numeric), numeric, extra=["_label"])
        single = auc_from_totals(score_totals(scored, "_label", "value", by=["column"]), by=["column"]).select(
            F.col("column").alias("feature"), F.greatest("roc_auc", 1 - F.col("roc_auc")).alias("auc")
        )
        # one row per listed feature on both sides
        parts.append(
            strength.join(F.broadcast(single), "feature", "left").select(
                "feature",
                F.lit("numeric").alias("kind"),
                "correlation",
                "auc",
                F.lit(None).cast("double").alias("min_rate"),
                F.lit(None).cast("double").alias("max_rate"),
                (F.coalesce(F.col("correlation") > limits.correlation, F.lit(False)) | F.coalesce(F.col("auc") > limits.auc, F.lit(False))).alias("suspicious"),
            )
        )
    if categorical:
        rates = (
            long_format(df.select(flag.alias("_label"), *categorical), categorical, extra=["_label"], as_type="string")
            .groupBy("column", "value")
            .agg(F.count("_label").alias("_n"), F.avg("_label").alias("_rate"))
            .filter(F.col("_n") >= limits.min_rows)
            .groupBy(F.col("column").alias("feature"))
            .agg(F.min("_rate").alias("min_rate"), F.max("_rate").alias("max_rate"))
        )
        parts.append(
            rates.select(
                "feature",
                F.lit("categorical").alias("kind"),
                F.lit(None).cast("double").alias("correlation"),
                F.lit(None).cast("double").alias("auc"),
                "min_rate",
                "max_rate",
                ((F.col("max_rate") >= limits.pure_rate) | (F.col("min_rate") <= 1 - limits.pure_rate)).alias("suspicious"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
