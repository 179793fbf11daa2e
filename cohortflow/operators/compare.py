"""Comparing results and bounded previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def result_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows in one result and not in the other, with their surplus; empty when both are equal as multisets.

    One union and one grouping: equal rows collapse on the map side before anything is shuffled.
    """
    columns = actual.columns
    signed = actual.withColumn("_sign", F.lit(1)).unionByName(expected.select(*columns).withColumn("_sign", F.lit(-1)))
    net = signed.groupBy(*columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    return net.select(
        *columns,
        F.when(F.col("_net") > 0, "actual only").otherwise("expected only").alias("side"),
        F.abs("_net").alias("copies"),
    )


def sample_head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
