"""Grouped reports: counts, conditional counts, rounded means, ratios, value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def rounded_mean(value: Column, digits: int) -> Column:
    """Mean of the non-null values, rounded half up.

    The mean is fixed to nine decimals first: a sum of doubles depends on the row order in its last bits,
    and those must not decide how a tie is rounded.
    """
    return F.round(F.round(F.avg(value), 9), digits)


def group_report(
    df: DataFrame,
    keys: Sequence[str],
    total: str | None = None,
    counts: Mapping[str, Column] | None = None,
    means: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """One row per key group: row count, conditional counts and rounded means, in a single pass.

    ``counts`` maps an output name to a condition (null counts as false); ``means`` maps an output
    name to (column, decimals). All aggregates combine map-side, so a hot group never lands in one task.
    """
    aggregates = [F.count("*").alias(total)] if total else []
    aggregates += [F.count_if(condition).alias(name) for name, condition in (counts or {}).items()]
    aggregates += [rounded_mean(F.col(c), digits).alias(name) for name, (c, digits) in (means or {}).items()]
    return df.groupBy(*keys).agg(*aggregates)


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` of ``whole`` in percent; null where ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``column``, ``n`` and ``share`` of the whole."""
    grouped = df.groupBy(column).agg(F.count("*").alias("n"))
    return grouped.withColumn("share", F.col("n") / grouped.agg(F.sum("n")).scalar())


def rate_by_category(df: DataFrame, category: str, label: str) -> DataFrame:
    """Share of true labels per category next to the overall share; rows without a label do not count."""
    flag = F.col(label).cast("int")
    grouped = df.groupBy(category).agg(F.count(flag).alias("n"), F.sum(flag).alias("_true"))
    overall = grouped.agg(F.try_divide(F.sum("_true"), F.sum("n"))).scalar()
    return grouped.select(
        category,
        "n",
        F.try_divide("_true", "n").alias("rate"),
        overall.alias("overall_rate"),
    )


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Counts of both classes and negatives per positive, in one pass."""
    flag = F.col(label).cast("boolean")
    return df.agg(F.count_if(~flag).alias("negatives"), F.count_if(flag).alias("positives")).withColumn(
        "ratio", F.try_divide("negatives", "positives")
    )


def top_k(df: DataFrame, measure: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest measure; ``ties`` makes the choice among equals definite."""
    return df.orderBy(F.desc_nulls_last(measure), *ties).limit(k)
