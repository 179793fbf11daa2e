"""Exact stratified splits without sorting or shuffling the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.plans.lineage import cut_lineage, is_small

NAMES = ("train", "validation", "test")
SHARES = (0.70, 0.15, 0.15)
HASH_SPACE = 2**32


def row_hash(id_column: str, seed: int = 42) -> Column:
    """A number in [0, 2^32) that depends on the seed and the row's id only."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_column)), F.lit(HASH_SPACE))


def stratified_split(
    df: DataFrame,
    id_column: str,
    label: str,
    shares: Sequence[float] = SHARES,
    names: Sequence[str] = NAMES,
    seed: int = 42,
    hashed: Column | None = None,
    buckets: int = 65_536,
) -> DataFrame:
    """Add ``split``: within each label the rows in hash order are cut at the exact shares.

    A count per (label, hash bucket) shows in which bucket each cut falls. Only the rows of those few
    buckets (one in ``buckets``) are ranked, which yields one cutting row per label and cut. All other
    rows are compared with the cutting rows in place and never move. The first two passes read id and label
    only. Ids are unique; rows with a null label get a null split.
    """
    rows = df.withColumn("_hash", row_hash(id_column, seed) if hashed is None else hashed)
    bucket = F.floor(F.col("_hash") / F.lit(HASH_SPACE // buckets))
    counts = cut_lineage(
        rows.filter(F.col(label).isNotNull()).groupBy(label, bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    )
    per_label = Window.partitionBy(label)
    before = F.coalesce(
        F.sum("_n").over(per_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = counts.withColumns({"_before": before, "_rows": F.sum("_n").over(per_label)})
    reached = [sum(shares[: k + 1]) for k in range(len(shares) - 1)]
    ranks = F.array(
        *[
            F.struct(F.lit(k).alias("cut"), F.floor(F.col("_rows") * F.lit(round(share, 12)) + 0.5).alias("rank"))
            for k, share in enumerate(reached)
        ]
    )
    edges = cut_lineage(
        placed.select(label, "_bucket", "_before", "_n", F.inline(ranks))
        .filter((F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_before") + F.col("_n")))
        .select(label, "_bucket", "cut", (F.col("rank") - F.col("_before")).alias("_local"))
    )
    # edges has at most one row per label and cut, and the tables derived from it have no more
    hinted = F.broadcast if is_small(edges) else (lambda side: side)
    ranked = (
        rows.select(label, id_column, "_hash", bucket.alias("_bucket"))
        .join(hinted(edges.select(label, "_bucket").distinct()), [label, "_bucket"], "left_semi")
        .withColumn("_local", F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", id_column)))
    )
    cutting = cut_lineage(
        ranked.join(hinted(edges), [label, "_bucket", "_local"])
        .groupBy(label)
        .agg(
            *[
                F.max(F.when(F.col("cut") == k, F.struct("_hash", id_column))).alias(f"_cut_{k}")
                for k in range(len(reached))
            ]
        )
    )
    here = F.struct("_hash", id_column)
    split = F.when(F.col(label).isNull(), F.lit(None).cast("string"))
    for k, name in enumerate(names[:-1]):
        split = split.when(here <= F.col(f"_cut_{k}"), name)
    return (
        rows.join(hinted(cutting), label, "left")
        .withColumn("split", split.otherwise(names[-1]))
        .select(*df.columns, "split")
    )


def hash_split(
    df: DataFrame, id_column: str, shares: Sequence[float] = SHARES, names: Sequence[str] = NAMES, seed: int = 42
) -> DataFrame:
    """Add ``split`` by hash thresholds alone: no pass over the data, shares hold on average."""
    position = row_hash(id_column, seed) / F.lit(float(HASH_SPACE))
    split, reached = F.when(F.lit(False), names[0]), 0.0
    for name, share in zip(names[:-1], shares):
        reached += share
        split = split.when(position < reached, name)
    return df.withColumn("split", split.otherwise(names[-1]))


def split_report(df: DataFrame, label: str) -> DataFrame:
    """split, label, n, share of all rows, share within the split — from one small grouping."""
    grouped = df.groupBy("split", label).agg(F.count("*").alias("n"))
    in_split = F.sum("n").over(Window.partitionBy("split"))
    return grouped.select(
        "split",
        label,
        "n",
        (F.col("n") / grouped.agg(F.sum("n")).scalar()).alias("share"),
        (F.col("n") / in_split).alias("share_in_split"),
    )
