"""File layout: rows range-clustered on one or more columns so that file statistics prune scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def cluster_rows(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``columns``.

    The number of the input task closes the range key. It stays the same when a task is retried, and it
    lets rows with one hot key spread over many output files instead of one.
    """
    tagged = df.withColumn("_source_task", F.spark_partition_id())
    keys = [*columns, "_source_task"]
    ranged = tagged.repartitionByRange(partitions, *keys) if partitions else tagged.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*columns).drop("_source_task")


#: Ranks of a column on the curve, as bits.
RANK_BITS = 8


def _as_number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values: texts by their first six bytes."""
    kind = dict(df.dtypes)[column]
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    return F.col(column).cast("timestamp").cast("double") if kind.startswith("timestamp") else F.col(column).cast("double")


def _with_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_rank0``, ``_rank1``, ...: how many of a column's range edges lie at or below the value; 0 for nulls.

    The edges are approximate quantiles, one pass for all columns, so each column is cut into ranges of like size whatever its values. They are
    searched by halves, a look-up per bit: each step is a column of its own, which the next ones read and do not repeat.
    """
    shares = [k / (1 << RANK_BITS) for k in range(1, 1 << RANK_BITS)]
    found = df.agg(*[F.percentile_approx(_as_number(df, c), shares, 2000).alias(f"q{n}") for n, c in enumerate(columns)]).first()
    numbers = df.withColumns({f"_number{n}": _as_number(df, c) for n, c in enumerate(columns)})
    ranks = numbers.withColumns({f"_rank{n}": F.lit(0).cast("long") for n in range(len(columns))})
    edges = [sorted(set(found[f"q{n}"] or []), key=lambda e: (e != e, e)) for n in range(len(columns))]  # NaN is the largest, as in Spark
    padded = [F.array(*[F.lit(e) for e in own], *[F.lit(None).cast("double")] * (len(shares) - len(own))) for own in edges]
    for bit in reversed(range(RANK_BITS)):
        step = 1 << bit

        def raised(n: int, step: int = step) -> Column:
            rank = F.col(f"_rank{n}")
            return rank + F.when(F.get(padded[n], (rank + (step - 1)).cast("int")) <= F.col(f"_number{n}"), step).otherwise(0)

        ranks = ranks.withColumns({f"_rank{n}": raised(n) for n in range(len(columns))})
    return ranks.drop(*[f"_number{n}" for n in range(len(columns))])


def with_curve_position(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_curve``, the place on a space-filling curve: the bits of the columns' range ranks in turn. Nulls have rank 0."""
    position = F.lit(0).cast("long")
    for n in range(len(columns)):
        for bit in range(RANK_BITS):
            position = position.bitwiseOR(F.shiftleft(F.shiftright(F.col(f"_rank{n}"), bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + n))
    return _with_ranks(df, columns).withColumn("_curve", position).drop(*[f"_rank{n}" for n in range(len(columns))])


def cluster_on_curve(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the place on the curve over ``columns``, so that a filter on any one of them touches few files.

    As in ``cluster_rows``, the input task closes the range key, so that rows of one hot place fill several files.
    """
    tagged = with_curve_position(df, columns).withColumn("_source_task", F.spark_partition_id())
    keys = ["_curve", "_source_task"]
    ranged = tagged.repartitionByRange(partitions, *keys) if partitions else tagged.repartitionByRange(*keys)
    return ranged.sortWithinPartitions("_curve").drop(*keys)
