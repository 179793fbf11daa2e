"""Latest row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the row that is largest in ``order`` for every key.

    ``order`` should end in a unique column, otherwise the choice among equal rows is open. Catalyst
    limits every group to one row on the map side already (WindowGroupLimit), so a hot key sends at
    most one row per task through the shuffle.
    """
    descending = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    newest_first = Window.partitionBy(*keys).orderBy(*descending)
    return df.withColumn("_nth", F.row_number().over(newest_first)).filter("_nth = 1").drop("_nth")
