"""Running totals over a total order without pulling the order into one task.

An unpartitioned window would sort every row in a single task. Here the rows are range-sorted over all
tasks and checkpointed, which fixes the partitions and their order; one sum per partition gives each partition
its starting offset, and the running sums are taken batch by batch where the rows lie: no second shuffle or sort.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from cohortflow.plans.lineage import broadcast_if_small, cut_lineage

PART = "_part"


def _cumulative(by: Sequence[str], sums: Sequence[str], names: Sequence[str]):
    """Arrow batches of one sorted partition with the running sum of every column, begun anew with every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, last = {}, None
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            starts = np.zeros(rows, bool)
            starts[0] = last is None or any(batch.column(c)[0] != v for c, v in zip(by, last))
            for c in by:
                starts[1:] |= pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            group = np.cumsum(starts)
            heads = np.flatnonzero(starts)
            added = {}
            for c in sums:
                running = np.cumsum(pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False))
                # what ran up before each group began, minus what an earlier batch brought to the first group
                before = np.concatenate(([-carried.get(c, 0) if not starts[0] else 0], np.where(heads > 0, running[heads - 1], 0))).astype(running.dtype)
                added[c] = running - before[group]
                carried[c] = added[c][-1]
            last = [batch.column(c)[rows - 1] for c in by]
            columns = [
                pa.array(added[n.removesuffix("_here")]) if n.endswith("_here") and n.removesuffix("_here") in added else batch.column(n)
                for n in names
            ]
            yield pa.RecordBatch.from_arrays(columns, list(names))

    return run


def running_totals(df: DataFrame, order: Sequence[str], sums: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``<c>_upto`` (total through this row) and ``<c>_total`` for every column of ``sums``.

    ``df`` holds one row per (by, order) value, that is, it is already aggregated, so no range can be
    dominated by one hot value. ``by`` names non-null group columns.
    """
    by, order = list(by), list(order)
    ranged = cut_lineage(df.orderBy(*by, *order)).withColumn(PART, F.spark_partition_id())
    # one row per partition and group: small by construction
    parts = ranged.groupBy(*by, PART).agg(*[F.sum(c).alias(f"_{c}_here") for c in sums])
    kinds = dict(parts.dtypes)
    group = Window.partitionBy(*by)
    earlier = group.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        PART,
        *[F.coalesce(F.sum(f"_{c}_here").over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums],
        *[F.sum(f"_{c}_here").over(group).alias(f"{c}_total") for c in sums],
    )
    offsets = broadcast_if_small(offsets) if by else F.broadcast(offsets)
    wide = ranged.withColumns({f"{c}_here": F.col(c).cast(kinds[f"_{c}_here"]) for c in sums})
    inside = wide.mapInArrow(_cumulative(by, sums, wide.columns), wide.schema)
    return (
        inside.join(offsets, [*by, PART])
        .withColumns({f"{c}_upto": F.col(f"_{c}_before") + F.col(f"{c}_here") for c in sums})
        .drop(PART, *[f"_{c}_before" for c in sums], *[f"{c}_here" for c in sums])
    )
