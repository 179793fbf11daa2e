"""Where intermediate results live and when a side may be broadcast.

Intermediate data goes to the shared folder named by ``spark.checkpoint.dir``, so that the loss of an
executor costs a re-read and not a wrong or failed job.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows up to which a keyed side of a few narrow columns may be broadcast (some MB).
BROADCAST_ROWS = 200_000
#: Bytes of text up to which it may be.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortflow-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` does, with compressed columns: later passes read only what they need,
    and a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_once(tables: Mapping[str, DataFrame], names: Collection[str]) -> dict[str, DataFrame]:
    """``tables`` with the named ones stored, so that each is computed once for all that read it. A table that fails stays as it is."""
    out = dict(tables)
    for name in sorted(set(names) & set(tables)):
        try:
            out[name] = stored(tables[name], "table")
        except Exception:  # it fails again, and is reported, where it is read
            out[name] = tables[name]
    return out


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a reliable checkpoint; later passes read the files, not the plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise_evenly(df: DataFrame, *keys: str) -> DataFrame:
    """Checkpoint ``df`` in even partitions for many CPU-heavy passes.

    AQE sizes the partitions by bytes; a result too small for that to occupy every core is spread once more.
    """
    even = cut_lineage(df.repartition(*keys))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return even if even.rdd.getNumPartitions() >= cores else cut_lineage(even.repartition(cores, *keys))


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """A bounded count of rows and of the bytes of their texts: stops once it is clear that there are more rows."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    size = F.sum(sum(texts, F.lit(0)).cast("bigint"))
    found = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("bytes")).first()
    return found["n"] <= max_rows and found["bytes"] <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if a bounded count proves it small.

    A larger side is returned unhinted: it takes the shuffle join, whose hot keys AQE splits.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df
