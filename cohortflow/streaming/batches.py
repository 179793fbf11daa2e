"""Silver rows per micro-batch, with a ledger that makes a retried batch count once.

A batch writes its rows to a folder of its own and then, as its last act, its rule counts to the ledger. A retry overwrites both. Readers
take the rows of the batches that the ledger has, so a batch that died half-way is not seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortflow.clinical.silver import SilverTable, to_silver, typed_columns
from cohortflow.operators.quality import quality_report
from cohortflow.plans.incremental import StateTable
from cohortflow.plans.lineage import broadcast_if_small
from cohortflow.sources.tables import read_parquet

BATCH = "batch"
COUNTS = "rule string, action string, passed long, failed long, dropped long, batch long"


@dataclass(frozen=True)
class SilverBatches:
    """``root`` is a shared folder that holds the rows, the ledger and the stream's own marks of one silver table.

    ``states`` are grouped reports that every batch of silver rows is added to, under the batch's number.
    """

    spark: SparkSession
    root: str
    table: SilverTable
    states: Sequence[StateTable] = ()

    def write(self, batch: DataFrame, number: int) -> None:
        """One micro-batch of bronze rows: its silver rows, the reports they change, then its counts."""
        silver, path = to_silver(batch, self.table), f"{self.root}/rows/{BATCH}={number}"
        silver.write.mode("overwrite").parquet(path)
        for state in self.states:
            state.add(number, self.spark.read.schema(silver.schema).parquet(path))
        counts = quality_report(typed_columns(batch, self.table), self.table.rules)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/{BATCH}={number}")

    def update(self, bronze: DataFrame) -> None:
        """Bring the table up to date with an unstarted stream of bronze rows. A rerun adds nothing."""
        stream = bronze.writeStream.foreachBatch(self.write).option("checkpointLocation", f"{self.root}/marks")
        stream.trigger(availableNow=True).start().awaitTermination()

    def ledger(self) -> DataFrame:
        """batch, rule, action, passed, failed, dropped of every complete batch."""
        return read_parquet(self.spark, f"{self.root}/ledger", COUNTS)

    def report(self) -> DataFrame:
        """rule, action, passed, failed, dropped over all complete batches."""
        return self.ledger().groupBy("rule", "action").agg(*[F.sum(c).alias(c) for c in ("passed", "failed", "dropped")])

    def rows(self, like: T.StructType) -> DataFrame:
        """The silver rows of all complete batches; ``like`` is the schema of the silver table."""
        complete = self.ledger().select(BATCH).distinct()
        found = read_parquet(self.spark, f"{self.root}/rows", T.StructType([*like.fields, T.StructField(BATCH, T.LongType())]))
        return found.join(broadcast_if_small(complete), BATCH, "left_semi").drop(BATCH)
