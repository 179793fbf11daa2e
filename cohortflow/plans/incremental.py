"""Gold tables kept up to date from change rows alone.

The state of a grouped report is a set of sums: row counts, conditional counts, exact sums and their counts. States add up, so every
batch of change rows becomes a small signed state of its own, and the report is their sum. Nothing but the changed rows is read
to bring a table up to date; old batches are folded into one now and then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cohortflow.plans.lineage import broadcast_if_small
from cohortflow.sources.snapshots import AFTER, INSERT
from cohortflow.sources.tables import read_parquet

#: Sums of measured values are exact to nine decimals, whatever the order of the batches.
EXACT = "decimal(38,9)"
BATCH = "batch"


def sign_of(changes: DataFrame) -> Column:
    """+copies for rows that appear, -copies for rows that go, of the output of ``snapshot_diff``."""
    return F.when(F.col("_change_type").isin(INSERT, AFTER), F.col("_copies")).otherwise(-F.col("_copies"))


@dataclass(frozen=True)
class GroupState:
    """A grouped report as sums: rows per group, rows that meet a condition, and means with their digits."""

    keys: Sequence[str]
    total: str
    counts: Mapping[str, Column] = field(default_factory=dict)
    means: Mapping[str, tuple[str, int]] = field(default_factory=dict)

    @property
    def sums(self) -> list[str]:
        return [self.total, *self.counts, *(f"{m}__{part}" for m in self.means for part in ("sum", "n"))]

    def of(self, rows: DataFrame, sign: Column | None = None) -> DataFrame:
        """The state of ``rows``, each counted ``sign`` times: one aggregate, combined on the map side."""
        sign = F.lit(1).cast("long") if sign is None else sign.cast("long")
        terms = {self.total: F.sum("_sign")}
        terms |= {name: F.sum(F.when(F.coalesce(condition, F.lit(False)), F.col("_sign")).otherwise(0)) for name, condition in self.counts.items()}
        for name, (column, _) in self.means.items():
            value = F.col(column).cast("decimal(28,9)")
            terms[f"{name}__sum"] = F.coalesce(F.sum(value * F.col("_sign")), F.lit(0)).cast(EXACT)
            terms[f"{name}__n"] = F.sum(F.when(F.col(column).isNotNull(), F.col("_sign")).otherwise(0))
        return rows.withColumn("_sign", sign).groupBy(*self.keys).agg(*[term.alias(name) for name, term in terms.items()])

    def merged(self, states: DataFrame) -> DataFrame:
        """The sum of several states; groups without rows go."""
        kinds = dict(states.dtypes)
        added = states.groupBy(*self.keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in self.sums])
        return added.filter(F.col(self.total) != 0)

    def report(self, state: DataFrame) -> DataFrame:
        """keys, total, counts and rounded means of a merged state."""
        means = [F.round(F.try_divide(F.col(f"{m}__sum"), F.col(f"{m}__n")).cast(EXACT), digits).cast("double").alias(m) for m, (_, digits) in self.means.items()]
        return state.select(*self.keys, self.total, *self.counts, *means)


@dataclass(frozen=True)
class StateTable:
    """States of batches below ``root``. A batch has a number and a folder of its own, so that a repeated batch replaces itself.

    The list of folds says up to which batch the newest base reaches; one writer at a time folds.
    """

    spark: SparkSession
    root: str
    state: GroupState
    schema: T.StructType

    @classmethod
    def at(cls, rows: DataFrame, root: str, state: GroupState) -> StateTable:
        """A table for states of rows like ``rows``."""
        return cls(rows.sparkSession, root, state, state.of(rows.limit(0)).schema)

    def add(self, number: int, rows: DataFrame, sign: Column | None = None) -> None:
        """Take batch ``number`` in: new rows, or change rows with their signs."""
        self.state.of(rows, sign).write.mode("overwrite").parquet(f"{self.root}/deltas/{BATCH}={number}")

    def _folds(self) -> DataFrame:
        return read_parquet(self.spark, f"{self.root}/folds", "upto long")

    def _parts(self) -> DataFrame:
        """The newest base and the batches after it."""
        upto = self._folds().agg(F.max("upto")).first()[0]
        deltas = read_parquet(self.spark, f"{self.root}/deltas", T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())]))
        if upto is None:
            return deltas.drop(BATCH)
        base = self.spark.read.schema(self.schema).parquet(f"{self.root}/bases/upto={upto}")
        return base.unionByName(deltas.filter(F.col(BATCH) > upto).drop(BATCH))  # folders of folded batches are not read

    def current(self) -> DataFrame:
        """The merged state of all batches."""
        return self.state.merged(self._parts())

    def report(self) -> DataFrame:
        return self.state.report(self.current())

    def fold(self, upto: int) -> None:
        """Merge everything through batch ``upto`` into a base; readers change over when the base is complete."""
        last = self._folds().agg(F.max("upto")).first()[0]
        if last is not None and last >= upto:
            return
        deltas = read_parquet(self.spark, f"{self.root}/deltas", T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())]))
        parts = deltas.filter((F.col(BATCH) <= upto) & (F.col(BATCH) > (-1 if last is None else last))).drop(BATCH)
        if last is not None:
            parts = parts.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.root}/bases/upto={last}"))
        self.state.merged(parts).write.mode("overwrite").parquet(f"{self.root}/bases/upto={upto}")
        self.spark.range(1).select(F.lit(upto).cast("long").alias("upto")).coalesce(1).write.mode("append").parquet(f"{self.root}/folds")


def touched(state: GroupState, table: StateTable, changes: DataFrame) -> DataFrame:
    """The report lines of the groups that ``changes`` mention: what a downstream table has to replace."""
    keys = changes.select(*state.keys).distinct()
    return state.report(table.current().join(broadcast_if_small(keys), list(state.keys), "left_semi"))
