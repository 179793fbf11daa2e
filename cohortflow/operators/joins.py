"""Left joins to dimensions, known-pair flags and cardinality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortflow.plans.lineage import broadcast_if_small, cut_lineage


def join_dim(fact: DataFrame, dim: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Left join that adds ``attributes`` of ``dim``; facts without a dimension row stay, with nulls.

    Carries no hint on purpose: Catalyst broadcasts the dimension if its statistics stay below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges with AQE skew splitting otherwise.
    """
    return fact.join(dim.select(*keys, *attributes), list(keys), "left")


def join_dim_salted(fact: DataFrame, dim: DataFrame, keys: Sequence[str], attributes: Sequence[str], rows_per_task: int = 1_000_000) -> DataFrame:
    """The same left join with hot keys split by hand, for a ``dim`` that is itself an aggregate.

    AQE splits a hot key only between two plain shuffles; an aggregate on one side hides it. A key is hot
    when it holds more facts than one task should have; there is at most one such key per ``rows_per_task`` facts, so they
    can be broadcast, each with as many salts as it needs. Its facts spread over them by the task that read them (stable
    under retries), and only its dimension row is repeated. Facts with a null key match nothing and spread over all tasks.
    """
    keys = list(keys)
    counted = fact.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task)
    hot = F.broadcast(cut_lineage(counted.select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    task = F.spark_partition_id()
    salt = F.when(no_key, task).when(F.col("_salts").isNotNull(), F.pmod(task, F.col("_salts"))).otherwise(0)
    salted_fact = fact.join(hot, keys, "left").withColumn("_salt", salt).drop("_salts")
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_dim = dim.select(*keys, *attributes).join(hot, keys, "left").select(*keys, *attributes, F.explode(every_salt).alias("_salt"))
    return salted_fact.join(salted_dim, [*keys, "_salt"], "left").drop("_salt")


def pair_table(spark: SparkSession, pairs: Mapping[str, Sequence[str]], left: str, right: str) -> DataFrame:
    """The (left, right) rows of a lookup written as ``{left: [right, ...]}``."""
    rows = [(key, value) for key, values in pairs.items() for value in values]
    return spark.createDataFrame(rows, f"{left} string, {right} string")


def flag_known_pairs(df: DataFrame, pairs: DataFrame, left: str, right: str, flag: str) -> DataFrame:
    """Boolean column: is (left, right) one of ``pairs``. A pair table of proven size keeps ``df`` in place."""
    known = pairs.select(left, right).distinct().withColumn("_known", F.lit(True))
    return (
        df.join(broadcast_if_small(known), [left, right], "left").withColumn(flag, F.coalesce("_known", F.lit(False))).drop("_known")
    )


def pair_condition(pairs: Mapping[str, Sequence[str]], left: Column, right: Column) -> Column:
    """The same test as a plain expression, for a handful of fixed pairs: no join at all."""
    condition = F.lit(False)
    for key, values in pairs.items():
        condition = condition | ((left == key) & right.isin(*values))
    return F.coalesce(condition, F.lit(False))


def check_many_to_one(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once on the 'one' side; empty when the relationship holds."""
    return dim.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
