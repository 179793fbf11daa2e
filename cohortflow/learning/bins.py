"""Candidate thresholds of a fit from all of its rows.

Spark's learner takes them from about ``maxBins`` squared rows where it is given more. It gets the numbers of the bins instead, which are few, and
so many ``maxBins`` that it counts them on all rows; the trees are then stated over the values themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.plans.lineage import scratch_path
from cohortflow.plans.ordered import running_totals

#: The learner squares its number of bins as a 32-bit integer.
MOST_BINS = 46_340


def learner_bins(n: int, bins: int) -> int:
    """``maxBins`` for bin numbers below ``bins``, so that the learner looks at all ``n`` rows before it splits."""
    return max(bins, min(MOST_BINS, math.isqrt(max(n - 1, 0)) + 1))


def between(low: float, high: float) -> float:
    """A threshold with ``low`` at or below it and ``high`` above it, in the middle where there is room."""
    middle = low / 2 + high / 2
    return middle if low <= middle < high else low


def thresholds(rows: DataFrame, vector: str, bins: int) -> list[list[float]]:
    """Per feature of ``vector`` its thresholds, ascending, ``bins - 1`` at most.

    They lie between all neighbouring values of a feature of up to ``bins`` values, and otherwise between ``bins`` groups of about equally many
    rows. NaN is no value. Only the ends of the bins reach the driver.
    """
    size = len(rows.select(vector_to_array(vector)).first()[0])
    listed = rows.select(F.posexplode(vector_to_array(vector)).alias("feature", "value")).filter(~F.isnan("value"))
    counted = listed.groupBy("feature", "value").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("bigint"))
    placed = running_totals(counted, order=["value"], sums=["n", "one"], by=["feature"])
    number = F.when(F.col("one_total") <= bins, F.col("one_upto")).otherwise(F.expr(f"(n_upto - n) * {bins} div n_total"))
    ends = placed.groupBy("feature", number.alias("bin")).agg(F.min("value").alias("low"), F.max("value").alias("high")).orderBy("feature", "bin").collect()
    found = [[r for r in ends if r["feature"] == f] for f in range(size)]
    return [[between(a["high"], b["low"]) for a, b in pairwise(of)] for of in found]


def to_bins(rows: DataFrame, vector: str, edges: Sequence[Sequence[float]]) -> DataFrame:
    """``rows`` with every value of ``vector`` replaced by how many of its feature's thresholds lie below it.

    NaN and infinities stay, so that the learner refuses them here as in small fits.
    """
    keep = [c for c in rows.columns if c != vector]
    wide = rows.select(*keep, vector_to_array(vector).alias(vector))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(vector).flatten().to_numpy().reshape(batch.num_rows, -1)
            numbers = np.column_stack([np.searchsorted(e, values[:, f]) for f, e in enumerate(edges)])
            numbers = np.where(np.isfinite(values), numbers, values)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(edges))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.ListArray.from_arrays(ends, pa.array(numbers.ravel()))], [*keep, vector])

    found = wide.mapInArrow(run, rows.select(*keep).schema.add(vector, T.ArrayType(T.DoubleType())))
    return found.withColumn(vector, array_to_vector(vector))


def over_values(model: GBTClassificationModel, edges: Sequence[Sequence[float]], spark) -> GBTClassificationModel:
    """The booster over the values, from one over the numbers of their bins. Its saved form is written anew with other thresholds."""
    path, out = scratch_path(spark, "booster"), scratch_path(spark, "booster")
    for each in (path, out):
        model.write().save(each)
    known = spark.createDataFrame([(f, n, t) for f, of in enumerate(edges) for n, t in enumerate(of)], "_feature int, _bin long, _value double")
    node, asked = F.col("nodeData"), F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data")
    met = nodes.join(F.broadcast(known), (asked["featureIndex"] == F.col("_feature")) & (F.floor(F.get(asked["leftCategoriesOrThreshold"], F.lit(0))) == F.col("_bin")), "left")
    threshold = F.when(F.col("_value").isNull(), asked["leftCategoriesOrThreshold"]).otherwise(F.array("_value"))
    split = asked.withField("leftCategoriesOrThreshold", threshold)
    met.withColumn("nodeData", node.withField("split", split)).select(*nodes.columns).write.mode("overwrite").parquet(f"{out}/data")
    return GBTClassificationModel.load(out)
