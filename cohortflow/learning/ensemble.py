"""The trees of a fitted booster as a table: split counts, running margins, and how many of the trees to keep."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from cohortflow.learning import metrics
from cohortflow.plans.lineage import scratch_path

#: Rounds without a better validation AUC after which boosting ends.
PATIENCE = 20


def node_table(model: GBTClassificationModel, spark) -> DataFrame:
    """tree, node, feature, threshold, categories, left, right, prediction, gain: one row per node, leaves without a feature.

    Read from the model's saved form. Values up to ``threshold`` go left, or those in ``categories`` where that is not null.
    """
    path = scratch_path(spark, "booster")
    model.write().overwrite().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner, listed = node["leftChild"] >= 0, split["numCategories"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ~listed, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & listed, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
        node["prediction"].alias("prediction"),
        F.when(inner, node["gain"]).alias("gain"),
    )


def split_counts(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, splits: how many nodes of all trees ask for each feature; 0 for those never asked for."""
    listed = nodes.sparkSession.createDataFrame(list(enumerate(names)), "number int, feature string")
    counted = nodes.filter("feature IS NOT NULL").groupBy(F.col("feature").alias("number")).count()
    return listed.join(counted, "number", "left").select("feature", F.coalesce("count", F.lit(0)).alias("splits"))


@dataclass(frozen=True)
class Trees:
    """All trees as arrays, one row per tree, for vectorised walks."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    categories: dict[tuple[int, int], frozenset]
    weights: np.ndarray

    @classmethod
    def of(cls, nodes: DataFrame, weights: Sequence[float]) -> Trees:
        """Collects the nodes, whose number trees and depth bound."""
        rows = nodes.collect()
        shape = len(weights), 1 + max(r["node"] for r in rows)
        feature, left, right = (np.full(shape, -1) for _ in range(3))
        threshold, prediction, categories = np.zeros(shape), np.zeros(shape), {}
        for r in rows:
            at = r["tree"], r["node"]
            prediction[at] = r["prediction"]
            if r["feature"] is not None:
                feature[at], left[at], right[at] = r["feature"], r["left"], r["right"]
                if r["categories"] is not None:
                    categories[at] = frozenset(r["categories"])
                else:
                    threshold[at] = r["threshold"]
        return cls(feature, threshold, left, right, prediction, categories, np.asarray(weights, float))

    def running_margins(self, values: np.ndarray) -> np.ndarray:
        """rows x trees: the margin after the first tree, the first two, and so on."""
        out, every = np.empty((len(values), len(self.weights))), np.arange(len(values))
        for tree, weight in enumerate(self.weights):
            at = np.zeros(len(values), int)
            while (inner := self.feature[tree, at] >= 0).any():
                asked = values[every, np.maximum(self.feature[tree, at], 0)]
                goes_left = asked <= self.threshold[tree, at]
                for node in {n for t, n in self.categories if t == tree}:
                    here = at == node
                    goes_left[here] = np.isin(asked[here], [*self.categories[tree, node]])
                at = np.where(inner, np.where(goes_left, self.left[tree, at], self.right[tree, at]), at)
            out[:, tree] = weight * self.prediction[tree, at]
        return np.cumsum(out, axis=1)


def running_margins(rows: DataFrame, trees: Trees, vector: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and ``margins``: an array with the margin of every prefix of the ensemble, in one pass over the rows."""
    model = rows.sparkSession.sparkContext.broadcast(trees)
    wide = rows.select(*keep, vector_to_array(vector).alias("_values"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                lists = batch.column("_values")
                margins = model.value.running_margins(lists.flatten().to_numpy().reshape(batch.num_rows, -1))
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * margins.shape[1])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.ListArray.from_arrays(ends, pa.array(margins.ravel()))], [*keep, "margins"])

    return wide.mapInArrow(run, rows.select(*keep).schema.add("margins", T.ArrayType(T.DoubleType())))


def prefix_auc(rows: DataFrame, label: str, margins: str = "margins") -> DataFrame:
    """trees, roc_auc of the first ``trees`` trees, for every prefix: all of them from one ordered count. Rows without a label are left out."""
    scores = rows.select(F.col(label).alias("_label"), F.posexplode(margins).alias("_at", "_score"))
    by_prefix = scores.select((F.col("_at") + 1).alias("trees"), "_label", "_score")
    return metrics.auc_from_totals(metrics.score_totals(by_prefix, "_label", "_score", ["trees"]), ["trees"]).select("trees", "roc_auc")


def kept_prefix(aucs: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """trees, roc_auc, kept: the prefixes that boosting would have reached, and the best of them.

    Boosting ends once ``patience`` rounds in a row bring no higher AUC; the smallest of equally good prefixes is kept. A prefix without an
    AUC (one class only) improves nothing; if none has one, the longest stays.
    """
    upto = Window.orderBy("trees").rowsBetween(Window.unboundedPreceding, -1)  # one row per tree
    better = F.col("roc_auc").isNotNull() & (F.max("roc_auc").over(upto).isNull() | (F.col("roc_auc") > F.max("roc_auc").over(upto)))
    marked = aucs.withColumn("_better", better).withColumn("_last", F.coalesce(F.max(F.when(F.col("_better"), F.col("trees"))).over(upto), F.lit(0)))
    ended = F.min(F.when(F.col("trees") > F.col("_last") + patience, F.col("trees"))).over(Window.partitionBy())
    reached = marked.withColumn("_end", ended).filter(F.col("_end").isNull() | (F.col("trees") < F.col("_end")))
    best = F.coalesce(F.max(F.when(F.col("_better"), F.col("trees"))).over(Window.partitionBy()), F.max("trees").over(Window.partitionBy()))
    return reached.select("trees", "roc_auc", (F.col("trees") == best).alias("kept"))


def shortened(model: GBTClassificationModel, trees: int) -> GBTClassificationModel:
    """The same booster with its first ``trees`` trees only."""
    whole = model._java_obj
    context = SparkContext._active_spark_context
    jvm, new_array = context._jvm, context._gateway.new_array
    parts, weights = new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees), new_array(jvm.double, trees)
    for at in range(trees):
        parts[at], weights[at] = whole.trees()[at], whole.treeWeights()[at]
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(whole.uid(), parts, weights, whole.numFeatures(), whole.numClasses())
    return GBTClassificationModel(whole.copyValues(short, jvm.org.apache.spark.ml.param.ParamMap()))
