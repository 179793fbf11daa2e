"""Binary-classification metrics as aggregates; scores are counted per value before anything is ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.plans.ordered import running_totals


def score_totals(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives, negatives and their totals through this score (ascending).

    Rows without a label or score have no rank and are left out.
    """
    counted = (
        df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("score").isNotNull() & F.col("_label").isNotNull())
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("_label") == 1).alias("pos"), F.count_if(F.col("_label") == 0).alias("neg"))
    )
    return running_totals(counted, order=["score"], sums=["pos", "neg"], by=by)


def _auc() -> Column:
    won = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    return F.try_divide(F.sum(won), F.max(F.col("pos_total").cast("double") * F.col("neg_total")))


def auc_from_totals(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank-sum ROC-AUC with ties counted half; null when one class is missing."""
    return totals.groupBy(*by).agg(
        F.max("pos_total").alias("positives"), F.max("neg_total").alias("negatives"), _auc().alias("roc_auc")
    )


def _hits() -> tuple[Column, Column]:
    """True and false positives when everything from this score upwards is called positive."""
    return (
        F.col("pos_total") - F.col("pos_upto") + F.col("pos"),
        F.col("neg_total") - F.col("neg_upto") + F.col("neg"),
    )


def _average_precision() -> Column:
    hits, false_alarms = _hits()
    return F.try_divide(F.sum(F.col("pos") * (hits / (hits + false_alarms))), F.max("pos_total"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """positives, negatives, roc_auc."""
    return auc_from_totals(score_totals(df, label, score))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Step-wise area under precision-recall: sum of precision times the gain in recall."""
    return score_totals(df, label, score).agg(_average_precision().alias("average_precision"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """threshold, fpr, tpr for every distinct score; a null threshold stands for the origin (nothing positive)."""
    hits, false_alarms = _hits()
    points = score_totals(df, label, score).select(
        F.col("score").alias("threshold"),
        F.try_divide(false_alarms, F.col("neg_total")).alias("fpr"),
        F.try_divide(hits, F.col("pos_total")).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def f1_accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """f1 and accuracy of 0/1 predictions, from four counts of one pass."""
    truth, guess = F.col(label).cast("int"), F.col(predicted).cast("int")
    counts = df.agg(
        F.count_if((truth == 1) & (guess == 1)).alias("tp"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.count_if((truth == 0) & (guess == 0)).alias("tn"),
    )
    return counts.select(
        F.coalesce(F.try_divide(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")), F.lit(0.0)).alias("f1"),
        F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """label, predicted, n for every cell, absent cells as 0."""
    truth, guess = F.col(label).cast("int"), F.col(predicted).cast("int")
    cells = [(a, b) for a in classes for b in classes]
    totals = df.agg(*[F.count_if((truth == a) & (guess == b)).alias(f"_{i}") for i, (a, b) in enumerate(cells)])
    lines = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("predicted"), F.col(f"_{i}").alias("n")) for i, (a, b) in enumerate(cells)
    ]
    return totals.select(F.inline(F.array(*lines)))


def classification_report(df: DataFrame, label: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted averages."""
    truth, guess = F.col(label).cast("int"), F.col(predicted).cast("int")
    counts = df.agg(
        F.count_if(truth == guess).alias("_right"),
        F.count_if(truth.isNotNull() & guess.isNotNull()).alias("_all"),
        *[F.count_if((truth == c) & (guess == c)).alias(f"_hit_{c}") for c in classes],
        *[F.count_if(guess == c).alias(f"_guessed_{c}") for c in classes],
        *[F.count_if(truth == c).alias(f"_support_{c}") for c in classes],
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    quality = {}
    for c in classes:
        hit, guessed, support = F.col(f"_hit_{c}"), F.col(f"_guessed_{c}"), F.col(f"_support_{c}")
        quality[c] = (ratio(hit, guessed), ratio(hit, support), ratio(hit * 2, guessed + support), support)

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def mean(k: int) -> Column:
        return sum((quality[c][k] for c in classes), F.lit(0.0)) / len(classes)

    def weighted(k: int) -> Column:
        return ratio(sum((quality[c][k] * quality[c][3] for c in classes), F.lit(0.0)), F.col("_all"))

    accuracy = ratio(F.col("_right"), F.col("_all"))
    lines = [line(str(c), *quality[c]) for c in classes]
    lines.append(line("accuracy", accuracy, accuracy, accuracy, F.col("_all")))
    lines.append(line("macro avg", mean(0), mean(1), mean(2), F.col("_all")))
    lines.append(line("weighted avg", weighted(0), weighted(1), weighted(2), F.col("_all")))
    return counts.select(F.inline(F.array(*lines)))


def evaluate(
    df: DataFrame, label: str, probability: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """roc_auc, pr_auc, f1 and accuracy (per group of ``by``), all from one ordered count of the scores."""
    above = F.col("score") >= threshold
    tp, fp = (F.sum(F.when(above, F.col(c)).otherwise(0)) for c in ("pos", "neg"))
    positives, negatives = F.max("pos_total"), F.max("neg_total")
    return (
        score_totals(df, label, probability, by)
        .groupBy(*by)
        .agg(
            _auc().alias("roc_auc"),
            _average_precision().alias("pr_auc"),
            F.coalesce(F.try_divide(tp * 2, tp + fp + positives), F.lit(0.0)).alias("f1"),
            F.try_divide(tp + negatives - fp, positives + negatives).alias("accuracy"),
        )
    )


def compare_metrics(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("with", "without")) -> DataFrame:
    """metric, both values and their difference, for two (metric, value) tables."""
    a, b = names
    return (
        left.select("metric", F.col("value").alias(a))
        .join(right.select("metric", F.col("value").alias(b)), "metric", "full_outer")
        .withColumn("difference", F.col(b) - F.col(a))
    )
