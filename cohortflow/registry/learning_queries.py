"""Encoding, splitting, metrics, run tracking, training, registry and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.learning import encode, metrics, runs, split
from cohortflow.learning.model_registry import ModelRegistry, batch_score, champion_gate, inference_check, schema_check
from cohortflow.learning.train import (
    BoosterParams,
    FeatureColumns,
    ablate_feature,
    evaluate_splits,
    feature_importance,
    metric_rows,
    train_gbt,
)
from cohortflow.operators.quality import assert_probability
from cohortflow.plans.lineage import materialise_evenly, scratch_path, stored
from cohortflow.registry.bindings import table, view, with_views
from cohortflow.registry.profile_queries import rounded
from cohortflow.sources.json_files import infer_schema, read_json, write_json

KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]

# --- encoding and splitting --------------------------------------------------------------------------

ENCODED = ["drug_name", "ae_type", "outcome"]


def _encoded(spark: SparkSession, d: str) -> DataFrame:
    """Codes fitted on the severe events only, so that some values of the rest may be unseen."""
    events = view(spark, d, "b_events").select(*KEYS, "severity", *ENCODED)
    codes = encode.fit_ordinal(events.filter("severity <> 'Severe'"), ENCODED)
    return encode.ordinal_encode(events, codes, ENCODED)


ENCODED_SQL = f"""SELECT {', '.join('e.' + k for k in KEYS)}, e.severity, {', '.join(f'coalesce({c}_codes.code, -1) AS {c}' for c in ENCODED)} FROM b_events e """ + " ".join(
    f"LEFT JOIN (SELECT {c}, dense_rank() OVER (ORDER BY {c}) AS code FROM (SELECT DISTINCT {c} FROM b_events WHERE severity <> 'Severe')) {c}_codes ON e.{c} = {c}_codes.{c}"
    for c in ENCODED
)
#: A hash both engines can compute; ids stay below the range where the product would overflow.
HASH = "((o_orderkey % 1073741824) * 2654435761) % 4294967296"


def _split(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderkey", "o_orderstatus", hashed=F.expr(HASH))


SPLIT_SQL = f"""SELECT o_orderkey, o_orderstatus, CASE WHEN nth <= floor(n * CAST(0.7 AS DOUBLE) + CAST(0.5 AS DOUBLE)) THEN 'train'
  WHEN nth <= floor(n * CAST(0.85 AS DOUBLE) + CAST(0.5 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH}, o_orderkey) AS nth,
  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)"""
REPORT_SQL = f"""SELECT split, o_orderstatus, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS share,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY split) AS DOUBLE), 9) AS share_in_split FROM ({SPLIT_SQL}) GROUP BY split, o_orderstatus"""
FEATURES_SQL = "SELECT ae_type, concomitant_drug, days_on_treatment, dosage_mg, CAST(drug_interaction_flag AS INT) AS drug_interaction_flag, drug_name, CAST(serious AS INT) AS label FROM b_events"
DROPPED = [*KEYS, "patient_id", "trial_id", "onset_date", "outcome", "severity", "risk_score"]


def _features(spark: SparkSession, d: str) -> DataFrame:
    return encode.bool_to_int(encode.select_features(view(spark, d, "b_events"), "serious", DROPPED))


# --- metrics on a fixed score ------------------------------------------------------------------------


def _scores(spark: SparkSession, d: str) -> DataFrame:
    events = view(spark, d, "b_events")
    score = F.col("risk_score") / 6
    return events.select(F.col("serious").cast("int").alias("label"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


SCORED = "SELECT CAST(serious AS INT) AS label, risk_score / 6 AS score, CAST(risk_score / 6 >= 0.5 AS INT) AS predicted FROM b_events"
CURVE = """SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n
FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score)"""


def _metric_sql(text: str) -> str:
    return with_views(text, scored=SCORED, curve=CURVE)


AUC_SQL = """SELECT CAST(any_value(p) AS BIGINT) AS positives, CAST(any_value(n) AS BIGINT) AS negatives,
  round(sum(pos * (n - fp + neg / CAST(2 AS DOUBLE))) / (CAST(any_value(p) AS DOUBLE) * any_value(n)), 9) AS roc_auc FROM curve"""
AP_SQL = "SELECT round(sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / any_value(p), 9) AS average_precision FROM curve"
ROC_SQL = """SELECT round(score, 9) AS threshold, round(fp / CAST(n AS DOUBLE), 9) AS fpr, round(tp / CAST(p AS DOUBLE), 9) AS tpr FROM curve
UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)"""
CELLS = """SELECT count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn, count(*) FILTER (WHERE label = 0 AND predicted = 0) AS tn, CAST(count(*) AS DOUBLE) AS total FROM scored"""
F1_SQL = f"SELECT round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 9) AS f1, round((tp + tn) / total, 9) AS accuracy FROM ({CELLS})"
CONFUSION_SQL = """SELECT a AS label, b AS predicted, count(scored.label) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, b)
LEFT JOIN scored ON scored.label = a AND scored.predicted = b GROUP BY a, b"""
CLASSES = f"""SELECT '0' AS class, tn / CAST(tn + fn AS DOUBLE) AS precision, tn / CAST(tn + fp AS DOUBLE) AS recall, tn + fp AS support, total FROM ({CELLS})
UNION ALL SELECT '1', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE), tp + fn, total FROM ({CELLS})"""
CLASSES_F1 = f"SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM ({CLASSES})"
CLASSIFICATION_SQL = f"""SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM ({CLASSES_F1})
UNION ALL SELECT 'accuracy', round((tp + tn) / total, 9), round((tp + tn) / total, 9), round((tp + tn) / total, 9), CAST(total AS BIGINT) FROM ({CELLS})
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM ({CLASSES_F1})
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / any_value(total), 9), round(sum(recall * support) / any_value(total), 9),
  round(sum(f1 * support) / any_value(total), 9), CAST(sum(support) AS BIGINT) FROM ({CLASSES_F1})"""


def _compared(spark: SparkSession, d: str) -> DataFrame:
    """Group means as metrics: severe events next to mild ones."""
    events = view(spark, d, "b_events")

    def means(severity: str) -> DataFrame:
        means = events.filter(F.col("severity") == severity).agg(
            F.round(F.avg("risk_score"), 6).alias("risk_score"), F.round(F.avg("dosage_mg"), 6).alias("dosage_mg")
        )
        return means.unpivot([], ["risk_score", "dosage_mg"], "metric", "value")

    return rounded(metrics.compare_metrics(means("Severe"), means("Mild"), ("severe", "mild")), 6, "severe", "mild", "difference")


COMPARED_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS metric, severe, mild, round(mild - severe, 6) AS difference FROM (
  SELECT round(avg({c}) FILTER (WHERE severity = 'Severe'), 6) AS severe, round(avg({c}) FILTER (WHERE severity = 'Mild'), 6) AS mild FROM b_events)"""
    for c in ("risk_score", "dosage_mg")
)


def _best(spark: SparkSession, d: str) -> DataFrame:
    """Every order as a run of its customer, its price as the metric."""
    as_runs = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("name"),
        F.create_map(F.lit("total"), "o_totalprice").alias("metrics"),
    )
    return runs.best_run_by_metric(as_runs, "total")


BEST_SQL = """SELECT o_custkey AS name, o_orderkey AS run_id, o_totalprice AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS nth FROM orders) WHERE nth = 1"""

# --- training ----------------------------------------------------------------------------------------

RAW = ["drug_name", "ae_type", "concomitant_drug", "dosage_mg", "days_on_treatment", "risk_score", "drug_interaction_flag"]


def _labelled(spark: SparkSession, d: str, leak: bool) -> tuple[DataFrame, FeatureColumns]:
    """All events with a row id, a 0/1 label and their split, materialised once for the many passes of a fit."""
    row_id = F.xxhash64(*KEYS, "onset_date", "dosage_mg", "risk_score")
    rows = view(spark, d, "b_events").select(row_id.alias("row_id"), *RAW, F.col("serious").cast("int").alias("label"))
    rows = materialise_evenly(split.hash_split(rows, "row_id"), "row_id")
    ignored = ["row_id", "label", "split"] + ([] if leak else ["risk_score"])
    return rows, FeatureColumns.of(rows, ignored)


def _train(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of a fit without the leaking score."""
    rows, features = _labelled(spark, d, leak=False)
    return metric_rows(rows, evaluate_splits(train_gbt(rows, "label", features), rows, "label"))


def _importance(spark: SparkSession, d: str) -> DataFrame:
    rows, features = _labelled(spark, d, leak=True)
    return feature_importance(train_gbt(rows, "label", features), rows, features)


def _ablation(spark: SparkSession, d: str) -> DataFrame:
    rows, features = _labelled(spark, d, leak=True)
    return ablate_feature(rows, "label", features, "risk_score")


def _scored_rows(spark: SparkSession, d: str) -> DataFrame:
    rows, features = _labelled(spark, d, leak=False)
    scored = batch_score(train_gbt(rows, "label", features), rows)
    return assert_probability(scored, "predicted_probability").select("row_id", "predicted_probability", "predicted_class", "label")


def _gate(spark: SparkSession, d: str) -> DataFrame:
    """First version promotes, a weaker one challenges, the first again ties and promotes."""
    rows, features = _labelled(spark, d, leak=False)
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    strong = train_gbt(rows, "label", features)
    weak = train_gbt(rows, "label", FeatureColumns((), ["days_on_treatment"], ()), BoosterParams(trees=1, leaves=2))
    test = stored(rows.filter("split = 'test'").select(*features.names, "label"), "test")  # five scores read these, without all the rows
    decisions = [champion_gate(registry, "classifier", m, test, "label", rows.schema.json()) for m in (strong, weak, strong)]
    return decisions[0].unionByName(decisions[1]).unionByName(decisions[2])


def _inference(spark: SparkSession, d: str) -> DataFrame:
    rows, features = _labelled(spark, d, leak=False)
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    champion_gate(registry, "classifier", train_gbt(rows, "label", features), rows.filter("split = 'test'"), "label")
    return inference_check(registry, "classifier", rows, "label", "row_id", ["drug_name", "ae_type", "dosage_mg"])


def _schema_differences(spark: SparkSession, d: str) -> DataFrame:
    """The schema of the orders against the one inferred from all of them as JSON files."""
    orders = table(spark, d, "orders")
    path = write_json(orders, scratch_path(spark, "json"))
    return schema_check(orders.schema.json(), read_json(spark, path, infer_schema(spark, path, "*.json.gz", multi_line=False)))


QUERIES = {
    "ordinal_encode": (_encoded, with_views(ENCODED_SQL)),
    "bool_to_int": (
        lambda s, d: encode.bool_to_int(view(s, d, "b_events").select(*KEYS, "serious", "drug_interaction_flag")),
        with_views("SELECT l_orderkey, l_partkey, l_linenumber, CAST(serious AS INT) AS serious, CAST(drug_interaction_flag AS INT) AS drug_interaction_flag FROM b_events"),
    ),
    "select_features": (_features, with_views(FEATURES_SQL)),
    "stratified_split": (_split, SPLIT_SQL),
    "split_report": (lambda s, d: rounded(split.split_report(_split(s, d), "o_orderstatus"), 9, "share", "share_in_split"), REPORT_SQL),
    "roc_auc": (lambda s, d: rounded(metrics.roc_auc(_scores(s, d), "label", "score"), 9, "roc_auc"), _metric_sql(AUC_SQL)),
    "average_precision": (
        lambda s, d: rounded(metrics.average_precision(_scores(s, d), "label", "score"), 9, "average_precision"),
        _metric_sql(AP_SQL),
    ),
    "roc_curve": (lambda s, d: rounded(metrics.roc_curve(_scores(s, d), "label", "score"), 9, "threshold", "fpr", "tpr"), _metric_sql(ROC_SQL)),
    "f1_accuracy": (lambda s, d: rounded(metrics.f1_accuracy(_scores(s, d), "label", "predicted"), 9, "f1", "accuracy"), _metric_sql(F1_SQL)),
    "confusion_matrix": (lambda s, d: metrics.confusion_matrix(_scores(s, d), "label", "predicted"), _metric_sql(CONFUSION_SQL)),
    "classification_report": (
        lambda s, d: rounded(metrics.classification_report(_scores(s, d), "label", "predicted"), 9, "precision", "recall", "f1"),
        _metric_sql(CLASSIFICATION_SQL),
    ),
    "compare_metrics": (_compared, with_views(COMPARED_SQL)),
    "best_run_by_metric": (_best, BEST_SQL),
    "train_gbt": (_train, None),
    "feature_importance": (_importance, None),
    "ablate_feature": (_ablation, None),
    "batch_score": (_scored_rows, None),
    "champion_gate": (_gate, None),
    "inference_check": (_inference, None),
    "schema_check": (
        _schema_differences,
        """SELECT column_name AS "column", 'timestamp_ntz' AS expected, 'string' AS actual FROM (DESCRIBE orders)
WHERE column_type LIKE 'TIMESTAMP%'""",
    ),
}
