"""Profiling, value counts, correlations, histograms and the leakage screen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.operators import compare, profile, report
from cohortflow.operators.leakage import leakage_screen
from cohortflow.registry.bindings import rounded_sql, table, view, with_views

NUMBERS = ["dosage_mg", "days_on_treatment", "risk_score"]
CORRELATED = [*NUMBERS, "drug_interaction_flag", "serious"]
DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DICTIONARY = ["drug_name", "treatment_arm", "response"]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of the rows in the last bits; compare what does not."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _events(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "b_events")


def _rates(spark: SparkSession, d: str) -> DataFrame:
    events = _events(spark, d)
    parts = [
        rounded(report.rate_by_category(events, c, "serious"), 9, "rate", "overall_rate").select(
            F.lit(c).alias("category"), F.col(c).alias("value"), "n", "rate", "overall_rate"
        )
        for c in ("ae_type", "drug_name")
    ]
    return parts[0].unionByName(parts[1])


def _rate_sql(column: str) -> str:
    return f"""SELECT '{column}' AS category, {column} AS value, count(*) AS n, round(avg(CAST(serious AS INT)), 9) AS rate,
  round((SELECT avg(CAST(serious AS INT)) FROM b_events), 9) AS overall_rate FROM b_events GROUP BY {column}"""


def _nulls(spark: SparkSession, d: str) -> DataFrame:
    return profile.null_profile(view(spark, d, "b_results")).drop("type")


NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls FROM b_results"
    for c in (
        "l_orderkey", "l_partkey", "patient_id", "trial_id", "drug_name", "treatment_arm", "response", "visit_number", "visit_date", "dosage_mg",
        "blood_pressure_systolic", "blood_pressure_diastolic", "heart_rate_bpm", "alt_iu_l", "creatinine_mg_dl", "tumor_size_mm",
    )
)
DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, min({c}) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM lineitem"""
    for c in DESCRIBED
)


def _as_number(c: str) -> str:
    return f"CAST(CAST({c} AS INT) AS DOUBLE)" if c in ("drug_interaction_flag", "serious") else f"CAST({c} AS DOUBLE)"


CORRELATION_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({_as_number(a)}, {_as_number(b)}), 6) AS r FROM b_events"
    for a in CORRELATED
    for b in CORRELATED
)


def _typed(spark: SparkSession, d: str) -> DataFrame:
    """Type class of every column with the number of values it holds."""
    events = _events(spark, d)
    filled = profile.null_profile(events).select("column", (F.col("n_rows") - F.col("n_nulls")).alias("n_values"))
    return profile.columns_by_type(events).drop("type").join(filled, "column")


TYPED_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CASE WHEN any_value(typeof({c})) = 'VARCHAR' THEN 'categorical' WHEN any_value(typeof({c})) = 'BOOLEAN' THEN 'boolean'
  WHEN any_value(typeof({c})) IN ('INTEGER', 'BIGINT', 'DOUBLE') THEN 'numeric' ELSE 'other' END AS type_class, count({c}) AS n_values FROM b_events"""
    for c in (
        "l_orderkey", "l_partkey", "l_linenumber", "patient_id", "trial_id", "drug_name", "concomitant_drug", "ae_type", "severity",
        "serious", "outcome", "dosage_mg", "risk_score", "drug_interaction_flag", "onset_date", "days_on_treatment",
    )
)


SUMMARY_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", type_class, CASE WHEN '{c}' = 'serious' THEN 'target' ELSE 'feature' END AS role, (SELECT count(DISTINCT {c}) FROM b_events) AS n_values
FROM ({TYPED_SQL}) WHERE "column" = '{c}'"""
    for c in (
        "l_orderkey", "l_partkey", "l_linenumber", "patient_id", "trial_id", "drug_name", "concomitant_drug", "ae_type", "severity",
        "serious", "outcome", "dosage_mg", "risk_score", "drug_interaction_flag", "onset_date", "days_on_treatment",
    )
)


def _histograms(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.histogram_by_class(_events(spark, d), NUMBERS, "serious"), 9, "lower", "upper", "density")


def _histogram_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", serious, bin, round(low + bin * width, 9) AS lower, round(low + (bin + 1) * width, 9) AS upper,
  count(*) AS n, round(count(*) / (any_value(total) * width), 9) AS density
FROM (SELECT e.serious, low, total, (high - low) / 30 AS width, least(CAST(floor((CAST({c} AS DOUBLE) - low) / (high - low) * 30) AS BIGINT), 29) AS bin
  FROM b_events e JOIN (SELECT serious, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, count(*) AS total FROM b_events GROUP BY serious) r
  ON e.serious = r.serious) GROUP BY serious, bin, low, width"""


def _signal(spark: SparkSession, d: str) -> DataFrame:
    """Seven group means by severity after joining the patients to their events."""
    patients = view(spark, d, "b_patients").select("patient_id", "age", "bmi", "num_pre_existing", "baseline_alt_iu_l")
    merged = _events(spark, d).join(patients, "patient_id", "left")
    digits = {
        "age": 1, "bmi": 1, "dosage_mg": 1, "baseline_alt_iu_l": 1, "num_pre_existing": 2, "drug_interaction_flag": 3, "risk_score": 2,
    }
    return profile.means_by_group(merged, "severity", digits)


SIGNAL_SQL = f"""SELECT severity, {rounded_sql('avg(age)', 1)} AS mean_age, {rounded_sql('avg(bmi)', 1)} AS mean_bmi, {rounded_sql('avg(dosage_mg)', 1)} AS mean_dosage_mg,
  {rounded_sql('avg(baseline_alt_iu_l)', 1)} AS mean_baseline_alt_iu_l, {rounded_sql('avg(num_pre_existing)', 2)} AS mean_num_pre_existing,
  {rounded_sql('avg(CAST(drug_interaction_flag AS INT))', 3)} AS mean_drug_interaction_flag, {rounded_sql('avg(risk_score)', 2)} AS mean_risk_score
FROM b_events e LEFT JOIN b_patients p ON e.patient_id = p.patient_id GROUP BY severity"""


def _screen(spark: SparkSession, d: str) -> DataFrame:
    """All columns but the label, the keys and the date."""
    events = _events(spark, d)
    features = events.drop("serious", "l_orderkey", "l_partkey", "l_linenumber", "patient_id", "trial_id", "onset_date")
    numbers = [*profile.names_of_type(features, "numeric"), *profile.names_of_type(features, "boolean")]
    screened = leakage_screen(events, "serious", numbers, profile.names_of_type(features, "categorical"))
    return rounded(screened, 6, "correlation", "auc", "min_rate", "max_rate")


def _auc_sql(c: str) -> str:
    return f"""(SELECT greatest(a, 1 - a) FROM (SELECT
  (sum(CASE WHEN s = 1 THEN r END) - count(*) FILTER (WHERE s = 1) * (count(*) FILTER (WHERE s = 1) + 1) / 2.0)
  / (CAST(count(*) FILTER (WHERE s = 1) AS DOUBLE) * count(*) FILTER (WHERE s = 0)) AS a
  FROM (SELECT CAST(serious AS INT) AS s, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r FROM b_events)))"""


SCREEN_SQL = " UNION ALL ".join(
    [
        f"""SELECT feature, kind, round(correlation, 6) AS correlation, round(auc, 6) AS auc, CAST(NULL AS DOUBLE) AS min_rate,
  CAST(NULL AS DOUBLE) AS max_rate, correlation > 0.6 OR auc > 0.95 AS suspicious
FROM (SELECT '{c}' AS feature, 'numeric' AS kind, abs(corr(CAST({c} AS DOUBLE), CAST(CAST(serious AS INT) AS DOUBLE))) AS correlation, {_auc_sql(c)} AS auc FROM b_events)"""
        for c in (*NUMBERS, "drug_interaction_flag")
    ]
    + [
        f"""SELECT '{c}' AS feature, 'categorical' AS kind, CAST(NULL AS DOUBLE) AS correlation, CAST(NULL AS DOUBLE) AS auc,
  round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate, max(rate) >= 0.99 OR min(rate) <= 0.01 AS suspicious
FROM (SELECT {c}, avg(CAST(serious AS INT)) AS rate FROM b_events GROUP BY {c})"""
        for c in ("severity", "ae_type", "drug_name", "concomitant_drug", "outcome")
    ]
)
DICTIONARY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM b_results GROUP BY {c}" for c in DICTIONARY
)


def _snapshot_result(spark: SparkSession, d: str) -> DataFrame:
    """Counts per status: the given orders against the same with two statuses merged."""
    orders = table(spark, d, "orders")
    actual = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    merged = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    expected = orders.groupBy(merged.alias("o_orderstatus")).agg(F.count("*").alias("n"))
    return compare.result_diff(actual, expected)


DIFF_SQL = """
WITH a AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
 b AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderstatus, n, 'actual only' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT o_orderstatus, n, 'expected only', CAST(1 AS BIGINT) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""

QUERIES = {
    "rate_by_category": (_rates, with_views(_rate_sql("ae_type") + " UNION ALL " + _rate_sql("drug_name"))),
    "value_counts": (
        lambda s, d: rounded(report.value_counts(_events(s, d), "severity"), 9, "share"),
        with_views("SELECT severity, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM b_events), 9) AS share FROM b_events GROUP BY severity"),
    ),
    "class_ratio": (
        lambda s, d: rounded(report.class_ratio(_events(s, d), "serious"), 9, "ratio"),
        with_views(
            """SELECT count(*) FILTER (WHERE NOT serious) AS negatives, count(*) FILTER (WHERE serious) AS positives,
  round(CAST(count(*) FILTER (WHERE NOT serious) AS DOUBLE) / count(*) FILTER (WHERE serious), 9) AS ratio FROM b_events"""
        ),
    ),
    "null_profile": (_nulls, with_views(NULLS_SQL)),
    "describe_numeric": (
        lambda s, d: rounded(profile.describe_numeric(table(s, d, "lineitem"), DESCRIBED), 6, "mean", "sd", "q25", "q50", "q75"),
        DESCRIBE_SQL,
    ),
    "describe_numeric_sketch": (
        lambda s, d: profile.describe_numeric(table(s, d, "lineitem"), DESCRIBED, exact=False),
        None,
    ),
    "correlation_matrix": (
        lambda s, d: rounded(profile.correlation_matrix(_events(s, d), CORRELATED), 6, "r"),
        with_views(CORRELATION_SQL),
    ),
    "histogram_by_class": (_histograms, with_views(" UNION ALL ".join(map(_histogram_sql, NUMBERS)))),
    "signal_check_by_severity": (_signal, with_views(SIGNAL_SQL)),
    "feature_summary": (lambda s, d: profile.feature_summary(_events(s, d), "serious"), None),
    "feature_summary_exact": (lambda s, d: profile.feature_summary(_events(s, d), "serious", exact=True), with_views(SUMMARY_SQL)),
    "columns_by_type": (_typed, with_views(TYPED_SQL)),
    "leakage_screen": (_screen, with_views(SCREEN_SQL)),
    "value_dictionary": (lambda s, d: profile.value_dictionary(view(s, d, "b_results"), DICTIONARY), with_views(DICTIONARY_SQL)),
    "result_diff": (_snapshot_result, DIFF_SQL),
    "sample_head": (
        lambda s, d: compare.sample_head(table(s, d, "orders"), ["o_orderdate", "o_orderkey"], 10),
        "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10",
    ),
    "top_k_by_measure": (
        lambda s, d: report.top_k(
            report.group_report(table(s, d, "lineitem"), ["l_partkey"], total="n", means={"avg_quantity": ("l_quantity", 4)}), "avg_quantity", 10, ["l_partkey"]
        ),
        f"SELECT l_partkey, count(*) AS n, {rounded_sql('avg(l_quantity)', 4)} AS avg_quantity FROM lineitem GROUP BY 1 ORDER BY avg_quantity DESC, l_partkey LIMIT 10",
    ),
}
