"""Silver and gold tables, joins, latest rows and quality rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cohortflow.clinical import gold
from cohortflow.clinical.silver import ADVERSE_EVENTS, CLINICAL_TRIALS, PATIENTS, SILVER_TABLES, TRIAL_RESULTS, SilverTable, to_silver, typed_columns
from cohortflow.operators import joins, quality, report
from cohortflow.operators.latest import latest_per_group
from cohortflow.registry.bindings import LATEST, rounded_sql, table, view, with_views

# --- gold -----------------------------------------------------------------------------------------

SAFETY_SQL = f"""
SELECT e.*, t.trial_name, t.phase, t.sponsor, t.indication FROM (
  SELECT trial_id, drug_name, count(*) AS total_adverse_events,
    count(*) FILTER (WHERE serious) AS serious_event_count,
    count(*) FILTER (WHERE severity = 'Severe') AS severe_count,
    count(*) FILTER (WHERE severity = 'Moderate') AS moderate_count,
    count(*) FILTER (WHERE severity = 'Mild') AS mild_count,
    count(*) FILTER (WHERE drug_interaction_flag) AS drug_interaction_count,
    count(*) FILTER (WHERE outcome = 'Fatal') AS fatal_outcome_count,
    {rounded_sql('avg(risk_score)', 2)} AS avg_risk_score
  FROM b_events GROUP BY trial_id, drug_name) e
LEFT JOIN b_trials t ON e.trial_id = t.trial_id"""
EFFICACY_SQL = f"""
SELECT e.*, t.trial_name, t.phase, t.sponsor, t.indication FROM (
  SELECT drug_name, treatment_arm, trial_id, count(*) AS total_observations,
    count(*) FILTER (WHERE response = 'Complete Response') AS complete_response_count,
    count(*) FILTER (WHERE response = 'Partial Response') AS partial_response_count,
    count(*) FILTER (WHERE response = 'Stable Disease') AS stable_disease_count,
    count(*) FILTER (WHERE response = 'Progressive Disease') AS progressive_disease_count,
    {rounded_sql('avg(blood_pressure_systolic)', 1)} AS avg_systolic_bp, {rounded_sql('avg(heart_rate_bpm)', 1)} AS avg_heart_rate,
    {rounded_sql('avg(alt_iu_l)', 1)} AS avg_alt, {rounded_sql('avg(creatinine_mg_dl)', 2)} AS avg_creatinine
  FROM b_results GROUP BY drug_name, treatment_arm, trial_id) e
LEFT JOIN b_trials t ON e.trial_id = t.trial_id"""
LATEST_SQL = f"""
SELECT * EXCLUDE (_nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id, trial_id ORDER BY {', '.join(f'{c} DESC' for c in LATEST)}) AS _nth
  FROM b_results) WHERE _nth = 1"""
COUNTS_SQL = """
SELECT patient_id, trial_id, count(*) AS adverse_event_count, count(*) FILTER (WHERE serious) AS serious_ae_count
FROM b_events GROUP BY patient_id, trial_id"""
OUTCOMES_SQL = f"""
SELECT r.patient_id, r.trial_id, {', '.join('r.' + c for c in gold.VISIT_COLUMNS)},
  {', '.join('p.' + c for c in gold.PATIENT_COLUMNS)}, c.adverse_event_count, c.serious_ae_count
FROM ({LATEST_SQL}) r LEFT JOIN b_patients p ON r.patient_id = p.patient_id
LEFT JOIN ({COUNTS_SQL}) c ON r.patient_id = c.patient_id AND r.trial_id = c.trial_id"""
GOLD_SQL = {
    "gold_trial_safety_summary": SAFETY_SQL,
    "gold_drug_efficacy": EFFICACY_SQL,
    "gold_patient_outcomes": OUTCOMES_SQL,
}


def gold_safety(spark: SparkSession, d: str) -> DataFrame:
    return gold.trial_safety_summary(view(spark, d, "b_events"), view(spark, d, "b_trials"))


def gold_efficacy(spark: SparkSession, d: str) -> DataFrame:
    return gold.drug_efficacy(view(spark, d, "b_results"), view(spark, d, "b_trials"))


def gold_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return gold.patient_outcomes(
        view(spark, d, "b_results"), view(spark, d, "b_patients"), view(spark, d, "b_events"), LATEST
    )


def gold_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "gold_trial_safety_summary": gold_safety(spark, d),
        "gold_drug_efficacy": gold_efficacy(spark, d),
        "gold_patient_outcomes": gold_outcomes(spark, d),
    }


# --- silver over raw rows: ids as text, dates as text with some bad ones, some missing keys ----------

RAW_SQL = {
    "raw_adverse_events": """
SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE concat('AE-', CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string)) END AS event_id,
  CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE concat('PAT-', CAST(patient_id AS string)) END AS patient_id,
  concat('TRIAL-', CAST(trial_id AS string)) AS trial_id, drug_name, ae_type, severity, serious,
  CASE WHEN l_orderkey % 97 = 0 THEN 'bad' ELSE CAST(onset_date AS string) END AS onset_date, outcome,
  CASE l_linenumber % 4 WHEN 0 THEN 'Physician' WHEN 1 THEN 'Patient' WHEN 2 THEN 'Nurse' ELSE 'Pharmacist' END AS reported_by,
  dosage_mg, days_on_treatment, risk_score, drug_interaction_flag, concomitant_drug
FROM {b_events}""",
    "raw_clinical_trials": """
SELECT CASE WHEN trial_id % 7 = 0 THEN NULL ELSE concat('TRIAL-', CAST(trial_id AS string)) END AS trial_id, trial_name,
  CASE WHEN trial_id % 11 = 0 THEN NULL ELSE drug_name END AS drug_name, indication, phase, sponsor,
  'Active' AS status, trial_id % 18 + 3 AS sites, trial_id % 400 + 100 AS target_enrollment,
  concat('2020-01-', lpad(CAST(trial_id % 28 + 1 AS string), 2, '0')) AS start_date,
  CASE WHEN trial_id % 13 = 0 THEN 'bad' ELSE '2024-06-30' END AS end_date
FROM {b_trials}""",
    "raw_patients": """
SELECT CASE WHEN patient_id % 101 = 0 THEN NULL ELSE concat('PAT-', CAST(patient_id AS string)) END AS patient_id,
  CASE WHEN patient_id % 53 = 0 THEN 0 WHEN patient_id % 59 = 0 THEN NULL ELSE age END AS age, gender, 'A+' AS blood_type, region, bmi,
  CAST(150 + patient_id % 50 AS double) AS height_cm, CAST(50 + patient_id % 60 AS double) AS weight_kg, num_pre_existing,
  baseline_creatinine_mg_dl, baseline_alt_iu_l, '2021-03-04' AS enrollment_date
FROM {b_patients}""",
    "raw_trial_results": """
SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE concat('RES-', CAST(l_orderkey AS string), '-', CAST(visit_number AS string)) END AS result_id,
  CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE concat('PAT-', CAST(patient_id AS string)) END AS patient_id,
  concat('TRIAL-', CAST(trial_id AS string)) AS trial_id, drug_name, treatment_arm, response, visit_number,
  CASE WHEN l_orderkey % 97 = 0 THEN 'bad' ELSE CAST(visit_date AS string) END AS visit_date, dosage_mg,
  blood_pressure_systolic, blood_pressure_diastolic, heart_rate_bpm, alt_iu_l, creatinine_mg_dl, tumor_size_mm
FROM {b_results}""",
}


def raw_rows(spark: SparkSession, d: str, name: str) -> DataFrame:
    source = {"raw_adverse_events": "b_events", "raw_clinical_trials": "b_trials", "raw_patients": "b_patients", "raw_trial_results": "b_results"}[name]
    rows = spark.sql(RAW_SQL[name], **{source: view(spark, d, source)})
    if name == "raw_patients":
        rows = rows.withColumn("pre_existing_conditions", F.array(F.lit("None")))
    return rows


def raw_sql(name: str) -> str:
    return RAW_SQL[name].format(b_events="b_events", b_trials="b_trials", b_patients="b_patients", b_results="b_results")


def _bronze(spark: SparkSession, d: str, silver: SilverTable) -> DataFrame:
    return raw_rows(spark, d, f"raw_{silver.entity}").withColumn("_ingestion_timestamp", F.current_timestamp())


def _silver(silver: SilverTable):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return to_silver(_bronze(spark, d, silver), silver).drop("_ingestion_timestamp", "pre_existing_conditions")

    return run


def _silver_sql(silver: SilverTable) -> str:
    columns = [c for c in silver.columns if c not in ("_ingestion_timestamp", "pre_existing_conditions")]
    shown = [f"TRY_CAST({c} AS date) AS {c}" if c in silver.dates else c for c in columns]
    kept = " AND ".join(f"({r.predicate})" for r in silver.rules if r.action == "drop")
    return with_views(f"SELECT {', '.join(shown)} FROM raw_{silver.entity} WHERE {kept}", **{f"raw_{silver.entity}": raw_sql(f"raw_{silver.entity}")})


def _expect_or_drop(spark: SparkSession, d: str) -> DataFrame:
    return quality.expect_or_drop(raw_rows(spark, d, "raw_adverse_events"), ADVERSE_EVENTS.rules)


def _warned(spark: SparkSession, d: str) -> DataFrame:
    """Violations of the warn rules, counted while the kept rows are written."""
    found = []
    for silver in (ADVERSE_EVENTS, TRIAL_RESULTS):
        counts = Observation()
        kept = quality.expect_warn(to_silver(_bronze(spark, d, silver), silver), silver.rules, counts)
        kept.write.format("noop").mode("overwrite").save()
        seen = counts.get
        found += [(silver.name, r.name, seen["rows"] - seen[r.name], seen[r.name]) for r in silver.rules if r.action == "warn"]
    return spark.createDataFrame(found, "table string, rule string, passed long, failed long")


def _probabilities(spark: SparkSession, d: str) -> DataFrame:
    """All events with a score that the job itself checks to be a probability."""
    events = view(spark, d, "b_events")
    scored = events.select("l_orderkey", "l_partkey", "l_linenumber", (F.col("risk_score") / 6).alias("p"))
    return quality.assert_probability(scored, "p")


def _quality(spark: SparkSession, d: str) -> DataFrame:
    """All rules of all four tables."""
    parts = [
        quality.quality_report(typed_columns(_bronze(spark, d, t), t), t.rules).select(F.lit(t.name).alias("table"), "*") for t in SILVER_TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def _rule_sql(silver: SilverTable, rule: quality.Expectation) -> str:
    typed = f" REPLACE ({', '.join(f'TRY_CAST({c} AS date) AS {c}' for c in silver.dates)})" if silver.dates else ""
    failed = f"count(*) FILTER (WHERE NOT coalesce({rule.predicate}, false))"
    dropped = failed if rule.action == "drop" else "CAST(0 AS BIGINT)"
    return (
        f"""SELECT '{silver.name}' AS "table", '{rule.name}' AS rule, '{rule.action}' AS action, count(*) - {failed} AS passed, {failed} AS failed,
  {dropped} AS dropped FROM (SELECT *{typed} FROM raw_{silver.entity})"""
    )


QUALITY_SQL = " UNION ALL ".join(_rule_sql(t, r) for t in SILVER_TABLES for r in t.rules)
WARN_SQL = """
SELECT 'silver_adverse_events' AS "table", 'valid_onset_date' AS rule,
  count(*) FILTER (WHERE onset_date <> 'bad') AS passed, count(*) FILTER (WHERE onset_date = 'bad') AS failed
FROM raw_adverse_events WHERE event_id IS NOT NULL AND patient_id IS NOT NULL
UNION ALL
SELECT 'silver_trial_results', 'valid_vitals',
  count(*) FILTER (WHERE blood_pressure_systolic > 0 AND heart_rate_bpm > 0),
  count(*) FILTER (WHERE NOT (blood_pressure_systolic > 0 AND heart_rate_bpm > 0))
FROM raw_trial_results WHERE result_id IS NOT NULL AND patient_id IS NOT NULL"""


# --- joins and grouped reports ----------------------------------------------------------------------


def _dim_left(spark: SparkSession, d: str) -> DataFrame:
    """Every line with its trial; trials of one phase are left out, so some facts have no partner."""
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("trial_id"))
    trials = view(spark, d, "b_trials").filter("phase <> 'Phase IV'")
    return joins.join_dim(facts, trials, ["trial_id"], ["trial_name", "phase"])


def _composite(spark: SparkSession, d: str) -> DataFrame:
    visits = view(spark, d, "b_results").select("patient_id", "trial_id", "l_orderkey", "visit_number")
    return joins.join_dim_salted(
        visits, gold.event_counts(view(spark, d, "b_events")), ["patient_id", "trial_id"], ["adverse_event_count", "serious_ae_count"]
    )


def _severity(spark: SparkSession, d: str) -> DataFrame:
    events = view(spark, d, "b_events")
    return report.group_report(
        events, ["ae_type"], total="total", counts={name: F.col("severity") == s for name, s in gold.SEVERITY_COUNTS.items()}
    )


def _means(spark: SparkSession, d: str) -> DataFrame:
    return report.group_report(view(spark, d, "b_results"), ["drug_name", "treatment_arm"], means=gold.VISIT_MEANS)


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_group(view(spark, d, "b_results"), ["patient_id", "trial_id"], LATEST)


QUERIES = {
    "gold_trial_safety_summary": (gold_safety, with_views(SAFETY_SQL)),
    "gold_patient_outcomes": (gold_outcomes, with_views(OUTCOMES_SQL)),
    "gold_drug_efficacy": (gold_efficacy, with_views(EFFICACY_SQL)),
    **{s.name: (_silver(s), _silver_sql(s)) for s in (ADVERSE_EVENTS, CLINICAL_TRIALS, PATIENTS, TRIAL_RESULTS)},
    "expect_or_drop": (
        _expect_or_drop,
        with_views(
            "SELECT * FROM raw_adverse_events WHERE event_id IS NOT NULL AND patient_id IS NOT NULL",
            raw_adverse_events=raw_sql("raw_adverse_events"),
        ),
    ),
    "expect_warn": (
        _warned,
        with_views(WARN_SQL, raw_adverse_events=raw_sql("raw_adverse_events"), raw_trial_results=raw_sql("raw_trial_results")),
    ),
    "quality_report": (
        _quality,
        with_views(QUALITY_SQL, **{f"raw_{t.entity}": raw_sql(f"raw_{t.entity}") for t in SILVER_TABLES}),
    ),
    "assert_probability": (
        _probabilities,
        with_views("SELECT l_orderkey, l_partkey, l_linenumber, risk_score / 6 AS p FROM b_events"),
    ),
    "join_dim_left": (
        _dim_left,
        with_views(
            """SELECT l_orderkey, l_linenumber, l_suppkey AS trial_id, t.trial_name, t.phase
FROM lineitem LEFT JOIN (SELECT * FROM b_trials WHERE phase <> 'Phase IV') t ON l_suppkey = t.trial_id"""
        ),
    ),
    "join_composite_left": (
        _composite,
        with_views(
            f"""SELECT r.patient_id, r.trial_id, r.l_orderkey, r.visit_number, c.adverse_event_count, c.serious_ae_count
FROM b_results r LEFT JOIN ({COUNTS_SQL}) c ON r.patient_id = c.patient_id AND r.trial_id = c.trial_id"""
        ),
    ),
    "severity_breakdown": (
        _severity,
        with_views(
            """SELECT ae_type, count(*) AS total, count(*) FILTER (WHERE severity = 'Severe') AS severe_count,
  count(*) FILTER (WHERE severity = 'Moderate') AS moderate_count, count(*) FILTER (WHERE severity = 'Mild') AS mild_count
FROM b_events GROUP BY ae_type"""
        ),
    ),
    "rounded_means": (
        _means,
        with_views(
            f"""SELECT drug_name, treatment_arm, {rounded_sql('avg(blood_pressure_systolic)', 1)} AS avg_systolic_bp,
  {rounded_sql('avg(heart_rate_bpm)', 1)} AS avg_heart_rate, {rounded_sql('avg(alt_iu_l)', 1)} AS avg_alt, {rounded_sql('avg(creatinine_mg_dl)', 2)} AS avg_creatinine
FROM b_results GROUP BY drug_name, treatment_arm"""
        ),
    ),
    "latest_per_group": (_latest, with_views(LATEST_SQL)),
}
