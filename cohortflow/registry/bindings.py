"""The clinical tables as views over the given star schema.

The same SQL runs in Spark (on DataFrames) and in DuckDB (as common table expressions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIALS = """
SELECT s_suppkey AS trial_id, s_name AS trial_name,
  concat('Drug-', CAST(s_suppkey % 15 AS string)) AS drug_name,
  n_name AS indication, r_name AS sponsor,
  CASE s_suppkey % 4 WHEN 0 THEN 'Phase I' WHEN 1 THEN 'Phase II' WHEN 2 THEN 'Phase III' ELSE 'Phase IV' END AS phase
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""
PATIENTS = """
SELECT c_custkey AS patient_id, 18 + c_custkey % 68 AS age,
  CASE c_custkey % 2 WHEN 0 THEN 'Male' ELSE 'Female' END AS gender, r_name AS region,
  15 + CAST((c_custkey * 37) % 250 AS double) / 10 AS bmi, c_custkey % 4 AS num_pre_existing,
  abs(c_acctbal) / CAST(125 AS double) AS baseline_alt_iu_l,
  CAST(4 + c_custkey % 12 AS double) / 10 AS baseline_creatinine_mg_dl
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""
RESULTS = """
SELECT l_orderkey, l_partkey, o_custkey AS patient_id, l_suppkey AS trial_id,
  concat('Drug-', CAST(l_suppkey % 15 AS string)) AS drug_name,
  CASE l_orderkey % 4 WHEN 0 THEN 'Drug' WHEN 1 THEN 'Placebo' WHEN 2 THEN 'Drug + Standard of Care' ELSE 'Standard of Care' END AS treatment_arm,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Complete Response' WHEN l_returnflag = 'A' THEN 'Partial Response'
       WHEN l_returnflag = 'N' THEN 'Stable Disease' ELSE 'Progressive Disease' END AS response,
  l_linenumber AS visit_number, CAST(l_shipdate AS date) AS visit_date,
  l_quantity * 10 AS dosage_mg,
  l_quantity AS blood_pressure_systolic, l_quantity + l_linenumber AS blood_pressure_diastolic,
  l_discount * 100 AS heart_rate_bpm,
  l_extendedprice / 1000 AS alt_iu_l, l_tax AS creatinine_mg_dl,
  CASE WHEN l_suppkey % 5 = 0 THEN l_quantity END AS tumor_size_mm
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""
EVENTS = """
SELECT l_orderkey, l_partkey, l_linenumber, o_custkey AS patient_id, l_suppkey AS trial_id,
  concat('Drug-', CAST(l_suppkey % 15 AS string)) AS drug_name,
  concat('Drug-', CAST(l_partkey % 15 AS string)) AS concomitant_drug,
  concat('AE-', CAST(l_partkey % 17 AS string)) AS ae_type,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Severe' WHEN o_orderpriority = '3-MEDIUM' THEN 'Moderate' ELSE 'Mild' END AS severity,
  (o_orderpriority IN ('1-URGENT', '2-HIGH') OR l_partkey % 17 IN (5, 7, 8)) AS serious,
  CASE WHEN o_orderpriority = '1-URGENT' AND l_linestatus = 'F' THEN 'Fatal' ELSE 'Recovered' END AS outcome,
  l_quantity * 10 AS dosage_mg,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(5 AS double) WHEN o_orderpriority = '3-MEDIUM' THEN CAST(2 AS double) ELSE CAST(0 AS double) END + l_discount * 10 AS risk_score,
  l_tax >= 0.06 AS drug_interaction_flag, CAST(l_shipdate AS date) AS onset_date,
  l_linenumber * 30 AS days_on_treatment
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'
"""
VIEWS = {"b_trials": TRIALS, "b_patients": PATIENTS, "b_results": RESULTS, "b_events": EVENTS}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
#: Fixed binding of the oncology filter and of drugs known to interact.
ONCOLOGY = ("NATION_9", "NATION_11", "NATION_6", "NATION_19")
INTERACTIONS = {"Drug-1": ["Drug-5", "Drug-4"], "Drug-3": ["Drug-10", "Drug-11"], "Drug-2": ["Drug-11"], "Drug-7": ["Drug-0"]}
#: The latest visit in the given rows: a total order over everything the result shows.
LATEST = (
    "visit_number", "visit_date", "l_orderkey", "l_partkey", "alt_iu_l", "blood_pressure_systolic", "heart_rate_bpm",
    "creatinine_mg_dl", "response",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A clinical view as a DataFrame over the given tables."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def rounded_sql(expression: str, digits: int) -> str:
    """Round half up on the decimal value: binary ties would round either way in DuckDB."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def with_views(sql: str, **extra: str) -> str:
    """``sql`` for DuckDB, preceded by the views (and ``extra`` named expressions) it mentions."""
    plain = {name: text.format(**{t: t for t in TABLES}) for name, text in VIEWS.items()}
    parts = {**plain, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in parts:
            if name in text and name not in needed:
                visit(parts[name])
                needed.append(name)

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in needed) + "\n" + sql) if needed else sql
