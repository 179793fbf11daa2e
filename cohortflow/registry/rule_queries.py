"""Scalar functions, risk rules, known pairs and seeded rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.functions import risk, scalars
from cohortflow.operators import joins
from cohortflow.registry.bindings import INTERACTIONS, table, view, with_views

PAIRS_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, bs in INTERACTIONS.items() for b in bs) + ")"


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    pairs = joins.pair_table(spark, INTERACTIONS, "drug_name", "concomitant_drug")
    events = view(spark, d, "b_events").drop("drug_interaction_flag")
    return joins.flag_known_pairs(events, pairs, "drug_name", "concomitant_drug", "drug_interaction_flag")


def _interactions(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).select("l_orderkey", "l_partkey", "l_linenumber", "drug_name", "concomitant_drug", "drug_interaction_flag")


FLAG_SQL = f"""
SELECT e.l_orderkey, e.l_partkey, e.l_linenumber, e.drug_name, e.concomitant_drug, p.a IS NOT NULL AS drug_interaction_flag,
  e.patient_id, e.dosage_mg, e.ae_type
FROM b_events e LEFT JOIN {PAIRS_SQL} p(a, b) ON e.drug_name = p.a AND e.concomitant_drug = p.b"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    patients = view(spark, d, "b_patients").select(
        "patient_id", "age", "bmi", "num_pre_existing", "baseline_alt_iu_l", "baseline_creatinine_mg_dl"
    )
    return _flagged(spark, d).join(patients, "patient_id", "left").withColumn("points", risk.risk_points())


POINTS_SQL = """
SELECT f.l_orderkey, f.l_partkey, f.l_linenumber, f.ae_type, f.dosage_mg, p.baseline_alt_iu_l,
  (age - 40) * CAST(0.03 AS DOUBLE) + (f.dosage_mg - 150) * CAST(0.008 AS DOUBLE) + num_pre_existing * CAST(0.8 AS DOUBLE)
  + CASE WHEN bmi < 18.5 OR bmi > 32 THEN CAST(1.5 AS DOUBLE) ELSE 0 END + CASE WHEN bmi > 28 AND bmi <= 32 THEN CAST(0.7 AS DOUBLE) ELSE 0 END
  + CASE WHEN baseline_alt_iu_l > 40 THEN CAST(1.2 AS DOUBLE) ELSE 0 END + CASE WHEN baseline_alt_iu_l > 60 THEN CAST(1.0 AS DOUBLE) ELSE 0 END
  + CASE WHEN baseline_creatinine_mg_dl > 1.3 THEN CAST(0.9 AS DOUBLE) ELSE 0 END
  + CASE WHEN f.drug_interaction_flag THEN CAST(2.5 AS DOUBLE) ELSE 0 END AS points
FROM flagged f LEFT JOIN b_patients p ON f.patient_id = p.patient_id"""
KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def _risk(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select(*KEYS, F.round("points", 6).alias("points"), risk.rounded_score(F.col("points")).alias("risk_score"))


def _buckets(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select(*KEYS, risk.severity_bucket(F.round("points", 9)).alias("severity"))


def _labels(spark: SparkSession, d: str) -> DataFrame:
    events = view(spark, d, "b_events")
    types = ("AE-5", "AE-7", "AE-8")
    return events.select(*KEYS, risk.serious_label(F.col("severity"), F.col("ae_type"), types).alias("serious"))


def _share(purpose: str):
    """[0, 1) per row: the first six hex digits of an MD5 that both engines compute."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(purpose), *KEYS)), 1, 6), 16, 10).cast("double") / (1 << 24)


def _share_sql(purpose: str) -> str:
    return f"CAST(('0x' || substr(md5('{purpose}-' || l_orderkey || '-' || l_partkey || '-' || l_linenumber), 1, 6)) AS BIGINT) / CAST(16777216 AS DOUBLE)"


def _override(spark: SparkSession, d: str) -> DataFrame:
    """Severe events get one of six types anew with chance 0.6, decided per row."""
    return view(spark, d, "b_events").select(
        *KEYS,
        "severity",
        risk.override_category(
            F.col("ae_type"), F.col("severity") == "Severe", _share("redraw"),
            F.element_at(F.array(*[F.lit(t) for t in risk.REDRAWN_SERIOUS_TYPES]), (F.floor(_share("type") * len(risk.REDRAWN_SERIOUS_TYPES)) + 1).cast("int")),
        ).alias("ae_type"),
    )


def _labs(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select(
        *KEYS, F.round(risk.projected_lab(F.col("baseline_alt_iu_l") - 20, F.col("dosage_mg")), 6).alias("alt_iu_l")
    )


def _risk_sql(select: str) -> str:
    return with_views(f"SELECT l_orderkey, l_partkey, l_linenumber, {select} FROM scored", flagged=FLAG_SQL, scored=POINTS_SQL)


# --- scalars ---------------------------------------------------------------------------------------


def _dates(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("bad")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return orders.select("o_orderkey", scalars.parse_date(text).alias("day"))


def _json(spark: SparkSession, d: str) -> DataFrame:
    """Fields out of JSON text, and the JSON text written anew."""
    parsed = F.from_json("props", "k BIGINT")
    return table(spark, d, "events").select("event_id", parsed["k"].alias("k"), F.to_json(F.struct(parsed["k"].alias("k"))).alias("json"))


SCALARS = {
    "parse_date": (
        _dates,
        "SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS day FROM orders",
    ),
    "bmi": (
        lambda s, d: table(s, d, "part").select(
            "p_partkey", scalars.bmi(F.col("p_retailprice") / 20, F.col("p_size") + 140.0, 6).alias("bmi")
        ),
        "SELECT p_partkey, round((p_retailprice / 20) / power((p_size + 140.0) / 100, 2), 6) AS bmi FROM part",
    ),
    "clamp": (
        lambda s, d: table(s, d, "customer").select("c_custkey", scalars.clamp_low(F.col("c_acctbal"), 5.0).alias("clamped")),
        "SELECT c_custkey, greatest(c_acctbal, CAST(5 AS DOUBLE)) AS clamped FROM customer",
    ),
    "format_id": (
        lambda s, d: table(s, d, "customer").select(
            "c_custkey",
            scalars.format_id("PAT", F.col("c_custkey") + 1, 5).alias("patient_id"),
            F.concat(F.lit("Study "), scalars.letter(F.pmod("c_nationkey", F.lit(26)))).alias("study"),
        ),
        "SELECT c_custkey, 'PAT-' || lpad(CAST(c_custkey + 1 AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey + 1 AS VARCHAR))) AS INT), '0') AS patient_id, 'Study ' || chr(CAST(c_nationkey % 26 + 65 AS INT)) AS study FROM customer",
    ),
    "date_offset": (
        lambda s, d: table(s, d, "part").select("p_partkey", scalars.iso_date_after("2018-01-01", (F.col("p_partkey") % 2556).cast("int")).alias("day")),
        "SELECT p_partkey, strftime(DATE '2018-01-01' + CAST(p_partkey % 2556 AS INT), '%Y-%m-%d') AS day FROM part",
    ),
    "null_unless_contains": (
        lambda s, d: table(s, d, "part").select("p_partkey", scalars.null_unless_contains(F.col("p_retailprice"), F.col("p_name"), "red").alias("price")),
        "SELECT p_partkey, CASE WHEN contains(p_name, 'red') THEN p_retailprice END AS price FROM part",
    ),
    "array_filter_size": (
        lambda s, d: table(s, d, "part").select("p_partkey", scalars.count_without(F.split("p_name", " "), "bolt").alias("n")),
        "SELECT p_partkey, len(list_filter(string_split(p_name, ' '), lambda x: x <> 'bolt')) AS n FROM part",
    ),
    "array_distinct_default": (
        lambda s, d: table(s, d, "part").select(
            "p_partkey",
            F.array_join(F.sort_array(scalars.distinct_or_default(F.split(F.concat_ws(" ", "p_name", "p_name"), " "), "bolt")), ",").alias("kinds"),
        ),
        """SELECT p_partkey, CASE WHEN len(kept) = 0 THEN 'bolt' ELSE array_to_string(list_sort(kept), ',') END AS kinds
FROM (SELECT p_partkey, list_distinct(list_filter(string_split(p_name || ' ' || p_name, ' '), lambda x: x <> 'bolt')) AS kept FROM part)""",
    ),
    "json_fields": (
        _json,
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"k\":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS json FROM events",
    ),
    "threshold_class": (
        lambda s, d: view(s, d, "b_events").select(*KEYS, scalars.threshold_class(F.col("risk_score") / 6).alias("predicted")),
        with_views("SELECT l_orderkey, l_partkey, l_linenumber, CAST(risk_score / 6 >= 0.5 AS INT) AS predicted FROM b_events"),
    ),
    "stable_id": (
        lambda s, d: table(s, d, "customer").select("c_custkey", scalars.stable_id(F.col("c_custkey"), F.col("c_name")).alias("id")),
        "SELECT c_custkey, md5(length(CAST(c_custkey AS VARCHAR)) || ':' || c_custkey || length(c_name) || ':' || c_name) AS id FROM customer",
    ),
}

QUERIES = {
    "interaction_flag": (
        _interactions,
        with_views("SELECT l_orderkey, l_partkey, l_linenumber, drug_name, concomitant_drug, drug_interaction_flag FROM flagged", flagged=FLAG_SQL),
    ),
    "risk_score": (_risk, _risk_sql("round(points, 6) AS points, round(points, 2) + CAST(0 AS DOUBLE) AS risk_score")),
    "severity_bucket": (
        _buckets,
        _risk_sql("CASE WHEN round(points, 9) > 3.5 THEN 'Severe' WHEN round(points, 9) > 1.5 THEN 'Moderate' ELSE 'Mild' END AS severity"),
    ),
    "serious_label": (
        _labels,
        with_views("SELECT l_orderkey, l_partkey, l_linenumber, severity = 'Severe' OR ae_type IN ('AE-5', 'AE-7', 'AE-8') AS serious FROM b_events"),
    ),
    "override_category": (
        _override,
        with_views(
            f"""SELECT l_orderkey, l_partkey, l_linenumber, severity, CASE WHEN severity = 'Severe' AND {_share_sql('redraw')} > {risk.REDRAW_ABOVE}
  THEN [{', '.join(f"'{t}'" for t in risk.REDRAWN_SERIOUS_TYPES)}][CAST(floor({_share_sql('type')} * {len(risk.REDRAWN_SERIOUS_TYPES)}) AS INT) + 1]
  ELSE ae_type END AS ae_type FROM b_events"""
        ),
    ),
    "lab_projection": (
        _labs,
        _risk_sql("round(greatest(CAST(5 AS DOUBLE), baseline_alt_iu_l - 20 + dosage_mg * CAST(0.02 AS DOUBLE)), 6) AS alt_iu_l"),
    ),
    **SCALARS,
}
