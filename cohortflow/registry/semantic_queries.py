"""Measures, filters, dimensions, joins and questions of the governed model, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.operators.profile import value_dictionary
from cohortflow.registry.bindings import ONCOLOGY, rounded_sql, table, view, with_views
from cohortflow.registry.gold_queries import GOLD_SQL, gold_efficacy, gold_outcomes, gold_safety, gold_tables
from cohortflow.semantic.clinical import EFFICACY, OUTCOMES, SAFETY, clinical_model
from cohortflow.semantic.model import Dimension, NamedFilter, SemanticModel, resolve_terms, smoke_report
from cohortflow.sources.tables import column_comments, describe_columns

MODEL = clinical_model(oncology=ONCOLOGY, default_trial=7)
BUILDERS = {EFFICACY: gold_efficacy, SAFETY: gold_safety, OUTCOMES: gold_outcomes}

ORR = rounded_sql('(complete_response_count + partial_response_count) * CAST(100 AS DOUBLE) / total_observations', 1)
SAE = rounded_sql('serious_event_count * CAST(100 AS DOUBLE) / total_adverse_events', 1)
IN_ONCOLOGY = "indication IN (" + ", ".join(f"'{i}'" for i in ONCOLOGY) + ")"


def _sql(text: str) -> str:
    return with_views(text, **GOLD_SQL)


def _ask(name: str):
    source = MODEL.question(name).source

    def run(spark: SparkSession, d: str) -> DataFrame:
        return MODEL.answer(spark, name, {source: BUILDERS[source](spark, d)})

    return run


def _measured(name: str, keys: list[str]):
    term = MODEL.term(name)
    return lambda spark, d: term.apply(BUILDERS[term.source](spark, d)).select(*keys, name)


def _filtered(name: str):
    term = MODEL.term(name)
    return lambda spark, d: term.apply(BUILDERS[term.source](spark, d))


def _by_phase(spark: SparkSession, d: str) -> DataFrame:
    phase = MODEL.term("trial_phase")
    return phase.group(gold_efficacy(spark, d)).agg(
        F.count("*").alias("n_rows"), F.sum("total_observations").alias("observations")
    )


def _joined(k: int, columns: list[str], shown: list[str]):
    spec = MODEL.joins[k]

    def run(spark: SparkSession, d: str) -> DataFrame:
        tables = {name: BUILDERS[name](spark, d) for name in (spec.left, spec.right)}
        return spec.apply(tables, columns).select(*shown)

    return run


def _cardinality(spark: SparkSession, d: str) -> DataFrame:
    """Violations of the declared joins (none) and of a wrong one: efficacy is not unique per trial and drug."""
    tables = {name: build(spark, d) for name, build in BUILDERS.items() if name != OUTCOMES}
    declared = [spec.violations(tables).select("trial_id", "drug_name", "n_rows", F.lit(spec.right).alias("relation")) for spec in MODEL.joins]
    wrong = MODEL.joins[1].__class__(SAFETY, EFFICACY, ("trial_id", "drug_name")).violations(tables)
    return declared[0].unionByName(declared[1]).unionByName(
        wrong.select("trial_id", "drug_name", "n_rows", F.lit("reversed").alias("relation"))
    )


#: Words for parts, as a small model over the given catalogue.
PART_MODEL = SemanticModel(
    filters=(
        NamedFilter("red parts", "part", "p_name LIKE 'red %'", ("red", "crimson")),
        NamedFilter("small parts", "part", "p_name LIKE 'small %'", ("small", "tiny")),
        NamedFilter("blue bolts", "part", "p_name = 'blue bolt'", ("blue bolt",)),
    ),
    dimensions=(Dimension("part_kind", "part", "split(p_name, ' ')[1]", ("widget", "gear", "bolt", "ring")),),
)


def _resolve(spark: SparkSession, d: str) -> DataFrame:
    return resolve_terms(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", PART_MODEL)


RESOLVE_SQL = """
WITH terms(word, kind, name) AS (VALUES ('red parts','filter','red parts'), ('red','filter','red parts'), ('crimson','filter','red parts'),
  ('small parts','filter','small parts'), ('small','filter','small parts'), ('tiny','filter','small parts'),
  ('blue bolts','filter','blue bolts'), ('blue bolt','filter','blue bolts'), ('part_kind','dimension','part_kind'),
  ('widget','dimension','part_kind'), ('gear','dimension','part_kind'), ('bolt','dimension','part_kind'), ('ring','dimension','part_kind'))
SELECT DISTINCT p_partkey, p_name, terms.word, kind, name FROM part JOIN terms
  ON contains(concat(' ', lower(p_name), ' '), concat(' ', terms.word, ' '))"""


def _described(spark: SparkSession, d: str) -> DataFrame:
    """Comments of the described gold columns, read back from the schema, with the number of values of each."""
    parts = []
    for name, build in BUILDERS.items():
        frame = build(spark, d)
        described = column_comments(describe_columns(frame, MODEL.comments[name])).filter("comment IS NOT NULL")
        sizes = value_dictionary(frame, MODEL.dictionary_columns[name]).groupBy("column").agg(F.count("*").alias("n_values"))
        parts.append(described.join(sizes, "column").withColumn("table", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


DESCRIBED_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", '{comment}' AS comment, count(DISTINCT {c}) AS n_values FROM {name}"
    for name, comments in MODEL.comments.items()
    for c, comment in comments.items()
)
def _inventory(spark: SparkSession, d: str) -> DataFrame:
    """What the model defines, and how many rows the tables it covers have."""
    result = MODEL.inventory(spark).select("kind", F.col("n").cast("bigint").alias("n"))
    for name, frame in gold_tables(spark, d).items():
        result = result.unionByName(frame.agg(F.count("*").alias("n")).select(F.lit(f"rows of {name}").alias("kind"), "n"))
    return result


INVENTORY_SQL = """SELECT kind, CAST(n AS BIGINT) AS n FROM (VALUES ('tables', 3), ('measures', 5), ('filters', 3), ('dimensions', 1), ('joins', 2),
  ('questions', 8), ('rephrased questions', 6)) v(kind, n)""" + "".join(
    f" UNION ALL SELECT 'rows of {name}', count(*) FROM {name}" for name in GOLD_SQL
)
#: What each stored question filters, per table.
ASKED = {
    "orr_by_drug_arm": (EFFICACY, "true"),
    "trial_comparison": (EFFICACY, "trial_id = 7"),
    "safety_profile": (SAFETY, "true"),
    "oncology_orr": (EFFICACY, IN_ONCOLOGY + " AND treatment_arm IN ('Drug', 'Drug + Standard of Care')"),
    "risk_by_sponsor": (SAFETY, "true"),
    "phase3_events": (SAFETY, "phase = 'Phase III'"),
    "complete_by_region": (OUTCOMES, "response = 'Complete Response'"),
    "phase2_orr": (EFFICACY, "phase = 'Phase II'"),
}
SMOKE_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS question, CASE WHEN count(*) > 0 THEN 'passed' ELSE 'empty' END AS state, CAST(NULL AS VARCHAR) AS message FROM {source} WHERE {condition}"
    for name, (source, condition) in ASKED.items()
)


def _dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Values of the model's text columns per gold table."""
    parts = [
        value_dictionary(build(spark, d), MODEL.dictionary_columns[name]).withColumn("table", F.lit(name))
        for name, build in BUILDERS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


DICTIONARY_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {name} WHERE {c} IS NOT NULL GROUP BY {c}"
    for name, columns in MODEL.dictionary_columns.items()
    for c in columns
)

QUERIES = {
    "measure_orr": (
        _measured("orr_pct", ["drug_name", "treatment_arm", "trial_id"]),
        _sql(f"SELECT drug_name, treatment_arm, trial_id, {ORR} AS orr_pct FROM gold_drug_efficacy"),
    ),
    "measure_serious_rate": (
        _measured("serious_ae_rate_pct", ["drug_name", "trial_id"]),
        _sql(f"SELECT drug_name, trial_id, {SAE} AS serious_ae_rate_pct FROM gold_trial_safety_summary"),
    ),
    "filter_oncology": (_filtered("oncology trials"), _sql(f"SELECT * FROM gold_drug_efficacy WHERE {IN_ONCOLOGY}")),
    "filter_high_risk": (_filtered("high risk"), _sql("SELECT * FROM gold_trial_safety_summary WHERE avg_risk_score > 3.0")),
    "by_phase": (
        _by_phase,
        _sql("SELECT phase AS trial_phase, count(*) AS n_rows, CAST(sum(total_observations) AS BIGINT) AS observations FROM gold_drug_efficacy GROUP BY phase"),
    ),
    "join_outcomes_efficacy": (
        _joined(0, ["total_observations", "complete_response_count"], ["patient_id", "trial_id", "drug_name", "treatment_arm", "response", "total_observations", "complete_response_count"]),
        _sql(
            """SELECT o.patient_id, o.trial_id, o.drug_name, o.treatment_arm, o.response, e.total_observations, e.complete_response_count
FROM gold_patient_outcomes o LEFT JOIN gold_drug_efficacy e
  ON o.trial_id = e.trial_id AND o.drug_name = e.drug_name AND o.treatment_arm = e.treatment_arm"""
        ),
    ),
    "join_efficacy_safety": (
        _joined(1, ["total_adverse_events", "avg_risk_score"], ["trial_id", "drug_name", "treatment_arm", "total_observations", "total_adverse_events", "avg_risk_score"]),
        _sql(
            """SELECT e.trial_id, e.drug_name, e.treatment_arm, e.total_observations, s.total_adverse_events, s.avg_risk_score
FROM gold_drug_efficacy e LEFT JOIN gold_trial_safety_summary s ON e.trial_id = s.trial_id AND e.drug_name = s.drug_name"""
        ),
    ),
    "check_many_to_one": (
        _cardinality,
        _sql(
            """SELECT trial_id, drug_name, count(*) AS n_rows, 'reversed' AS relation FROM gold_drug_efficacy
GROUP BY trial_id, drug_name HAVING count(*) > 1
UNION ALL SELECT trial_id, drug_name, count(*), 'gold_trial_safety_summary' FROM gold_trial_safety_summary GROUP BY trial_id, drug_name HAVING count(*) > 1
UNION ALL SELECT trial_id, drug_name, count(*), 'gold_drug_efficacy' FROM gold_drug_efficacy GROUP BY trial_id, drug_name, treatment_arm HAVING count(*) > 1"""
        ),
    ),
    "resolve_terms": (_resolve, RESOLVE_SQL),
    "semantic_value_dictionary": (_dictionary, _sql(DICTIONARY_SQL)),
    "describe_columns": (_described, _sql(DESCRIBED_SQL)),
    "model_inventory": (_inventory, _sql(INVENTORY_SQL)),
    "smoke_report": (lambda s, d: smoke_report(s, MODEL, gold_tables(s, d)), _sql(SMOKE_SQL)),
    "q_orr_by_drug_arm": (
        _ask("orr_by_drug_arm"),
        _sql(f"SELECT drug_name, treatment_arm, total_observations, complete_response_count + partial_response_count AS responders, {ORR} AS orr_pct FROM gold_drug_efficacy"),
    ),
    "trial_comparison": (
        _ask("trial_comparison"),
        _sql(f"SELECT drug_name, treatment_arm, total_observations, complete_response_count, partial_response_count, {ORR} AS orr_pct FROM gold_drug_efficacy WHERE trial_id = 7"),
    ),
    "q_safety_profile": (
        _ask("safety_profile"),
        _sql(
            f"""SELECT drug_name, total_adverse_events, serious_event_count, {SAE} AS serious_ae_rate_pct, severe_count, moderate_count,
  mild_count, avg_risk_score, fatal_outcome_count FROM gold_trial_safety_summary"""
        ),
    ),
    "q_oncology_orr": (
        _ask("oncology_orr"),
        _sql(
            f"""SELECT drug_name, indication, phase, treatment_arm, {ORR} AS orr_pct FROM gold_drug_efficacy
WHERE {IN_ONCOLOGY} AND treatment_arm IN ('Drug', 'Drug + Standard of Care')"""
        ),
    ),
    "risk_by_sponsor": (
        _ask("risk_by_sponsor"),
        _sql(f"SELECT sponsor, {rounded_sql('avg(avg_risk_score)', 2)} AS mean_risk_score FROM gold_trial_safety_summary GROUP BY sponsor"),
    ),
    "q_phase3_events": (
        _ask("phase3_events"),
        _sql("SELECT trial_name, drug_name, total_adverse_events, serious_event_count, fatal_outcome_count FROM gold_trial_safety_summary WHERE phase = 'Phase III'"),
    ),
    "q_complete_by_region": (
        _ask("complete_by_region"),
        _sql("SELECT drug_name, region, count(*) AS complete_responders FROM gold_patient_outcomes WHERE response = 'Complete Response' GROUP BY drug_name, region"),
    ),
    "q_phase2_orr": (
        _ask("phase2_orr"),
        _sql(f"SELECT drug_name, treatment_arm, indication, {ORR} AS orr_pct FROM gold_drug_efficacy WHERE phase = 'Phase II'"),
    ),
}
