"""Tables that grow: silver per micro-batch, gold from change rows, schemas with new fields; and answers to loosely put questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.clinical import gold
from cohortflow.clinical.silver import ADVERSE_EVENTS, to_silver
from cohortflow.learning import ensemble
from cohortflow.operators.joins import join_dim
from cohortflow.operators.profile import value_dictionary
from cohortflow.plans.incremental import GroupState, StateTable, sign_of
from cohortflow.plans.layout import cluster_on_curve
from cohortflow.plans.lineage import scratch_path
from cohortflow.registry.bindings import ONCOLOGY, table, view, with_views
from cohortflow.registry.gold_queries import GOLD_SQL, SAFETY_SQL, gold_tables, raw_rows, raw_sql
from cohortflow.registry.semantic_queries import ASKED, BUILDERS, MODEL, ORR, SAE
from cohortflow.semantic.entities import match_values
from cohortflow.semantic.grading import grade_questions
from cohortflow.sources import json_files, snapshots
from cohortflow.streaming.batches import SilverBatches
from cohortflow.streaming.evolving import RESCUED, ingest_growing
from cohortflow.streaming.ingest import BAD_RECORD, INGESTED_AT, append_to_path, json_stream

# --- silver per micro-batch --------------------------------------------------------------------------


def _events_in_batches(spark: SparkSession, d: str) -> tuple[SilverBatches, DataFrame]:
    """Raw events through two drops of files; the second batch is given once more, as after a lost commit."""
    raw = raw_rows(spark, d, "raw_adverse_events")
    source, bronze, root = (scratch_path(spark, name) for name in ("raw", "bronze", "silver"))
    silver = SilverBatches(spark, root, ADVERSE_EVENTS)
    for part in ("days_on_treatment <= 90", "days_on_treatment > 90"):
        json_files.write_json(raw.filter(part), f"{source}/{len(part)}")
        stream = json_stream(spark, f"{source}/*", raw.schema, "*.json.gz", multi_line=False)
        append_to_path(stream, bronze, f"{root}/files").awaitTermination()
        silver.update(spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze))
    _lose_commit(spark, f"{root}/marks")
    silver.update(spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze))
    return silver, raw


def _lose_commit(spark: SparkSession, marks: str) -> None:
    """Remove the last commit among a stream's marks, as if the stream had died before it: the next start gives that batch once more."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(f"{marks}/commits")
    files = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(commits)] if files.exists(commits) else []
    if numbers := [int(name) for name in names if name.isdigit()]:
        files.delete(hadoop.Path(commits, str(max(numbers))), False)


def _silver_incremental(spark: SparkSession, d: str) -> DataFrame:
    silver, raw = _events_in_batches(spark, d)
    like = to_silver(raw.withColumn(INGESTED_AT, F.current_timestamp()), ADVERSE_EVENTS).schema
    return silver.rows(like).drop(INGESTED_AT)


def _silver_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _events_in_batches(spark, d)[0].report()


_SHOWN = [c for c in ADVERSE_EVENTS.columns if c != INGESTED_AT]
SILVER_SQL = with_views(
    f"SELECT {', '.join('TRY_CAST(onset_date AS date) AS onset_date' if c == 'onset_date' else c for c in _SHOWN)} FROM raw_adverse_events WHERE event_id IS NOT NULL AND patient_id IS NOT NULL",
    raw_adverse_events=raw_sql("raw_adverse_events"),
)
LEDGER_SQL = with_views(
    " UNION ALL ".join(
        f"""SELECT '{r.name}' AS rule, '{r.action}' AS action, count(*) FILTER (WHERE {ok}) AS passed, count(*) FILTER (WHERE NOT ({ok})) AS failed,
  {f"count(*) FILTER (WHERE NOT ({ok}))" if r.action == "drop" else "CAST(0 AS BIGINT)"} AS dropped FROM raw_adverse_events"""
        for r in ADVERSE_EVENTS.rules
        for ok in [r.predicate.replace("onset_date", "TRY_CAST(onset_date AS date)")]
    ),
    raw_adverse_events=raw_sql("raw_adverse_events"),
)

# --- gold from change rows ---------------------------------------------------------------------------

def safety_state() -> GroupState:
    """The safety table as sums."""
    return GroupState(
        keys=("trial_id", "drug_name"),
        total="total_adverse_events",
        counts={
            "serious_event_count": F.col("serious"),
            **{name: F.col("severity") == value for name, value in gold.SEVERITY_COUNTS.items()},
            "drug_interaction_count": F.col("drug_interaction_flag"),
            "fatal_outcome_count": F.col("outcome") == "Fatal",
        },
        means={"avg_risk_score": ("risk_score", 2)},
    )


def _later_events(events: DataFrame) -> DataFrame:
    """The events of the second day: some gone, some with another score and severity, some new."""
    changed = F.col("l_partkey") % 5 == 0
    later = events.filter("l_orderkey % 7 <> 3")
    return later.withColumn("risk_score", F.when(changed, F.col("risk_score") + 1).otherwise(F.col("risk_score"))).withColumn(
        "severity", F.when(changed, "Severe").otherwise(F.col("severity"))
    )


LATER_SQL = """SELECT * REPLACE (CASE WHEN l_partkey % 5 = 0 THEN risk_score + 1 ELSE risk_score END AS risk_score,
  CASE WHEN l_partkey % 5 = 0 THEN 'Severe' ELSE severity END AS severity) FROM b_events WHERE l_orderkey % 7 <> 3"""
EVENT_KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def _gold_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The first day's events as they come in two drops, then only the change rows to the second day."""
    events = view(spark, d, "b_events")
    first = events.filter("l_orderkey % 7 <> 5")
    states = StateTable.at(events, scratch_path(spark, "state"), safety_state())
    for number, part in enumerate(("l_linenumber <= 3", "l_linenumber > 3")):
        states.add(number, first.filter(part))
    states.fold(1)
    changes = snapshots.snapshot_diff(first, _later_events(events), EVENT_KEYS)
    for _ in range(2):  # a repeated batch counts once
        states.add(2, changes, sign_of(changes))
    return join_dim(states.report(), view(spark, d, "b_trials"), ["trial_id"], gold.TRIAL_ATTRIBUTES)


GOLD_LATER_SQL = with_views(SAFETY_SQL.replace("b_events", "later_events"), later_events=LATER_SQL)

# --- a schema that grows -----------------------------------------------------------------------------

MISTYPED, BROKEN = 89, 97


def _growing(spark: SparkSession, d: str) -> DataFrame:
    """Events in two drops: the second has one field more, some users that are texts, and some cut lines."""
    events = table(spark, d, "events")
    source, target, marks = (scratch_path(spark, name) for name in ("lines", "bronze", "marks"))
    old = events.filter("event_id % 2 = 0").select(F.to_json(F.struct("event_id", "user_id")).alias("value"))
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"))
    mistyped = F.to_json(F.struct("event_id", F.concat(F.lit("u"), F.col("user_id")).alias("user_id"), "event_type"))
    line = F.when(F.col("event_id") % BROKEN == 0, cut).when(F.col("event_id") % MISTYPED == 0, mistyped).otherwise(F.to_json(F.struct("event_id", "user_id", "event_type")))
    for lines in (old, events.filter("event_id % 2 = 1").select(line.alias("value"))):
        lines.write.mode("append").text(source)
        bronze = ingest_growing(spark, source, target, marks)
    return bronze.select("event_id", "user_id", "event_type", F.col(RESCUED)["user_id"].alias("rescued_user"), F.col(BAD_RECORD).alias("bad_text"))


GROWING_SQL = f"""SELECT CASE WHEN kind <> 'cut' THEN event_id END AS event_id, CASE WHEN kind IN ('old', 'new') THEN user_id END AS user_id,
  CASE WHEN kind IN ('new', 'mistyped') THEN event_type END AS event_type, CASE WHEN kind = 'mistyped' THEN 'u' || user_id END AS rescued_user,
  CASE WHEN kind = 'cut' THEN '{{"event_id": ' || event_id END AS bad_text
FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'old' WHEN event_id % {BROKEN} = 0 THEN 'cut' WHEN event_id % {MISTYPED} = 0 THEN 'mistyped' ELSE 'new' END AS kind FROM events)"""

# --- files of one JSON array each, next to files of another kind ----------------------------------------


def _arrays(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers in printed arrays of 100, one file each; the nations' files in the same folders have other names."""
    suppliers, path = table(spark, d, "supplier"), scratch_path(spark, "arrays")
    rows = F.collect_list(F.struct(*suppliers.columns)).alias("rows")
    arrays = suppliers.groupBy(F.floor(F.col("s_suppkey") / 100).alias("block")).agg(rows)
    arrays.select("block", F.to_json("rows", {"pretty": "true"}).alias("value")).write.partitionBy("block").text(path)
    json_files.write_json(table(spark, d, "nation"), f"{path}/block=other")
    stream = json_stream(spark, f"{path}/*", suppliers.schema, "*.txt", multi_line=True)
    target = scratch_path(spark, "bronze")
    append_to_path(stream, target, scratch_path(spark, "marks")).awaitTermination()
    return spark.read.parquet(target).select(*suppliers.columns, F.col(INGESTED_AT).isNotNull().alias("stamped"))


# --- layout on a curve -------------------------------------------------------------------------------


def _on_curve(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "layout")
    cluster_on_curve(table(spark, d, "lineitem"), ["l_suppkey", "l_shipdate"]).write.parquet(path)
    return spark.read.parquet(path)


# --- how many trees to keep --------------------------------------------------------------------------

#: Margins of three small trees on the events, as running sums.
TREES = ("CAST(dosage_mg AS DOUBLE) / 500", "CASE WHEN drug_interaction_flag THEN 0.25 ELSE -0.25 END", "risk_score / 4", "CAST(days_on_treatment AS DOUBLE) / 30")
RUNNING = [" + ".join(f"({t})" for t in TREES[: n + 1]) for n in range(len(TREES))]


def _prefixes(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "b_events").select(F.col("serious").cast("int").alias("label"), F.array(*[F.round(F.expr(r), 9) for r in RUNNING]).alias("margins"))
    kept = ensemble.kept_prefix(ensemble.prefix_auc(rows, "label"), patience=2)
    return kept.withColumn("roc_auc", F.round("roc_auc", 9))


def _prefix_sql() -> str:
    parts = [
        f"""SELECT {n} AS trees, round(sum(pos * (below + neg / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS roc_auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
    SELECT round({r}, 9) AS score, count(*) FILTER (serious) AS pos, count(*) FILTER (NOT serious) AS neg FROM b_events GROUP BY 1))"""
        for n, r in enumerate(RUNNING, 1)
    ]
    return with_views(
        """SELECT trees, roc_auc, trees = (SELECT arg_min(trees, (-roc_auc, trees)) FROM reached) AS kept FROM reached""",
        aucs=" UNION ALL ".join(parts),
        # an end is reached once the best of all rounds lies more than two rounds back
        reached="""SELECT * FROM aucs a WHERE NOT EXISTS (SELECT 1 FROM aucs b WHERE b.trees <= a.trees
  AND b.trees > 2 + coalesce((SELECT arg_min(c.trees, (-c.roc_auc, c.trees)) FROM aucs c WHERE c.trees < b.trees), 0))""",
    )


# --- misspelt values ---------------------------------------------------------------------------------


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """Part names as people type them: one character lost, one doubled, or right."""
    name, key = F.col("p_name"), F.col("p_partkey")
    lost = F.concat(F.substring(name, 1, 2), F.substring(name, 4, 200))
    doubled = F.concat(F.substring(name, 1, 5), F.substring(name, 5, 200))
    typed = F.when(key % 3 == 0, lost).when(key % 3 == 1, doubled).otherwise(name)
    return table(spark, d, "part").select("p_partkey", F.concat(F.lit("Orders of "), typed, F.lit(" of "), F.col("p_brand")).alias("asked"))


def _matched(spark: SparkSession, d: str) -> DataFrame:
    dictionary = value_dictionary(table(spark, d, "part"), ["p_name", "p_brand", "p_type"])
    return match_values(_asked(spark, d), "asked", dictionary)


MATCH_SQL = r"""
WITH asked AS (
  SELECT p_partkey, 'Orders of ' || CASE p_partkey % 3 WHEN 0 THEN substr(p_name, 1, 2) || substr(p_name, 4) WHEN 1 THEN substr(p_name, 1, 5) || substr(p_name, 5) ELSE p_name END
    || ' of ' || p_brand AS asked FROM part),
known AS (
  SELECT DISTINCT 'p_name' AS "column", p_name AS value FROM part UNION SELECT 'p_brand', p_brand FROM part UNION SELECT 'p_type', p_type FROM part),
size AS (SELECT max(len(regexp_split_to_array(value, '[^\p{L}\p{N}_]+'))) AS longest FROM known),
words AS (SELECT p_partkey, asked, list_filter(regexp_split_to_array(lower(asked), '[^\p{L}\p{N}_]+'), lambda w: w <> '') AS w FROM asked),
starts AS (SELECT p_partkey, asked, w, unnest(range(1, len(w) + 1)) AS s FROM words),
phrases AS (SELECT DISTINCT p_partkey, asked, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM starts, (SELECT unnest(range(1, longest + 1)) AS n FROM size) WHERE s + n - 1 <= len(w)),
texts AS (SELECT DISTINCT phrase FROM phrases),
near AS (
  SELECT phrase, "column", value, levenshtein(phrase, lower(value)) AS distance FROM texts, known
  WHERE levenshtein(phrase, lower(value)) <= CASE WHEN length(value) >= 9 THEN 2 WHEN length(value) >= 4 THEN 1 ELSE 0 END)
SELECT p_partkey, asked, phrases.phrase, "column", value, CAST(distance AS INTEGER) AS distance FROM phrases JOIN near ON near.phrase = phrases.phrase"""

# --- questions about one drug -------------------------------------------------------------------------


def _about(question: str, **only):
    source = MODEL.question(question).source
    return lambda spark, d: MODEL.answer(spark, question, {source: BUILDERS[source](spark, d)}, only=only)


DRUG = "Drug-7"
ORR_OF_DRUG = f"SELECT drug_name, treatment_arm, total_observations, complete_response_count + partial_response_count AS responders, {ORR} AS orr_pct FROM gold_drug_efficacy WHERE drug_name = '{DRUG}'"
SAFETY_OF_DRUG = f"""SELECT drug_name, total_adverse_events, serious_event_count, {SAE} AS serious_ae_rate_pct, severe_count, moderate_count,
  mild_count, avg_risk_score, fatal_outcome_count FROM gold_trial_safety_summary WHERE drug_name = '{DRUG}'"""

# --- graded questions --------------------------------------------------------------------------------

_RATE = "CAST(100 AS DOUBLE) * ({}) / {}"
_ORR = _RATE.format("complete_response_count + partial_response_count", "total_observations")
_SEVERE = _RATE.format("serious_event_count", "total_adverse_events")
_DRUGS = f"SELECT treatment_arm AS arm, {_ORR} AS rate, drug_name AS drug, complete_response_count + partial_response_count AS hits, total_observations AS n FROM {{gold_drug_efficacy}}"
_SAFETY = f"""SELECT drug_name, avg_risk_score, {_SEVERE} AS share, total_adverse_events, serious_event_count, fatal_outcome_count, mild_count, moderate_count, severe_count
FROM {{gold_trial_safety_summary}}"""
_CANCER = f"""SELECT {_ORR} AS response, treatment_arm, phase, indication, drug_name FROM {{gold_drug_efficacy}}
WHERE indication IN ({', '.join(repr(i) for i in ONCOLOGY)}) AND treatment_arm LIKE 'Drug%'"""
#: Each question with its reference, which names, orders and rounds its columns in its own way.
REFERENCES = (
    ("orr_by_drug_arm", _DRUGS, {}),
    ("orr_by_drug_arm", _DRUGS + " ORDER BY rate DESC", {}),
    ("safety_profile", _SAFETY, {}),
    ("safety_profile", _SAFETY + " ORDER BY share DESC", {}),
    ("oncology_orr", _CANCER, {}),
    ("oncology_orr", _CANCER + " ORDER BY response DESC", {}),
    ("risk_by_sponsor", "SELECT avg(avg_risk_score) AS risk, sponsor AS company FROM {gold_trial_safety_summary} GROUP BY sponsor", {}),
    ("phase3_events", "SELECT fatal_outcome_count AS dead, serious_event_count AS serious, total_adverse_events AS events, drug_name, trial_name FROM {gold_trial_safety_summary} WHERE phase = 'Phase III'", {}),
    ("complete_by_region", "SELECT region, count(*) AS n, drug_name FROM {gold_patient_outcomes} WHERE response = 'Complete Response' GROUP BY ALL", {}),
    ("phase2_orr", f"SELECT indication, {_ORR} AS rate, treatment_arm, drug_name FROM {{gold_drug_efficacy}} WHERE phase = 'Phase II'", {}),
)


def _graded(spark: SparkSession, d: str) -> DataFrame:
    return grade_questions(spark, MODEL, gold_tables(spark, d), REFERENCES)


_COUNTED = {
    "risk_by_sponsor": "SELECT count(DISTINCT sponsor) AS n FROM gold_trial_safety_summary",
    "complete_by_region": "SELECT count(*) AS n FROM (SELECT DISTINCT drug_name, region FROM gold_patient_outcomes WHERE response = 'Complete Response')",
}
GRADED_SQL = with_views(
    " UNION ALL ".join(
        f"SELECT '{name}' AS question, true AS correct, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS surplus, n AS n_rows FROM ("
        + _COUNTED.get(name, f"SELECT count(*) AS n FROM {ASKED[name][0]} WHERE {ASKED[name][1]}")
        + ")"
        for name, _, _ in REFERENCES
    ),
    **GOLD_SQL,
)

QUERIES = {
    "silver_incremental": (_silver_incremental, SILVER_SQL),
    "silver_ledger": (_silver_ledger, LEDGER_SQL),
    "gold_incremental": (_gold_incremental, GOLD_LATER_SQL),
    "ingest_growing_schema": (_growing, GROWING_SQL),
    "ingest_json_arrays": (_arrays, "SELECT *, true AS stamped FROM supplier"),
    "q_orr_of_drug": (_about("orr_by_drug_arm", drug_name=DRUG), with_views(ORR_OF_DRUG, **GOLD_SQL)),
    "q_safety_of_drug": (_about("safety_profile", drug_name=DRUG), with_views(SAFETY_OF_DRUG, **GOLD_SQL)),
    "layout_on_curve": (_on_curve, "SELECT * FROM lineitem"),
    "kept_prefix": (_prefixes, _prefix_sql()),
    "match_values": (_matched, MATCH_SQL),
    "grade_questions": (_graded, GRADED_SQL),
}
