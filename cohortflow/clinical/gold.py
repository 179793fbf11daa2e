"""Gold tables: aggregate first, then join the small result to its dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.operators.joins import join_dim
from cohortflow.operators.latest import latest_per_group
from cohortflow.operators.report import group_report
from cohortflow.plans.lineage import is_small

TRIAL_ATTRIBUTES = ("trial_name", "phase", "sponsor", "indication")
#: ``visit_number`` alone may tie, so the visit date and the row's id decide.
LATEST_VISIT = ("visit_number", "visit_date", "result_id")

# Output names and the categories they count.
SEVERITY_COUNTS = {"severe_count": "Severe", "moderate_count": "Moderate", "mild_count": "Mild"}
RESPONSE_COUNTS = {
    "complete_response_count": "Complete Response",
    "partial_response_count": "Partial Response",
    "stable_disease_count": "Stable Disease",
    "progressive_disease_count": "Progressive Disease",
}
VISIT_MEANS = {
    "avg_systolic_bp": ("blood_pressure_systolic", 1),
    "avg_heart_rate": ("heart_rate_bpm", 1),
    "avg_alt": ("alt_iu_l", 1),
    "avg_creatinine": ("creatinine_mg_dl", 2),
}
VISIT_COLUMNS = (
    "drug_name", "treatment_arm", "response", "visit_number", "visit_date", "blood_pressure_systolic",
    "blood_pressure_diastolic", "heart_rate_bpm", "alt_iu_l", "creatinine_mg_dl", "tumor_size_mm",
)
PATIENT_COLUMNS = ("age", "gender", "region", "bmi", "num_pre_existing")
PAIR = ["patient_id", "trial_id"]
EVENT_COUNTS = ["adverse_event_count", "serious_ae_count"]
#: Parts that the trials of a patient are dealt to, each a task of its own if need be.
TRIAL_PARTS = 8


@dataclass(frozen=True)
class GoldTable:
    name: str
    cluster_by: Sequence[str]
    comment: str


SAFETY = GoldTable("gold_trial_safety_summary", ("trial_id", "drug_name"), "Adverse events per trial and drug")
OUTCOMES = GoldTable("gold_patient_outcomes", ("patient_id", "trial_id"), "Latest visit of each patient in each trial")
EFFICACY = GoldTable("gold_drug_efficacy", ("drug_name", "treatment_arm"), "Responses and vitals per drug, arm and trial")


def _matches(column: str, categories: dict[str, str]) -> dict[str, Column]:
    return {name: F.col(column) == category for name, category in categories.items()}


def trial_safety_summary(events: DataFrame, trials: DataFrame) -> DataFrame:
    """Event counts, severity breakdown and mean risk per (trial, drug), with the trial's attributes."""
    report = group_report(
        events,
        ["trial_id", "drug_name"],
        total="total_adverse_events",
        counts={
            "serious_event_count": F.col("serious"),
            **_matches("severity", SEVERITY_COUNTS),
            "drug_interaction_count": F.col("drug_interaction_flag"),
            **_matches("outcome", {"fatal_outcome_count": "Fatal"}),
        },
        means={"avg_risk_score": ("risk_score", 2)},
    )
    return join_dim(report, trials, ["trial_id"], TRIAL_ATTRIBUTES)


def drug_efficacy(results: DataFrame, trials: DataFrame) -> DataFrame:
    """Observation and response counts and mean vitals per (drug, arm, trial), with the trial's attributes."""
    report = group_report(
        results,
        ["drug_name", "treatment_arm", "trial_id"],
        total="total_observations",
        counts=_matches("response", RESPONSE_COUNTS),
        means=VISIT_MEANS,
    )
    return join_dim(report, trials, ["trial_id"], TRIAL_ATTRIBUTES)


def event_counts(events: DataFrame) -> DataFrame:
    return group_report(
        events, ["patient_id", "trial_id"], total="adverse_event_count", counts={"serious_ae_count": F.col("serious")}
    )


def patient_outcomes(
    results: DataFrame, patients: DataFrame, events: DataFrame, latest: Sequence[str | Column] = LATEST_VISIT
) -> DataFrame:
    """Latest visit per (patient, trial) with demographics and event counts (null without any event).

    The event counts are joined first: both sides are already partitioned by (patient, trial), so that join adds no shuffle. The patients
    come last. Patients that are too many for a broadcast would move all those wide rows again: then see ``_outcomes_by_patient``.
    """
    attributes = patients.select("patient_id", *PATIENT_COLUMNS)
    if is_small(attributes):
        visits = latest_per_group(results, PAIR, latest)
        with_events = join_dim(visits, event_counts(events), PAIR, EVENT_COUNTS)
        joined = join_dim(with_events, attributes, ["patient_id"], PATIENT_COLUMNS)
    else:
        joined = _outcomes_by_patient(results, attributes, events, latest)
    return joined.select(*PAIR, *VISIT_COLUMNS, *PATIENT_COLUMNS, *EVENT_COUNTS)


def _outcomes_by_patient(results: DataFrame, patients: DataFrame, events: DataFrame, latest: Sequence[str | Column]) -> DataFrame:
    """The same rows with one shuffle of the visits: they and the event counts are dealt by patient and a part of the trials.

    The counts reach the visits of their pair, the latest visit is picked and the patients are joined where the rows lie then. A patient with
    most of the rows is ``TRIAL_PARTS`` tasks; every patient comes once for each part.
    """
    kinds = dict(results.dtypes)
    counts = event_counts(events).select(*[F.col(k).try_cast(kinds[k]).alias(k) for k in PAIR], *[F.col(c).alias(f"_{c}") for c in EVENT_COUNTS])
    part = F.pmod(F.xxhash64("trial_id"), F.lit(TRIAL_PARTS)).cast("int")  # an expression, not a column that would move along
    dealt = results.unionByName(counts, allowMissingColumns=True).repartition("patient_id", part)
    # as in a join, a null key has no counts
    known = F.col("patient_id").isNotNull() & F.col("trial_id").isNotNull()
    pair = Window.partitionBy("patient_id", part, "trial_id")
    attached = dealt.withColumns({c: F.when(known, F.max(f"_{c}").over(pair)) for c in EVENT_COUNTS})
    visits = attached.filter(F.col(f"_{EVENT_COUNTS[0]}").isNull()).drop(*[f"_{c}" for c in EVENT_COUNTS]).withColumn("_part", part)
    every_part = patients.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(TRIAL_PARTS - 1)))).hint("merge")
    return join_dim(latest_per_group(visits, ["patient_id", "_part", "trial_id"], latest), every_part, ["patient_id", "_part"], PATIENT_COLUMNS)
