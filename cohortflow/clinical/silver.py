"""Silver tables: fixed columns, typed dates, quality rules and layout, all stated as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from cohortflow.functions.scalars import parse_date
from cohortflow.operators.quality import Expectation, apply_expectations


@dataclass(frozen=True)
class SilverTable:
    entity: str
    columns: Sequence[str]
    dates: Sequence[str]
    rules: Sequence[Expectation]
    cluster_by: Sequence[str]
    comment: str

    @property
    def name(self) -> str:
        return f"silver_{self.entity}"

    @property
    def source(self) -> str:
        return f"bronze_{self.entity}"


# Column names and rules of the four tables.
ADVERSE_EVENTS = SilverTable(
    entity="adverse_events",
    columns=(
        "event_id", "patient_id", "trial_id", "drug_name", "ae_type", "severity", "serious", "onset_date", "outcome",
        "reported_by", "dosage_mg", "days_on_treatment", "risk_score", "drug_interaction_flag", "concomitant_drug",
        "_ingestion_timestamp",
    ),
    dates=("onset_date",),
    rules=(
        Expectation("valid_event_id", "event_id IS NOT NULL", "drop"),
        Expectation("valid_patient_id", "patient_id IS NOT NULL", "drop"),
        Expectation("valid_onset_date", "onset_date IS NOT NULL", "warn"),
    ),
    cluster_by=("trial_id", "patient_id"),
    comment="Adverse events with typed dates; rows without event or patient are dropped",
)
CLINICAL_TRIALS = SilverTable(
    entity="clinical_trials",
    columns=(
        "trial_id", "trial_name", "drug_name", "indication", "phase", "sponsor", "status", "sites", "target_enrollment",
        "start_date", "end_date", "_ingestion_timestamp",
    ),
    dates=("start_date", "end_date"),
    rules=(
        Expectation("valid_trial_id", "trial_id IS NOT NULL", "drop"),
        Expectation("valid_drug_name", "drug_name IS NOT NULL", "warn"),
    ),
    cluster_by=("trial_id",),
    comment="Clinical trials with typed dates",
)
PATIENTS = SilverTable(
    entity="patients",
    columns=(
        "patient_id", "age", "gender", "blood_type", "region", "bmi", "height_cm", "weight_kg", "num_pre_existing",
        "pre_existing_conditions", "baseline_creatinine_mg_dl", "baseline_alt_iu_l", "enrollment_date",
        "_ingestion_timestamp",
    ),
    dates=("enrollment_date",),
    rules=(
        Expectation("valid_patient_id", "patient_id IS NOT NULL", "drop"),
        Expectation("valid_age", "age > 0 AND age < 120", "warn"),
    ),
    cluster_by=("patient_id",),
    comment="Patient demographics and baseline labs",
)
TRIAL_RESULTS = SilverTable(
    entity="trial_results",
    columns=(
        "result_id", "patient_id", "trial_id", "drug_name", "treatment_arm", "response", "visit_number", "visit_date",
        "dosage_mg", "blood_pressure_systolic", "blood_pressure_diastolic", "heart_rate_bpm", "alt_iu_l",
        "creatinine_mg_dl", "tumor_size_mm", "_ingestion_timestamp",
    ),
    dates=("visit_date",),
    rules=(
        Expectation("valid_result_id", "result_id IS NOT NULL", "drop"),
        Expectation("valid_patient_id", "patient_id IS NOT NULL", "drop"),
        Expectation("valid_vitals", "blood_pressure_systolic > 0 AND heart_rate_bpm > 0", "warn"),
    ),
    cluster_by=("trial_id", "patient_id"),
    comment="Visits with response, vitals and labs",
)
SILVER_TABLES = (ADVERSE_EVENTS, CLINICAL_TRIALS, PATIENTS, TRIAL_RESULTS)


def typed_columns(bronze: DataFrame, table: SilverTable) -> DataFrame:
    """The table's columns in order, date texts parsed. A narrow projection: no shuffle."""
    return bronze.select(*[parse_date(F.col(c)).alias(c) if c in table.dates else F.col(c) for c in table.columns])


def to_silver(bronze: DataFrame, table: SilverTable, observation: Observation | None = None) -> DataFrame:
    """Typed columns under the table's rules, which see the typed values."""
    return apply_expectations(typed_columns(bronze, table), table.rules, observation)
