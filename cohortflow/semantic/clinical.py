"""The governed clinical model over the three gold tables."""

from cohortflow.clinical.vocabulary import ACTIVE_ARMS, ONCOLOGY
from cohortflow.semantic.model import Dimension, JoinSpec, Measure, NamedFilter, Question, SemanticModel

EFFICACY, SAFETY, OUTCOMES = "gold_drug_efficacy", "gold_trial_safety_summary", "gold_patient_outcomes"


def _percent(part: str, whole: str) -> str:
    return f"ROUND(TRY_DIVIDE(CAST({part} AS DOUBLE) * 100, {whole}), 1)"


def _one_of(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def clinical_model(oncology=tuple(ONCOLOGY), default_trial: object = "TRIAL-001") -> SemanticModel:
    """Percentages have one decimal; a rate over nothing is null. Efficacy is always shown with its arm."""
    responders = "complete_response_count + partial_response_count"
    return SemanticModel(
        measures=(
            # Names, formulas and synonyms.
            Measure(
                "orr_pct", EFFICACY, _percent(responders, "total_observations"),
                ("ORR", "overall response rate", "response rate", "efficacy rate"),
                "Complete and partial responses in percent of all observations",
            ),
            Measure(
                "serious_ae_rate_pct", SAFETY, _percent("serious_event_count", "total_adverse_events"),
                ("serious AE rate", "SAE rate", "serious adverse event percentage"),
                "Serious events in percent of all adverse events",
            ),
            Measure("responders", EFFICACY, responders, (), "Complete and partial responses"),
            Measure("mean_risk_score", SAFETY, "ROUND(ROUND(AVG(avg_risk_score), 9), 2)", (), "Unweighted mean of the trials' means"),
            Measure("complete_responders", OUTCOMES, "COUNT(*)", (), "Patients with the filtered response"),
        ),
        filters=(
            NamedFilter(
                "oncology trials", EFFICACY, _one_of("indication", oncology),
                ("oncology", "cancer trials", "cancer indications"),
                "Cancer indications",
            ),
            NamedFilter(
                "high risk", SAFETY, "avg_risk_score > 3.0",
                ("high risk score", "risky", "dangerous"),
                "Mean risk score above 3",
            ),
            NamedFilter("active arms", EFFICACY, _one_of("treatment_arm", ACTIVE_ARMS), (), "Arms that give the drug"),
        ),
        dimensions=(Dimension("trial_phase", EFFICACY, "phase", ("phase", "clinical phase", "study phase"), "Phase of the trial"),),
        joins=(
            JoinSpec(OUTCOMES, EFFICACY, ("trial_id", "drug_name", "treatment_arm"), "A patient next to the efficacy of the arm"),
            JoinSpec(EFFICACY, SAFETY, ("trial_id", "drug_name"), "Efficacy next to safety of a drug"),
        ),
        # Wording, columns and conditions of the questions.
        questions=(
            Question(
                "orr_by_drug_arm", "What is the ORR by drug and treatment arm?", EFFICACY,
                columns=("drug_name", "treatment_arm", "total_observations"),
                measures=("responders", "orr_pct"),
                order_by=("orr_pct DESC", "drug_name", "treatment_arm"),
                also_asked=(
                    "Show me the overall response rate for each drug across all treatment arms",
                    "Rank all drugs by their ORR percentage",
                ),
            ),
            Question(
                "trial_comparison", "Compare drug vs. placebo response rates for a specific trial", EFFICACY,
                columns=("drug_name", "treatment_arm", "total_observations", "complete_response_count", "partial_response_count"),
                measures=("orr_pct",),
                where=("trial_id = :trial_id",),
                order_by=("orr_pct DESC", "treatment_arm"),
                defaults={"trial_id": default_trial},
            ),
            Question(
                "safety_profile", "What is the safety profile for each drug?", SAFETY,
                columns=(
                    "drug_name", "total_adverse_events", "serious_event_count", "severe_count", "moderate_count",
                    "mild_count", "avg_risk_score", "fatal_outcome_count",
                ),
                measures=("serious_ae_rate_pct",),
                order_by=("serious_ae_rate_pct DESC", "drug_name"),
                also_asked=(
                    "Show the adverse event breakdown by severity for all drugs",
                    "Which drugs have the highest rate of serious adverse events?",
                ),
            ),
            Question(
                "oncology_orr", "Which drugs have the highest ORR in oncology indications?", EFFICACY,
                columns=("drug_name", "indication", "phase", "treatment_arm"),
                measures=("orr_pct",),
                filters=("oncology trials", "active arms"),
                order_by=("orr_pct DESC", "drug_name", "treatment_arm"),
                also_asked=(
                    "What are the best-performing drugs in cancer indications by response rate?",
                    "Rank oncology drugs by ORR for active treatment arms only",
                ),
            ),
            Question(
                "risk_by_sponsor", "What is the average risk score by sponsor?", SAFETY,
                columns=("sponsor",), measures=("mean_risk_score",), group_by=("sponsor",),
                order_by=("mean_risk_score DESC", "sponsor"),
            ),
            Question(
                "phase3_events", "Which Phase III trials have the most total adverse events?", SAFETY,
                columns=("trial_name", "drug_name", "total_adverse_events", "serious_event_count", "fatal_outcome_count"),
                where=("phase = 'Phase III'",),
                order_by=("total_adverse_events DESC", "trial_name"),
            ),
            Question(
                "complete_by_region", "How many patients had a complete response by drug and region?", OUTCOMES,
                columns=("drug_name", "region"), measures=("complete_responders",),
                where=("response = 'Complete Response'",), group_by=("drug_name", "region"),
                order_by=("complete_responders DESC", "drug_name", "region"),
            ),
            Question(
                "phase2_orr", "What is the ORR for drugs in Phase II trials?", EFFICACY,
                columns=("drug_name", "treatment_arm", "indication"), measures=("orr_pct",),
                where=("phase = 'Phase II'",),
                order_by=("orr_pct DESC", "drug_name", "treatment_arm"),
            ),
        ),
        # Which columns are looked up by value.
        dictionary_columns={
            OUTCOMES: ("drug_name", "treatment_arm", "response", "gender", "region", "trial_id"),
            EFFICACY: ("drug_name", "treatment_arm", "trial_id", "trial_name", "phase", "indication", "sponsor"),
            SAFETY: ("drug_name", "trial_id", "trial_name", "phase", "sponsor", "indication"),
        },
        comments={
            OUTCOMES: {
                "drug_name": "Drug under test",
                "treatment_arm": "Drug, Drug + Standard of Care, Placebo or Standard of Care",
                "response": "Complete Response, Partial Response, Stable Disease or Progressive Disease",
                "gender": "Male or Female",
                "region": "Where the patient lives",
                "trial_id": "Identifier of the trial",
            },
            EFFICACY: {
                "drug_name": "Drug under test",
                "treatment_arm": "Drug, Drug + Standard of Care, Placebo or Standard of Care",
                "trial_id": "Identifier of the trial",
                "trial_name": "Name of the study",
                "phase": "Phase I to Phase IV",
                "indication": "Disease under treatment",
                "sponsor": "Company behind the trial",
            },
            SAFETY: {
                "drug_name": "Drug under test",
                "trial_id": "Identifier of the trial",
                "trial_name": "Name of the study",
                "phase": "Phase I to Phase IV",
                "sponsor": "Company behind the trial",
                "indication": "Disease under treatment",
            },
        },
    )
