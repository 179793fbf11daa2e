"""Additive risk scores, severity buckets and the label rule, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from cohortflow.functions.scalars import clamp_low


@dataclass(frozen=True)
class RiskRules:
    """``linear``: (column, centre, slope). ``steps``: (predicate, points), all that hold are added."""

    linear: Sequence[tuple[str, float, float]] = ()
    steps: Sequence[tuple[str, float]] = ()
    buckets: Sequence[tuple[float, str]] = field(default=())
    otherwise: str = ""


# Fixed values of the rule.
CLINICAL_RULES = RiskRules(
    linear=(
        ("age", 40, 0.03),
        ("dosage_mg", 150, 0.008),
        ("num_pre_existing", 0, 0.8),
    ),
    steps=(
        ("bmi < 18.5 OR bmi > 32", 1.5),
        ("bmi > 28 AND bmi <= 32", 0.7),
        ("baseline_alt_iu_l > 40", 1.2),
        ("baseline_alt_iu_l > 60", 1.0),
        ("baseline_creatinine_mg_dl > 1.3", 0.9),
        ("drug_interaction_flag", 2.5),
    ),
    buckets=((3.5, "Severe"), (1.5, "Moderate")),
    otherwise="Mild",
)
ALWAYS_SERIOUS_TYPES = ["Anaphylaxis", "Cardiac Arrhythmia", "Liver Injury"]
REDRAWN_SERIOUS_TYPES = [
    "Liver Injury", "Neutropenia", "Anaphylaxis", "Cardiac Arrhythmia", "Renal Impairment", "Thrombocytopenia",
]
REDRAW_ABOVE = 0.4


def risk_points(rules: RiskRules = CLINICAL_RULES, noise: Column | None = None) -> Column:
    """The unrounded score. A null input adds nothing for a step and makes a linear term null."""
    total = F.lit(0.0)
    for column, centre, slope in rules.linear:
        total = total + (F.col(column) - centre) * slope
    for predicate, points in rules.steps:
        total = total + F.when(F.expr(predicate), points).otherwise(0.0)
    return total if noise is None else total + noise


def rounded_score(points: Column, digits: int = 2) -> Column:
    """Rounded for display; adding zero turns a negative zero into zero."""
    return F.round(points, digits) + F.lit(0.0)


def severity_bucket(points: Column, rules: RiskRules = CLINICAL_RULES) -> Column:
    """Bucket of the unrounded score: strictly above a bound. A null score has no bucket."""
    chain = F.when(points.isNull(), F.lit(None).cast("string"))
    for bound, name in rules.buckets:
        chain = chain.when(points > bound, name)
    return chain.otherwise(rules.otherwise)


def serious_label(severity: Column, ae_type: Column, types: Sequence[str] = tuple(ALWAYS_SERIOUS_TYPES)) -> Column:
    return (severity == "Severe") | ae_type.isin(*types)


def override_category(category: Column, condition: Column, chance: Column, redraw: Column, above: float = REDRAW_ABOVE) -> Column:
    """``redraw`` where the condition holds and ``chance`` lies above the limit, else ``category``."""
    return F.when(condition & (chance > above), redraw).otherwise(category)


def projected_lab(baseline: Column, dosage_mg: Column, low: float = 5.0, slope: float = 0.02, noise: Column | None = None) -> Column:
    """Lab value under treatment: baseline plus a dose effect, not below ``low``."""
    value = baseline + dosage_mg * slope
    return clamp_low(value if noise is None else value + noise, low)
