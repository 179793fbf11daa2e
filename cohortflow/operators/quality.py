"""Row quality rules: drop violators, keep and count them, or fail.

A rule is a SQL predicate over the output columns. A null predicate counts as a violation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

ACTIONS = ("drop", "warn", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Keep the rows that meet every drop rule.

    Bare predicates (a filter treats null as false anyway), so that Catalyst can push them to the scan.
    """
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.predicate)
    return df


def expect_warn(df: DataFrame, rules: Sequence[Expectation], observation: Observation) -> DataFrame:
    """Keep all rows; violation counts of the warn rules arrive in ``observation`` with the first action.

    For plans that run once. Below a range sort, whose sampling runs its input twice, use ``quality_report``.
    """
    counts = [F.count_if(~r.holds).alias(r.name) for r in rules if r.action == "warn"]
    return df.observe(observation, F.count("*").alias("rows"), *counts)


def apply_expectations(
    df: DataFrame, rules: Sequence[Expectation], observation: Observation | None = None
) -> DataFrame:
    """Drop rules filter, fail rules raise while the job runs, warn rules are counted on the way."""
    kept = expect_or_drop(df, rules)
    for rule in rules:
        if rule.action == "fail":
            # the assertion must sit in a predicate of its own, or column pruning would remove it
            kept = kept.filter(F.when(rule.holds, True).otherwise(F.raise_error(F.lit(f"expectation failed: {rule.name}"))))
    if observation is not None:
        kept = expect_warn(kept, rules, observation)
    return kept


def quality_report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """rule, action, passed, failed, dropped — one pass over ``df`` for all rules.

    ``dropped`` counts the rows the rule itself removes; a row that breaks two drop rules is counted by both.
    """
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(~r.holds).alias(f"_failed_{i}") for i, r in enumerate(rules)]
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("_rows") - F.col(f"_failed_{i}")).alias("passed"),
            F.col(f"_failed_{i}").alias("failed"),
            (F.col(f"_failed_{i}") if r.action == "drop" else F.lit(0).cast("bigint")).alias("dropped"),
        )
        for i, r in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*lines)))


def assert_probability(df: DataFrame, column: str) -> DataFrame:
    """``df`` unchanged; the job fails on a score outside [0, 1] or a null score."""
    return apply_expectations(df, [Expectation(f"{column} is a probability", f"{column} BETWEEN 0 AND 1", "fail")])
