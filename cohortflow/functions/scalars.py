"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(text: Column) -> Column:
    """ISO date text to date; bad text becomes null instead of failing the job."""
    return F.try_to_date(text)


def bmi(weight_kg: Column, height_cm: Column, digits: int = 1) -> Column:
    """Body-mass index; null for a zero height."""
    return F.round(F.try_divide(weight_kg, F.pow(height_cm / 100, F.lit(2))), digits)


def clamp_low(value: Column, low: float) -> Column:
    return F.greatest(value, F.lit(low))


def format_id(prefix: str, number: Column, width: int) -> Column:
    """``PAT-00042`` style identifiers; wider numbers keep all digits."""
    return F.format_string(f"{prefix}-%0{width}d", number)


def letter(number: Column) -> Column:
    """0 -> A, 1 -> B, ..."""
    return F.char(number + 65)


def iso_date_after(start: str, days: Column) -> Column:
    """ISO text of ``start`` plus a number of days."""
    return F.date_format(F.date_add(F.lit(start).cast("date"), days), "yyyy-MM-dd")


def null_unless_contains(value: Column, text: Column, part: str) -> Column:
    return F.when(F.contains(text, F.lit(part)), value)


def without(items: Column, unwanted: str) -> Column:
    return F.filter(items, lambda item: item != unwanted)


def count_without(items: Column, unwanted: str) -> Column:
    return F.size(without(items, unwanted))


def distinct_or_default(items: Column, default: str) -> Column:
    """Distinct items other than ``default``; ``[default]`` if none is left."""
    kept = F.array_distinct(without(items, default))
    return F.when(F.size(kept) == 0, F.array(F.lit(default))).otherwise(kept)


def threshold_class(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def stable_id(*parts: Column) -> Column:
    """32 hex characters that depend on the parts only.

    Each part comes with its length and null has a mark of its own, so that moving a separator or a null gives another id.
    """
    texts = [p.cast("string") for p in parts]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))
