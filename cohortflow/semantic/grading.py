"""Grading an answer against its reference when neither column names nor the last digits agree."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortflow.plans.lineage import cut_lineage, stored_once
from cohortflow.semantic.model import SemanticModel

MEASURED = ("double", "float", "decimal")


def _measured(kind: str) -> bool:
    return kind.startswith(MEASURED)


def _exact(column: Column, kind: str) -> Column:
    """Whole numbers, texts, dates and flags as one text form, so that 3 and 3L are the same."""
    return F.coalesce(column.cast("long").cast("string") if kind in ("tinyint", "smallint", "int", "bigint") else column.cast("string"), F.lit("\u0000"))


def column_profiles(df: DataFrame) -> dict[str, tuple]:
    """What is known of each column whatever its name: kind, and an order-free digest of its values or its moments. One pass."""
    terms = []
    for at, (name, kind) in enumerate(df.dtypes):
        column = F.col(f"`{name}`")
        if _measured(kind):
            value = column.cast("double")
            terms += [F.count(value).alias(f"n{at}"), F.min(value).alias(f"a{at}"), F.max(value).alias(f"b{at}"), F.sum(value).alias(f"s{at}")]
        else:
            terms.append(F.sum(F.xxhash64(_exact(column, kind)).cast("decimal(20,0)")).cast("string").alias(f"h{at}"))
    row = df.agg(F.count(F.lit(1)).alias("rows"), *terms).first()
    return {
        name: ("measured", row[f"n{at}"], row[f"a{at}"], row[f"b{at}"], row[f"s{at}"]) if _measured(kind) else ("exact", row["rows"], row[f"h{at}"])
        for at, (name, kind) in enumerate(df.dtypes)
    }


def _alike(x: tuple, y: tuple, tolerance: float) -> bool:
    """Whether two columns may hold the same values."""
    if x[0] != y[0] or x[1] != y[1]:
        return False
    if x[0] == "exact":
        return x[2] == y[2]
    bounds = [1, 1, max(x[1], 1)]
    return all((a is None) == (b is None) and (a is None or a == b or abs(a - b) <= 2 * tolerance * n + 1e-9 * abs(a)) for a, b, n in zip(x[2:], y[2:], bounds, strict=True))


def column_matches(actual: Mapping[str, tuple], expected: Mapping[str, tuple], tolerance: float) -> Iterator[dict[str, str]]:
    """Ways to pair all columns (expected -> actual) that agree in their profiles; equal names are tried first."""
    options = {e: sorted((a for a in actual if _alike(actual[a], p, tolerance)), key=lambda a, e=e: (a.lower() != e.lower(), a)) for e, p in expected.items()}
    order = sorted(expected, key=lambda e: len(options[e]))

    def extend(at: int, taken: dict[str, str]) -> Iterator[dict[str, str]]:
        if at == len(order):
            yield dict(taken)
            return
        for a in options[order[at]]:
            if a not in taken.values():
                yield from extend(at + 1, {**taken, order[at]: a})

    if len(actual) == len(expected):
        yield from extend(0, {})


def rows_apart(actual: DataFrame, expected: DataFrame, pairs: Mapping[str, str], tolerance: float) -> DataFrame:
    """missing, surplus: rows of one side without a partner on the other.

    Rows meet by the exact columns and their rank among rows with the same ones, ordered by the measured columns; these may then differ
    by ``tolerance`` each.
    """
    kinds = dict(expected.dtypes)
    exact, measured = [e for e in pairs if not _measured(kinds[e])], [e for e in pairs if _measured(kinds[e])]

    def side(df: DataFrame, name_of, at: str) -> DataFrame:
        own = dict(df.dtypes)
        key = F.xxhash64(F.lit(0), *[_exact(F.col(f"`{name_of(e)}`"), own[name_of(e)]) for e in exact])
        values = [F.col(f"`{name_of(e)}`").cast("double").alias(f"_m{n}_{at}") for n, e in enumerate(measured)]
        rows = df.select(key.alias("_key"), *values)
        order = [F.col(f"_m{n}_{at}") for n in range(len(measured))] or [F.lit(0)]
        return rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).withColumn(f"_in_{at}", F.lit(True))

    both = side(actual, lambda e: pairs[e], "a").join(side(expected, lambda e: e, "e"), ["_key", "_rank"], "full_outer")
    near = F.lit(True)
    for n in range(len(measured)):
        a, e = F.col(f"_m{n}_a"), F.col(f"_m{n}_e")
        near = near & (a.eqNullSafe(e) | F.coalesce(F.abs(a - e) <= tolerance * (1 + 1e-9), F.lit(False)))
    in_a, in_e = F.col("_in_a").isNotNull(), F.col("_in_e").isNotNull()
    apart = ~(in_a & in_e & near)
    return both.agg(F.count_if(in_e & apart).alias("missing"), F.count_if(in_a & apart).alias("surplus"))


def grade(actual: DataFrame, expected: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """correct, missing, surplus, n_rows (of the reference): one row.

    Columns are paired by what they hold; several possible pairings are tried until one leaves no row apart. If there is none, the closest
    pairing's rows are reported; without any pairing all rows are missing and surplus.
    """
    actual, expected = cut_lineage(actual), cut_lineage(expected)
    found, wanted = column_profiles(actual), column_profiles(expected)
    n_actual, n_rows, best = actual.count(), expected.count(), None
    for pairs in column_matches(found, wanted, tolerance):
        row = rows_apart(actual, expected, pairs, tolerance).first()
        result = (row["missing"], row["surplus"])
        best = result if best is None else min(best, result)
        if best == (0, 0):
            break
    missing, surplus = best if best is not None else (n_rows, n_actual)
    correct = best == (0, 0)
    return actual.sparkSession.createDataFrame([(correct, missing, surplus, n_rows)], "correct boolean, missing long, surplus long, n_rows long")


def grade_questions(spark: SparkSession, model: SemanticModel, tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, Mapping]], tolerance: float = 0.05) -> DataFrame:
    """question, correct, missing, surplus, n_rows for every (stored question, reference SQL, parameters).

    The reference names its tables as {placeholders} and its parameters as :markers. Every table is read by an answer and by its reference
    at least, so each is computed once and stored.
    """
    tables = stored_once(tables, {model.question(name).source for name, _, _ in references} | {t for _, sql, _ in references for t in tables if f"{{{t}}}" in sql})
    parts = []
    for name, sql, args in references:
        answer = model.answer(spark, name, tables, args)
        reference = spark.sql(sql, args=dict(args) or None, **{t: tables[t] for t in tables if f"{{{t}}}" in sql})
        parts.append(grade(answer, reference, tolerance).select(F.lit(name).alias("question"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
