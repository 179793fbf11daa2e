"""Profiling: nulls, descriptive statistics, correlations, histograms, feature types, value dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortflow.operators.report import rounded_mean
from cohortflow.plans.lineage import broadcast_if_small, cut_lineage
from cohortflow.plans.ordered import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def _rows_from(totals: DataFrame, lines: Sequence[Column]) -> DataFrame:
    """Turn the one row of a wide aggregate into one output row per struct."""
    return totals.select(F.inline(F.array(*lines)))


def long_format(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """(extra..., column, value): one row per input row and listed column."""
    lines = [F.struct(F.lit(c).alias("column"), F.col(c).cast(as_type).alias("value")) for c in columns]
    return df.select(*extra, F.inline(F.array(*lines)))


def null_profile(df: DataFrame) -> DataFrame:
    """column, type, n_rows, n_nulls for every column, in one pass."""
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(df.columns)]
    )
    return _rows_from(
        totals,
        [
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("n_rows"),
                F.col(f"_nulls_{i}").alias("n_nulls"),
            )
            for i, field in enumerate(df.schema.fields)
        ],
    )


def _interpolated(quantile: float) -> Column:
    """Linear interpolation between the two order statistics around ``quantile``."""
    position = (F.col("n_total") - 1) * F.lit(quantile)
    low, high = F.floor(position), F.ceil(position)

    def at(rank: Column) -> Column:  # value at a 0-based rank: its run covers (n_upto - n, n_upto]
        return F.max(F.when((rank < F.col("n_upto")) & (rank >= F.col("n_upto") - F.col("n")), F.col("value")))

    share = F.max(position - low)
    return at(low) + (at(high) - at(low)) * share


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = QUARTILES) -> DataFrame:
    """column, q<percent>...: exact, interpolated, nulls left out.

    Values are counted first, then one distributed sort gives every value its rank range, so neither a
    hot value nor a column with as many values as rows ends in one task.
    """
    counted = long_format(df, columns).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    ranked = running_totals(counted, order=["value"], sums=["n"], by=["column"])
    return ranked.groupBy("column").agg(*[_interpolated(q).alias(f"q{round(q * 100)}") for q in quantiles])


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = QUARTILES, accuracy: int = 10_000
) -> DataFrame:
    """The same shape from one pass with bounded sketches (``percentile_approx``)."""
    totals = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(quantiles), accuracy).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    return _rows_from(
        totals,
        [
            F.struct(
                F.lit(c).alias("column"),
                *[F.get(f"_{i}", F.lit(k)).alias(f"q{round(q * 100)}") for k, q in enumerate(quantiles)],
            )
            for i, c in enumerate(columns)
        ],
    )


def describe_numeric(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """column, n, mean, sd, min, q25, q50, q75, max."""
    value = {c: F.col(c).cast("double") for c in columns}
    totals = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(value[c]).alias("n"),
                F.avg(value[c]).alias("mean"),
                F.stddev_samp(value[c]).alias("sd"),
                F.min(value[c]).alias("min"),
                F.max(value[c]).alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    moments = _rows_from(totals, [F.col(f"_{i}") for i in range(len(columns))])
    ranks = exact_quantiles(df, columns) if exact else approximate_quantiles(df, columns)
    # both sides have one row per listed column
    return moments.join(F.broadcast(ranks), "column", "left").select(
        "column", "n", "mean", "sd", "min", "q25", "q50", "q75", "max"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for all ordered pairs of numeric or boolean columns; all coefficients in one aggregate.

    Uses the rows in which both columns are present. Each unordered pair is computed once.
    """
    value = {c: F.col(c).cast("int").cast("double") if dict(df.dtypes)[c] == "boolean" else F.col(c).cast("double") for c in columns}
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    totals = df.agg(*[F.corr(value[columns[i]], value[columns[j]]).alias(f"_{i}_{j}") for i, j in pairs])
    lines = [
        F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"_{min(i, j)}_{max(i, j)}").alias("r"))
        for i in range(len(columns))
        for j in range(len(columns))
    ]
    return _rows_from(totals, lines)


def histogram_by_class(df: DataFrame, columns: str | Sequence[str], label: str, bins: int = 30) -> DataFrame:
    """column, label, bin, lower, upper, n, density: equal bins over each class's own range.

    Two passes for any number of columns: one for the ranges, one for the counts. The last bin includes
    the maximum. A class with a single value gets the range value ± 0.5. Empty bins are not listed.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    rows = df.filter(F.col(label).isNotNull()).select(label, *[F.col(c).cast("double").alias(c) for c in columns])
    spans = rows.groupBy(label).agg(
        *[
            F.struct(
                F.lit(c).alias("column"), F.min(c).alias("_low"), F.max(c).alias("_high"), F.count(c).alias("_n")
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    flat = F.col("_low") == F.col("_high")
    ranges = cut_lineage(
        spans.select(label, F.inline(F.array(*[f"_{i}" for i in range(len(columns))]))).select(
            label,
            "column",
            "_n",
            F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
            F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high"),
        )
    )
    position = F.floor((F.col("value") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins)
    counted = (
        long_format(rows, columns, extra=[label])
        .filter(F.col("value").isNotNull())
        .join(broadcast_if_small(ranges), [label, "column"])
        .groupBy("column", label, F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.first("_low").alias("_low"),
            F.first("_n").alias("_n"),
            F.first((F.col("_high") - F.col("_low")) / bins).alias("_width"),
        )
    )
    return counted.select(
        "column",
        label,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("lower"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("upper"),
        "n",
        (F.col("n") / (F.col("_n") * F.col("_width"))).alias("density"),
    )


#: Which Spark types make up a class of columns.
TYPE_CLASSES = {
    "categorical": (T.StringType,),
    "numeric": (T.NumericType,),
    "boolean": (T.BooleanType,),
}


def names_of_type(df: DataFrame, type_class: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TYPE_CLASSES[type_class])]


def _class_of(field: T.StructField) -> str:
    matches = [name for name, types in TYPE_CLASSES.items() if isinstance(field.dataType, types)]
    return matches[0] if matches else "other"


def columns_by_type(df: DataFrame) -> DataFrame:
    """column, type, type_class — from the schema alone."""
    rows = [(f.name, f.dataType.simpleString(), _class_of(f)) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, type_class string")


def feature_summary(df: DataFrame, target: str, exact: bool = False) -> DataFrame:
    """column, type_class, role, approx_values: what a model would get to see.

    The number of values is a sketch's estimate of one pass, or with ``exact`` (then ``n_values``) counted after equal values of
    each column have met, nulls left out.
    """
    described = [
        F.struct(F.lit(f.name).alias("column"), F.lit(_class_of(f)).alias("type_class"), F.lit("target" if f.name == target else "feature").alias("role"))
        for f in df.schema.fields
    ]
    if exact:
        values = long_format(df, df.columns, as_type="string").filter(F.col("value").isNotNull()).distinct()
        counted = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"))
        lines = df.sparkSession.range(1).select(F.inline(F.array(*described)))
        # one row per column on both sides
        return lines.join(F.broadcast(counted), "column", "left").select("column", "type_class", "role", F.coalesce("n_values", F.lit(0)).alias("n_values"))
    totals = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return _rows_from(totals, [line.withField("approx_values", F.col(f"_{i}")) for i, line in enumerate(described)])


def value_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): the distinct values of text columns, for matching words against them."""
    return (
        long_format(df, columns, as_type="string")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def means_by_group(df: DataFrame, key: str, digits: dict[str, int]) -> DataFrame:
    """Rounded means of several columns per group; booleans count as 0/1."""
    types = dict(df.dtypes)

    def numeric(c: str) -> Column:
        return F.col(c).cast("int") if types[c] == "boolean" else F.col(c)

    return df.groupBy(key).agg(*[rounded_mean(numeric(c), d).alias(f"mean_{c}") for c, d in digits.items()])
