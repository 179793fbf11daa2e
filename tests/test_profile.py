import random
import statistics

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.compare import result_diff
from cohortflow.operators.leakage import leakage_screen
from cohortflow.operators.profile import (
    columns_by_type, correlation_matrix, describe_numeric, exact_quantiles, histogram_by_class, null_profile,
)


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    frame = spark.createDataFrame([(True, float(x)) for x in range(61)], "y boolean, x double")
    bins = {r["bin"]: r for r in histogram_by_class(frame, "x", "y").collect()}
    assert max(bins) == 29 and bins[29]["n"] == 3 and bins[0]["n"] == 2
    assert sum(b["density"] * (b["upper"] - b["lower"]) for b in bins.values()) == pytest.approx(1.0)


def test_histogram_of_one_value(spark):
    frame = spark.createDataFrame([(True, 2.0), (True, 2.0), (False, None)], "y boolean, x double")
    row = histogram_by_class(frame, "x", "y", bins=10).first()
    assert (row["bin"], row["n"]) == (5, 2) and row["density"] == pytest.approx(10.0)


def test_quantiles_match_brute_force_with_hot_values_and_nulls(spark):
    rng = random.Random(1)
    values = [round(rng.gauss(0, 1), 2) for _ in range(400)] + [0.0] * 300
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "x double").repartition(5)
    row = exact_quantiles(frame, ["x"]).first()
    expected = statistics.quantiles(values, n=4, method="inclusive")
    assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(expected)
    summary = describe_numeric(frame, ["x"]).first()
    assert summary["n"] == 700 and summary["mean"] == pytest.approx(statistics.mean(values)) and summary["sd"] == pytest.approx(statistics.stdev(values))
    sketch = describe_numeric(frame, ["x"], exact=False).first()
    assert sketch["q50"] == pytest.approx(expected[1], abs=0.05)


def test_all_null_column_is_described_with_nulls(spark):
    frame = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    found = {r["column"]: r for r in describe_numeric(frame, ["a", "b"]).collect()}
    assert found["a"]["q50"] == 2.0 and found["b"]["n"] == 0 and found["b"]["q50"] is None


def test_correlation_is_symmetric_with_unit_diagonal(spark):
    frame = spark.createDataFrame([(1.0, True, 3), (2.0, False, 1), (4.0, True, 0)], "a double, b boolean, c int")
    r = {(x["a"], x["b"]): x["r"] for x in correlation_matrix(frame, ["a", "b", "c"]).collect()}
    assert len(r) == 9 and r["a", "c"] == r["c", "a"] and r["b", "b"] == pytest.approx(1.0)


def test_null_profile_and_types(spark, rows):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(null_profile(frame), "column", "n_rows", "n_nulls") == [("a", 2, 1), ("b", 2, 2)]
    assert rows(columns_by_type(frame), "column", "type_class") == [("a", "numeric"), ("b", "categorical")]


def test_leak_is_found(spark):
    data = [(i % 2, float(i % 2) + 0.1 * (i % 7), float(i % 5), "x" if i % 2 else "y", "z") for i in range(200)]
    frame = spark.createDataFrame(data, "label int, leak double, noise double, pure string, dull string")
    found = {r["feature"]: r for r in leakage_screen(frame, "label", ["leak", "noise"], ["pure", "dull"]).collect()}
    assert found["leak"]["suspicious"] and not found["noise"]["suspicious"]
    assert found["pure"]["suspicious"] and not found["dull"]["suspicious"]


def test_result_diff_counts_copies(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert rows(result_diff(a, b)) == [(1, "actual only", 1), (2, "actual only", 1), (3, "expected only", 1)]
    assert result_diff(a, a).count() == 0


def test_running_totals_equal_a_window_without_its_shuffle(spark, rows):
    from pyspark.sql import Window

    from cohortflow.plans.ordered import running_totals

    frame = spark.range(0, 4000, 1, 7).select((F.col("id") % 5).cast("string").alias("g"), "id", (F.col("id") % 11).alias("n"), (F.col("id") / 8).alias("x"))
    found = running_totals(frame, ["id"], ["n", "x"], by=["g"])
    assert "hashpartitioning(_part" not in found._jdf.queryExecution().toString()
    inside, whole = Window.partitionBy("g").orderBy("id"), Window.partitionBy("g")
    for c in ("n", "x"):
        frame = frame.withColumn(f"{c}_upto", F.sum(c).over(inside)).withColumn(f"{c}_total", F.sum(c).over(whole))
    columns = ["g", "id", "n_upto", "n_total", "x_upto", "x_total"]
    assert rows(found, *columns) == rows(frame, *columns)
    assert dict(found.dtypes)["n_upto"] == "bigint"
    assert running_totals(frame.limit(0).select("id", "n"), ["id"], ["n"]).count() == 0
