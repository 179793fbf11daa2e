import pytest
from pyspark.sql import functions as F

from cohortflow.functions import risk, scalars


def test_severity_edges_use_the_unrounded_score(spark):
    frame = spark.createDataFrame([(1.5,), (1.5001,), (3.5,), (3.504,), (None,)], "p double")
    found = [tuple(r) for r in frame.select(risk.severity_bucket(F.col("p")), risk.rounded_score(F.col("p"))).collect()]
    assert found == [("Mild", 1.5), ("Moderate", 1.5), ("Moderate", 3.5), ("Severe", 3.5), (None, None)]


BASE = dict(age=40, dosage_mg=150, num_pre_existing=0, bmi=22.0, baseline_alt_iu_l=30.0, baseline_creatinine_mg_dl=1.0, drug_interaction_flag=False)


@pytest.mark.parametrize(
    "change, points",
    [({"bmi": b}, p) for b, p in ((18.4, 1.5), (18.5, 0), (28.0, 0), (28.1, 0.7), (32.0, 0.7), (32.1, 1.5))]
    + [({"baseline_alt_iu_l": a}, p) for a, p in ((40.0, 0), (41.0, 1.2), (61.0, 2.2))]
    + [({"baseline_creatinine_mg_dl": 1.31}, 0.9), ({"drug_interaction_flag": True}, 2.5), ({"age": 50}, 0.3), ({"dosage_mg": 250}, 0.8), ({"num_pre_existing": 2}, 1.6)],
)
def test_risk_points(spark, change, points):
    row = {**BASE, **change}
    frame = spark.createDataFrame([tuple(row.values())], "age int, dosage_mg int, num_pre_existing int, bmi double, baseline_alt_iu_l double, baseline_creatinine_mg_dl double, drug_interaction_flag boolean")
    assert frame.select(risk.risk_points()).first()[0] == pytest.approx(points)


def test_conditions(spark):
    frame = spark.createDataFrame([(["None"],), (["CKD", "CKD", "None"],), ([],)], "c array<string>")
    kept = scalars.distinct_or_default(F.col("c"), "None")
    found = [tuple(r) for r in frame.select(kept, scalars.count_without(kept, "None")).collect()]
    assert found == [(["None"], 0), (["CKD"], 1), (["None"], 0)]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.parse_date(F.lit("2020-13-01")).alias("bad"),
        scalars.format_id("PAT", F.lit(7), 5).alias("short"),
        scalars.format_id("PAT", F.lit(1234567), 5).alias("long"),
        scalars.bmi(F.lit(80.0), F.lit(0.0)).alias("no_height"),
        scalars.iso_date_after("2024-02-28", F.lit(2)).alias("day"),
        scalars.letter(F.lit(2)).alias("letter"),
        scalars.null_unless_contains(F.lit(1), F.lit("Breast Cancer"), "Cancer").alias("hit"),
        scalars.null_unless_contains(F.lit(1), F.lit("COPD"), "Cancer").alias("miss"),
        scalars.threshold_class(F.lit(0.5)).alias("half"),
    ).first()
    assert row.asDict() == dict(bad=None, short="PAT-00007", long="PAT-1234567", no_height=None, day="2024-03-01", letter="C", hit=1, miss=None, half=1)


def test_stable_ids_tell_parts_and_nulls_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("x", None), (None, "x"), ("", None), (None, "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert frame.select(scalars.stable_id(F.col("a"), F.col("b")).alias("i")).distinct().count() == len(rows)
