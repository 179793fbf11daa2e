import pytest
from pyspark.sql import Observation, functions as F

from cohortflow.clinical.silver import ADVERSE_EVENTS, PATIENTS, to_silver, typed_columns
from cohortflow.operators.quality import (
    Expectation, apply_expectations, assert_probability, expect_or_drop, expect_warn, quality_report,
)


def events(spark, data):
    frame = spark.createDataFrame(data, "event_id string, patient_id string, onset_date string")
    for c in ADVERSE_EVENTS.columns:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(None).cast("string"))
    return frame


def test_null_keys_are_dropped_and_counted_by_their_own_rule(spark, rows):
    frame = events(spark, [("a", "p", "2020-01-01"), (None, "p", "2020-01-01"), ("b", None, "2020-01-01"), (None, None, None)])
    assert rows(to_silver(frame, ADVERSE_EVENTS), "event_id") == [("a",)]
    report = {r["rule"]: (r["passed"], r["failed"], r["dropped"]) for r in quality_report(typed_columns(frame, ADVERSE_EVENTS), ADVERSE_EVENTS.rules).collect()}
    assert report["valid_event_id"] == (2, 2, 2)
    assert report["valid_patient_id"] == (2, 2, 2)
    assert report["valid_onset_date"] == (3, 1, 0)


def test_bad_date_is_kept_as_null_and_counted(spark):
    frame = events(spark, [("a", "p", "bad"), ("b", "p", "2020-02-29")])
    seen = Observation("warned")
    kept = expect_warn(to_silver(frame, ADVERSE_EVENTS), ADVERSE_EVENTS.rules, seen).select("event_id", "onset_date")
    dates = {r["event_id"]: r["onset_date"] for r in kept.collect()}
    assert dates["a"] is None and str(dates["b"]) == "2020-02-29"
    assert seen.get == {"rows": 2, "valid_onset_date": 1}


def test_age_edges_violate_but_stay(spark):
    frame = spark.createDataFrame([(0,), (1,), (119,), (120,), (None,)], "age int")
    rule = [r for r in PATIENTS.rules if r.name == "valid_age"]
    assert expect_or_drop(frame, rule).count() == 5
    assert quality_report(frame, rule).first()["failed"] == 3


def test_score_outside_unit_interval_fails_even_when_pruned(spark):
    good = spark.createDataFrame([(0.0, 1), (1.0, 2)], "p double, id int")
    assert assert_probability(good, "p").count() == 2
    bad = spark.createDataFrame([(0.2, 1), (1.2, 2)], "p double, id int")
    with pytest.raises(Exception, match="expectation failed"):
        assert_probability(bad, "p").select("id").collect()


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def test_fail_rule_sees_rows_after_drop_rules(spark):
    frame = spark.createDataFrame([(1,), (None,)], "x int")
    rules = [Expectation("has x", "x IS NOT NULL", "drop"), Expectation("positive", "x > 0", "fail")]
    assert apply_expectations(frame, rules).count() == 1
