import datetime

from cohortflow.clinical import gold
from cohortflow.operators.joins import check_many_to_one, flag_known_pairs, pair_condition, pair_table
from cohortflow.operators.latest import latest_per_group
from cohortflow.operators.report import group_report, percentage, rate_by_category, top_k, value_counts
from pyspark.sql import functions as F

EVENT = "trial_id string, drug_name string, patient_id string, serious boolean, severity string, risk_score double, drug_interaction_flag boolean, outcome string"
TRIAL = "trial_id string, trial_name string, phase string, sponsor string, indication string"


def test_safety_summary_counts_nulls_as_zero_and_keeps_unknown_trials(spark):
    events = spark.createDataFrame(
        [
            ("T1", "D", "p1", True, "Severe", 4.0, True, "Fatal"),
            ("T1", "D", "p2", None, "Mild", 1.0, None, "Recovered"),
            ("T2", "D", "p1", False, "Moderate", None, False, "Unknown"),
        ],
        EVENT,
    )
    trials = spark.createDataFrame([("T1", "Study", "Phase I", "S", "I")], TRIAL)
    found = {r["trial_id"]: r for r in gold.trial_safety_summary(events, trials).collect()}
    one, two = found["T1"], found["T2"]
    assert (one["total_adverse_events"], one["serious_event_count"], one["drug_interaction_count"], one["fatal_outcome_count"]) == (2, 1, 1, 1)
    assert (one["severe_count"], one["moderate_count"], one["mild_count"], one["avg_risk_score"]) == (1, 0, 1, 2.5)
    assert two["total_adverse_events"] == 1 and two["avg_risk_score"] is None and two["trial_name"] is None


def results(spark, data):
    frame = spark.createDataFrame(data, "result_id string, patient_id string, trial_id string, visit_number int, visit_date string, response string")
    frame = frame.withColumn("visit_date", F.to_date("visit_date"))
    for c in gold.VISIT_COLUMNS:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(None).cast("string" if c in ("drug_name", "treatment_arm") else "double"))
    return frame


def test_patient_outcomes_take_the_latest_visit_with_ties_decided(spark):
    visits = results(
        spark,
        [
            ("R1", "p1", "T1", 2, "2020-01-01", "a"),
            ("R2", "p1", "T1", 2, "2020-03-01", "b"),
            ("R3", "p1", "T1", 2, "2020-03-01", "c"),
            ("R4", "p1", "T1", 1, "2021-01-01", "d"),
            ("R5", "p2", "T1", 1, "2020-01-01", "e"),
        ],
    )
    patients = spark.createDataFrame([("p1", 40, "Male", "Asia", 20.0, 1)], "patient_id string, age int, gender string, region string, bmi double, num_pre_existing int")
    events = spark.createDataFrame([("T1", "D", "p1", None, "Mild", 1.0, False, "x")], EVENT)
    found = {r["patient_id"]: r for r in gold.patient_outcomes(visits, patients, events).collect()}
    assert found["p1"]["response"] == "c" and found["p1"]["adverse_event_count"] == 1 and found["p1"]["serious_ae_count"] == 0
    assert found["p1"]["visit_date"] == datetime.date(2020, 3, 1)
    assert found["p2"]["age"] is None and found["p2"]["adverse_event_count"] is None and found["p2"]["serious_ae_count"] is None


def test_latest_row_is_limited_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    latest = latest_per_group(frame, ["k"], ["id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert sorted(r["id"] for r in latest.collect()) == [998, 999]


def test_event_counts_join_adds_no_shuffle_on_the_visit_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        visits = results(spark, [("R1", "p1", "T1", 2, "2020-01-01", "a")])
        patients = spark.createDataFrame([("p1", 40, "Male", "Asia", 20.0, 1)], "patient_id string, age int, gender string, region string, bmi double, num_pre_existing int")
        events = spark.createDataFrame([("T1", "D", "p1", None, "Mild", 1.0, False, "x")], EVENT)
        plan = gold.patient_outcomes(visits, patients, events)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # visits once by (patient, trial), event counts once, then both sides of the patient join
    assert plan.count("Exchange hashpartitioning") == 4


def outcome_tables(spark):
    """Null and repeated keys, ties, pairs with events only and patients that are listed twice or not at all."""
    visits = results(
        spark,
        [(f"R{i}", None if i % 11 == 0 else f"p{i % 5}", None if i % 13 == 0 else f"T{i % 7}", i % 3, "2020-01-01", f"a{i}") for i in range(200)],
    )
    patients = spark.createDataFrame(
        [("p1", 40, "Male", "Asia", 20.0, 1), ("p1", 41, "Male", "Asia", 21.0, 2), ("p2", 50, None, "Asia", 22.0, 3), (None, 60, "Male", "Asia", 23.0, 4)],
        "patient_id string, age int, gender string, region string, bmi double, num_pre_existing int",
    )
    rows = [(None if i % 17 == 0 else f"T{i % 9}", "D", None if i % 11 == 0 else f"p{i % 6}", i % 2 == 0, "Mild", 1.0, True, "x") for i in range(60)]
    return visits, patients, spark.createDataFrame([*rows, ("T0", "D", "p0", None, "Mild", 1.0, None, "x")], EVENT)


def test_outcomes_of_many_patients_are_the_same_rows(spark, monkeypatch):
    tables = outcome_tables(spark)
    few = gold.patient_outcomes(*tables).collect()
    monkeypatch.setattr(gold, "is_small", lambda df: False)
    many = gold.patient_outcomes(*tables)
    assert len(few) > 40 and any(r["serious_ae_count"] for r in few) and sorted(map(str, many.collect())) == sorted(map(str, few))


def test_wide_visits_move_once_where_patients_are_many(spark, monkeypatch):
    monkeypatch.setattr(gold, "is_small", lambda df: False)
    plan = gold.patient_outcomes(*outcome_tables(spark))._jdf.queryExecution().executedPlan().toString()
    # the event counts, the visits with them, and the patients: no shuffle above the window
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Exchange" not in plan[: plan.index("WindowGroupLimit")]


def test_rounded_mean_rounds_half_up_whatever_the_order(spark):
    values = [3.1, 3.05, 3.1, 3.05] * 25
    for order in (values, values[::-1], sorted(values)):
        frame = spark.createDataFrame([("g", v) for v in order], "g string, v double").repartition(3)
        assert group_report(frame, ["g"], means={"m": ("v", 2)}).first()["m"] == 3.08


def test_percentage_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(1, 3), (1, 0)], "a int, b int")
    assert [r[0] for r in frame.select(percentage(F.col("a"), F.col("b"))).collect()] == [33.3, None]


def test_shares_and_rates(spark, rows):
    frame = spark.createDataFrame([("a", True), ("a", False), ("b", None), ("b", True)], "k string, y boolean")
    assert rows(value_counts(frame, "k")) == [("a", 2, 0.5), ("b", 2, 0.5)]
    assert rows(rate_by_category(frame, "k", "y")) == [("a", 2, 0.5, 2 / 3), ("b", 1, 1.0, 2 / 3)]


def test_top_k_breaks_ties(spark, rows):
    frame = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "k string, m double")
    assert [r["k"] for r in top_k(frame, "m", 3, ["k"]).collect()] == ["d", "a", "b"]


def test_pair_flags_agree_and_null_is_no_pair(spark, rows):
    pairs = {"A": ["B", "C"]}
    frame = spark.createDataFrame([("A", "B"), ("B", "A"), ("A", None), ("A", "C")], "x string, y string")
    by_join = flag_known_pairs(frame, pair_table(spark, pairs, "x", "y"), "x", "y", "f")
    by_test = frame.withColumn("f", pair_condition(pairs, F.col("x"), F.col("y")))
    assert rows(by_join, "x", "y", "f") == rows(by_test, "x", "y", "f")
    assert by_test.filter("f").count() == 2


def test_broken_many_to_one_names_the_key(spark, rows):
    frame = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(check_many_to_one(frame, ["k"])) == [(1, 2)]


def test_salted_join_keeps_every_fact_and_splits_the_hot_key(spark, rows):
    from cohortflow.operators.joins import join_dim, join_dim_salted

    fact = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    fact = fact.unionByName(spark.createDataFrame([(None, -1)], "k long, id long"))
    dim = fact.filter("k % 2 = 1").groupBy("k").agg(F.count("*").alias("n"))
    salted = join_dim_salted(fact, dim, ["k"], ["n"], rows_per_task=50)
    assert rows(salted, "k", "id", "n") == rows(join_dim(fact, dim, ["k"], ["n"]), "k", "id", "n")
    assert salted.count() == 3001
