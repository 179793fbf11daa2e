import pytest
from pyspark.sql import functions as F

from cohortflow.clinical.vocabulary import ONCOLOGY
from cohortflow.semantic.clinical import EFFICACY, OUTCOMES, SAFETY, clinical_model
from cohortflow.semantic.grading import grade_questions
from cohortflow.semantic.model import Question, SemanticModel, phrases, resolve_terms, smoke_report

MODEL = clinical_model()


def efficacy(spark):
    return spark.createDataFrame(
        [
            ("TRIAL-001", "D", "Drug", 3, 1, 1, ONCOLOGY[0], "Phase II", "S"),
            ("TRIAL-001", "D", "Placebo", 4, 0, 1, ONCOLOGY[0], "Phase II", "S"),
            ("TRIAL-002", "E", "Drug", 0, 0, 0, "COPD", "Phase I", "S"),
        ],
        "trial_id string, drug_name string, treatment_arm string, total_observations long, complete_response_count long, partial_response_count long, indication string, phase string, sponsor string",
    )


def test_rate_over_nothing_is_null_and_one_decimal(spark):
    found = {(r["drug_name"], r["treatment_arm"]): r["orr_pct"] for r in MODEL.term("orr_pct").apply(efficacy(spark)).collect()}
    assert found == {("D", "Drug"): 66.7, ("D", "Placebo"): 25.0, ("E", "Drug"): None}


def test_parameter_is_a_value_and_never_sql(spark):
    tables = {EFFICACY: efficacy(spark)}
    assert MODEL.answer(spark, "trial_comparison", tables).count() == 2
    assert MODEL.answer(spark, "trial_comparison", tables, {"trial_id": "TRIAL-002"}).count() == 1
    assert MODEL.answer(spark, "trial_comparison", tables, {"trial_id": "x' OR '1' = '1"}).count() == 0


def test_oncology_question_keeps_active_arms(spark, rows):
    assert rows(MODEL.answer(spark, "oncology_orr", {EFFICACY: efficacy(spark)}), "drug_name", "treatment_arm") == [("D", "Drug")]


def test_terms_resolve_case_insensitively_as_whole_words(spark, rows):
    asked = spark.createDataFrame([(1, "What is the ORR in Phase II?"), (2, "Are risky drugs dangerous?"), (3, "phases"), (4, "Overall  response rate")], "id int, text string")
    found = rows(resolve_terms(asked, "text", MODEL), "id", "name")
    assert set(found) == {(1, "orr_pct"), (1, "trial_phase"), (2, "high risk"), (4, "orr_pct")}


def test_smoke_report_has_three_states(spark):
    model = SemanticModel(
        questions=(
            Question("good", "", "t", ("id",)),
            Question("none", "", "t", ("id",), where=("id > 100",)),
            Question("wrong", "", "t", ("absent",)),
        )
    )
    assert {r["question"]: r["state"] for r in smoke_report(spark, model, {"t": spark.range(3)}).collect()} == {"good": "passed", "none": "empty", "wrong": "error"}


def counting(spark, n):
    """Rows 0..n-1 and an accumulator of how many were computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return spark.range(n).mapInArrow(count, "id long"), seen


def test_a_table_that_several_questions_ask_is_computed_once(spark):
    questions = tuple(Question(name, "", "t", ("id",), where=(f"id {test} 0",)) for name, test in (("a", ">="), ("b", "<"), ("c", ">")))
    rows, seen = counting(spark, 50)
    assert [r["state"] for r in smoke_report(spark, SemanticModel(questions=questions), {"t": rows}).collect()] == ["passed", "empty", "passed"]
    assert seen.value == 50
    rows, seen = counting(spark, 50)
    references = [(name, f"SELECT id AS x FROM {{t}} WHERE id {test} 0", {}) for name, test in (("a", ">="), ("b", "<"), ("c", ">="))]
    graded = {r["question"]: (r["correct"], r["missing"], r["surplus"], r["n_rows"]) for r in grade_questions(spark, SemanticModel(questions=questions), {"t": rows}, references).collect()}
    assert graded == {"a": (True, 0, 0, 50), "b": (True, 0, 0, 0), "c": (False, 50, 49, 50)}
    assert seen.value == 50


def test_a_table_that_cannot_be_computed_is_reported(spark):
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("broken")).cast("int"))
    questions = (Question("a", "", "t", ("x",), where=("x > 0",)), Question("b", "", "t", ("id",), where=("x < 0",)), Question("c", "", "t", ("id",)))
    assert {r["question"]: r["state"] for r in smoke_report(spark, SemanticModel(questions=questions), {"t": broken}).collect()} == {"a": "error", "b": "error", "c": "passed"}


def test_phrases_split_a_text_once(spark):
    asked = spark.createDataFrame([("Red, blue  bolt!",), ("",), (None,)], "t string").select(phrases(F.col("t"), 2).alias("p"))
    assert [r["p"] for r in asked.collect()] == [["red", "blue", "bolt", "red blue", "blue bolt"], [], []]
    assert asked._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_inventory(spark):
    counts = {r["kind"]: r["n"] for r in MODEL.inventory(spark).collect()}
    assert counts["joins"] == 2 and counts["tables"] == 3 and counts["questions"] == 8 and counts["rephrased questions"] == 6
    assert sum(len(c) for c in MODEL.dictionary_columns.values()) == 19
    assert {t for t in MODEL.comments} == {OUTCOMES, EFFICACY, SAFETY}


def test_a_question_narrowed_to_one_value(spark, rows):
    tables = {EFFICACY: efficacy(spark)}
    assert rows(MODEL.answer(spark, "orr_by_drug_arm", tables, only={"drug_name": "D"}), "treatment_arm") == [("Drug",), ("Placebo",)]
    assert MODEL.answer(spark, "orr_by_drug_arm", tables, only={"drug_name": "D' OR '1' = '1"}).count() == 0
    with pytest.raises(KeyError, match="total_observations"):
        MODEL.answer(spark, "orr_by_drug_arm", tables, only={"total_observations": 3})
