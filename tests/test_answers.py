"""Misspelt values and graded answers."""

import random

import pytest

from cohortflow.semantic.entities import match_values
from cohortflow.semantic.grading import grade


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_matches_equal_all_pairs(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aab") for _ in range(rng.randrange(1, 12)))
    values = sorted({word() for _ in range(60)} | {"Stable Disease", "aaaa", "é"})
    asked = [(n, " ".join(word() for _ in range(4))) for n in range(40)] + [(90, "stabel disease, please"), (91, None), (92, ""), (93, "É aaab"), (93, "É aaab")]
    dictionary = spark.createDataFrame([("c", v) for v in values] + [("d", "aaaa"), ("c", "")], "column string, value string")
    found = {(r["id"], r["phrase"], r["column"], r["value"], r["distance"]) for r in match_values(spark.createDataFrame(asked, "id int, t string"), "t", dictionary).collect()}
    expected = set()
    for n, text in asked:
        words = (text or "").lower().replace(",", "").split()
        for phrase in {*words, *(" ".join(p) for p in zip(words, words[1:], strict=False))}:
            for column, value in [("c", v) for v in values] + [("d", "aaaa")]:
                distance = edit_distance(phrase, value.lower())
                if distance <= (2 if len(value) >= 9 else 1 if len(value) >= 4 else 0):
                    expected.add((n, phrase, column, value, distance))
    assert found == expected and (90, "stabel disease", "c", "Stable Disease", 2) in found


def test_rows_of_one_file_are_matched_by_all_cores(spark, tmp_path):
    spark.range(40).selectExpr("id", "concat('bolt ', id) AS t").coalesce(1).write.parquet(str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked"))
    found = match_values(asked, "t", spark.createDataFrame([("c", "bolt")], "column string, value string"))
    assert asked.rdd.getNumPartitions() == 1 and found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in found.filter("phrase = 'bolt'").collect()) == [*range(40)]


def graded(spark, actual, a, expected, e, **more):
    row = grade(spark.createDataFrame(actual, a), spark.createDataFrame(expected, e), **more).first()
    return row["correct"], row["missing"], row["surplus"], row["n_rows"]


@pytest.mark.parametrize(
    ("actual", "a", "result"),
    [
        ([("x", 1, 2.0), ("y", 2, 3.04), ("y", 2, 3.0)], "name string, n int, rate double", (True, 0, 0, 3)),
        ([(3.0, "y", 2), (3.04, "y", 2), (2.01, "x", 1)], "p double, q string, r long", (True, 0, 0, 3)),  # other order and names
        ([("x", 1, 2.0), ("y", 2, 3.2), ("y", 2, 3.0)], "name string, n int, rate double", (False, 3, 3, 3)),  # no column can be the rate
        ([("x", 2, 2.0), ("y", 1, 3.04), ("y", 2, 3.0)], "name string, n int, rate double", (False, 2, 2, 3)),  # right columns, wrong rows
        ([("x", 1, 2.0), ("y", 2, 3.0)], "name string, n int, rate double", (False, 3, 2, 3)),
        ([("x", 1)], "name string, n int", (False, 3, 1, 3)),
    ],
)
def test_grades(spark, actual, a, result):
    assert graded(spark, actual, a, [("x", 1, 2.0), ("y", 2, 3.0), ("y", 2, 3.0)], "d string, k int, s double") == result


def test_nulls_empty_answers_and_columns_alike(spark):
    assert graded(spark, [(None, None), ("a", 1.0)], "x string, y double", [("a", 1.0), (None, None)], "p string, q double")[0]
    assert not graded(spark, [(None, 1.0), ("a", None)], "x string, y double", [("a", 1.0), (None, None)], "p string, q double")[0]
    assert graded(spark, [], "x string", [], "p string") == (True, 0, 0, 0)
    # two columns hold the same values in another order of rows: only one pairing fits
    assert graded(spark, [(1, 2, "a"), (2, 1, "b")], "u int, v int, w string", [(2, 1, "a"), (1, 2, "b")], "p int, q int, r string")[0]
