"""Hard negatives against all pairs, at several sizes of steps and blocks."""

import random

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import hard_negatives


def brute(rows, is_anchor):
    known = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v and (i not in known or (label, v) < known[i]):
            known[i] = (label, v)
    score = lambda a, b: sum(x * y for x, y in zip(known[a][1], known[b][1], strict=False))
    out = set()
    for a in filter(is_anchor, known):
        first = lambda found: sorted(found, key=lambda b: (-score(a, b), b))[:5]
        for p in first([b for b in known if b != a and known[b][0] == known[a][0]]):
            fits = [b for b in known if known[b][0] != known[a][0] and 80 * score(a, p) <= 100 * score(a, b) <= 100 * score(a, p)]
            out |= {(a, p, rank, b, score(a, p), score(a, b)) for rank, b in enumerate(first(fits), 1)}
    return out


@pytest.mark.parametrize(("step", "ask", "least"), [(4096, 256, 2048), (7, 3, 40)])
@pytest.mark.parametrize("spread", [1, 30])
def test_against_all_pairs(spark, monkeypatch, step, ask, least, spread):
    monkeypatch.setattr(hard_negatives, "STEP_ROWS", step)
    monkeypatch.setattr(hard_negatives, "STEP_ANCHORS", ask)
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", least)
    rng = random.Random(spread)
    rows = [(i, rng.randrange(4), [rng.randrange(-spread, spread + 1) + 20 * (rng.randrange(9) == 0) for _ in range(12)]) for i in range(400)]
    rows += [(400 + k, 1, [5] * 12) for k in range(60)]  # one very common vector
    rows += [rows[3], (5, 0, [1] * 12), (None, 1, [1] * 12), (900, None, [1] * 12), (901, 2, None), (902, 2, [1, None]), (903, 2, []), (904, 3, [9] * 5), (910, 7, [3] * 12)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "id long, label long, v array<long>, block string").repartition(5)
    found = [tuple(r) for r in hard_negatives.hard_negatives(frame, F.col("id") % 10 == 0).collect()]
    assert len(found) == len({*found})
    assert {*found} == brute(rows, lambda i: i % 10 == 0)


def test_empty(spark):
    frame = spark.createDataFrame([], "id long, label long, v array<long>")
    assert hard_negatives.hard_negatives(frame, F.col("id") % 10 == 0).count() == 0
