"""Components of a group whose members are near, but not all near each other, against all pairs."""

import random

import pytest

from cohortflow.llm import odd_sketch

WIDTH = 4


def brute(rows):
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + WIDTH]) for k in range(len(words) - WIDTH + 1)} or {tuple(words)}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (root(i), len(s)) for i, s in sets.items()}


@pytest.mark.parametrize("rounds", [0, 2])
def test_a_group_of_near_copies_in_small_blocks(spark, monkeypatch, rounds):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i * 3 + 1, " ".join(words)))
    rows += [(1000 + k, "Short text") for k in range(3)] + [(2000, "short TEXT"), (2001, "short texts"), (2002, " ".join(base))]
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    monkeypatch.setattr(odd_sketch, "ROUNDS", rounds)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in odd_sketch.near_duplicates(docs, width=WIDTH).collect()}
    assert found == brute(rows)


@pytest.mark.parametrize("repeat", [False, True])
def test_rows_without_an_id_are_documents_of_their_own(spark, repeat):
    def text(k, change=None):
        return " ".join("changed" if n == change else f"w{k}x{n}" for n in range(80))

    rows = [(1, text(1)), (2, text(2)), (None, text(3)), (None, text(4)), (None, text(4)), (None, text(4, 0)), (None, text(2)), (None, text(1, 79)), (None, ""), (None, None)]
    rows += [(1, text(1))] if repeat else []
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    found = [tuple(r) for r in odd_sketch.drop_near_duplicates(docs).collect()]
    assert sorted(i for i, _ in found if i) == [1, 2]
    unnamed = [t for i, t in found if i is None]
    assert len(unnamed) == 4 and {text(3), "", None} < {*unnamed}
    assert len({text(4), text(4, 0)} & {*unnamed}) == 1


def test_sketch_bound_keeps_similar_pairs():
    assert odd_sketch.estimate(odd_sketch.most_bits(0.8)) < 0.7
