"""Byte contexts against a plain trie, base scores against plain counts."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from cohortflow.llm.ppm import language_scores

TEXTS = [
    (0, "the cat sat on the mat"), (1, "The dog sat\ton the log"), (2, None), (3, ""), (4, "abracadabra abracadabra"), (5, "zq éè 中"),
    (6, "the cat sat on the mat"), (6, "the cat sat on the mat"), (7, "   "), (8, "aaaaaaaaaaaaaaaa"), (9, "unseen \x7f words ##"), (None, "no id at all"),
]
SCHEMA = "doc_id long, text string, row string"


def symbols(text, order):
    return [0] * order + [b + 1 for b in (text or "").encode().lower()] + [257]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute(rows, order):
    trie = defaultdict(Counter)
    words, n = Counter(), 0
    for doc_id, text in rows:
        if held(doc_id):
            continue
        s = symbols(text, order)
        for t in range(order, len(s)):
            for j in range(order + 1):
                trie[tuple(s[t - j : t])][s[t]] += 1
        words.update((text or "").encode().lower().split())
        words[b""] += 1
    n, v = sum(words.values()), len(words)

    def probability(context, symbol):
        out, excluded = 1.0, set()
        for j in range(len(context), -1, -1):
            seen = {s: c for s, c in trie.get(tuple(context[len(context) - j :]), {}).items() if s not in excluded}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if symbol in seen:
                return out * seen[symbol] / total
            out *= len(seen) / total
            excluded |= seen.keys()
        return out / (257 - len(excluded))

    result = []
    for doc_id, text in rows:
        s = symbols(text, order)
        score = sum(math.log10(probability(s[t - order : t], s[t])) for t in range(order, len(s)))
        tokens = [*(text or "").encode().lower().split(), b""]
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        result.append((doc_id, held(doc_id), len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return result, probability


def rounded(rows):
    return sorted((tuple(round(x, 3) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize(("order", "entries"), [(4, 10**6), (2, 10**6), (1, 10**6), (3, 60)])
def test_equals_a_plain_trie(spark, order, entries):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in TEXTS], SCHEMA).repartition(3)
    found = rounded(tuple(r) for r in language_scores(docs, order=order, entries=entries).collect())
    assert found == rounded(brute(TEXTS, order)[0])


def test_probabilities_of_a_context_sum_to_one():
    _, probability = brute(TEXTS, 3)
    for context in ([0, 0, 0], list(b"the"), list(b"qqq")):
        assert math.isclose(sum(probability([b + 1 if b else 0 for b in context], s) for s in range(1, 258)), 1.0)


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if held(i)][:3]
    docs = spark.createDataFrame([(i, "ab") for i in ids], "doc_id long, text string")
    rows = language_scores(docs).collect()
    assert {round(r["score"], 6) for r in rows} == {round(-3 * math.log10(257), 6)} and {r["base_score"] for r in rows} == {0.0}
    assert language_scores(docs.limit(0)).collect() == []
