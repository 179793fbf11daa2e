"""Packing: pieces are the tokenizer's ids, sequences are gapless and few."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import pattern_packing

PATH, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoders():
    return pattern_packing.encoder(PATH), pattern_packing.encoder(PATH, RANKS, public.PATTERN)


def test_both_libraries_agree_on_every_character_they_share(encoders):
    slow, fast = encoders
    for c in map(chr, range(0x250)):
        for form in (f"a{c}b", f" {c}", f"1{c}{c} x", f" {c}'s {c}", f"\n{c}\n\n {c}"):
            assert fast(form) == slow(form), hex(ord(c))


def test_odd_texts(encoders):
    slow, fast = encoders
    for text in ("", " " * 200_000, "a" * 100_000, "\n " * 100_000, "x <|endoftext|>y<|endoftext|>", "日本語 text ́ 👍🏽", "a\r\n\x1c\x85 \xa0b"):
        assert fast(text) == slow(text)


@pytest.mark.parametrize("capacity", [1, 7, 1024])
def test_cuts(capacity):
    for length in (1, 2, 6, 7, 8, 14, 15, 1023, 1024, 1025, 5000):
        found = pattern_packing.cuts(length, capacity)
        sizes = [b - a for a, b in found]
        assert found[0][0] == 0 and found[-1][1] == length and sum(sizes) == length
        assert all(n == capacity for n in sizes[1:]) and 0 < sizes[0] <= capacity and len(sizes) == -(-length // capacity)


def optimum(pieces, capacity):
    """Fewest sequences by depth-first search."""
    best = [len(pieces)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(pieces):
            best[0] = len(rooms)
            return
        for r in sorted({r for r in rooms if r >= pieces[at]}):
            rest = list(rooms)
            rest.remove(r)
            place(at + 1, [*rest, r - pieces[at]])
        place(at + 1, [*rooms, capacity - pieces[at]])

    place(0, [])
    return best[0]


def check(histogram, capacity):
    found, seen = pattern_packing.whole_patterns(histogram, capacity), Counter()
    for uses, pattern in found:
        assert uses > 0 and sum(k * n for k, n in pattern.items()) <= capacity
        for k, n in pattern.items():
            seen[k] += uses * n
    assert seen == Counter({k: n for k, n in histogram.items() if n})
    return sum(uses for uses, _ in found)


def test_small_cases_against_the_optimum():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.randrange(6, 30)
        pieces = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))), reverse=True)
        assert check(Counter(pieces), capacity) <= optimum(pieces, capacity) + (1 if len(pieces) > 6 else 0)


@pytest.mark.parametrize("shape", ["flat", "short", "thirds", "one length"])
def test_large_histograms_come_near_the_bound(shape):
    rng = np.random.default_rng(3)
    sizes = {"flat": rng.integers(1, 257, 20_000), "short": rng.geometric(0.02, 20_000).clip(1, 256), "thirds": rng.choice([86, 85, 84, 90], 9_000), "one length": np.full(1_000, 100)}[shape]
    histogram = {int(k): int(n) for k, n in Counter(sizes.tolist()).items()}
    used, bound = check(histogram, 256), -(-int(sizes.sum()) // 256)
    fitted = sum(pattern_packing.best_fit(histogram, 256).values())
    assert used <= fitted + 1
    if shape == "short":
        assert used <= bound * 1.002 + 1
    if shape == "one length":
        assert used == 500


def test_a_solution_covers_everything_and_ignores_the_number_of_pieces():
    histogram = {300: 10**9, 500: 3 * 10**8, 724: 10**7, 1024: 5, 1: 10}
    found = pattern_packing.solve(histogram)
    covered = Counter()
    for uses, pattern in found:
        for k, n in pattern.items():
            covered[k] += uses * n
    assert all(abs(covered[k] - n) <= 1e-6 * n for k, n in histogram.items())
    assert len(check_places(histogram)) < 100


def check_places(histogram):
    rows = pattern_packing.places(pattern_packing.whole_patterns(histogram))
    for k, n in histogram.items():
        spans = sorted((a, b) for length, a, b, *_ in rows if length == k)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    return rows


def test_pieces_and_sequences(spark, encoders):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 1, 3, 9, 40, 200]))) for _ in range(150)]
    texts += [None, "", "x", texts[3], "Größe <|endoftext|> ő", "語" * 30]
    rows = [(i if i != 7 else None, t, "other") for i, t in enumerate(texts)] + [(3, texts[3], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(5)
    found = pattern_packing.pack(docs, PATH, capacity=64, ranks=RANKS, pattern=public.PATTERN).collect()
    whole = Counter()
    by_doc: dict = {}
    for r in found:
        by_doc.setdefault((r["doc_id"], r["piece"]), []).append(r)
        assert r["length"] == len(r["ids"]) // 4
    for (doc, piece), parts in by_doc.items():
        assert len(parts) == (2 if doc == 3 else 1), (doc, piece)
    for doc, text, _ in rows:
        ids = [*encoders[0](text or ""), 2]
        got = [by_doc[doc, p][0] for p in range(len(pattern_packing.cuts(len(ids), 64)))]
        assert [x for g in got for x in np.frombuffer(g["ids"], "<u4")] == ids and [g["start"] for g in got] == [a for a, _ in pattern_packing.cuts(len(ids), 64)]
        whole[doc] += len(ids)
    ends = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 64 and len(ends) <= -(-sum(whole.values()) // 64) * 1.05 + 2


def test_no_texts(spark):
    assert pattern_packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_special_tokens_are_the_tokenizers(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    row = pattern_packing.pack(docs, PATH, ranks=RANKS, pattern=public.PATTERN).select("length", F.hex("ids").alias("h")).first()
    assert row["length"] == 4 and re.search("50C40000", row["h"])
