"""Each operator against brute force, held-out labels or planted cases, on the smallest given tables."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import latent_leaks, license_scan, pair_rank, rule_ledger, source_mix, token_counts, toxic_gru, url_filter
from cohortflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def test_token_counts_are_the_librarys_and_the_cache_is_used(spark, docs, texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    odd = ["<|endoftext|> x<|startoftext|>y", "it's  we'll DON'T", "a b́ ́c ΣΑΣ. ς", "İstanbul 12345 ٣", "\x1c\x85x"]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + n, t) for n, t in enumerate(odd)], "doc_id long, text string"))
    tokenizer = Tokenizer.from_file(path)
    expected = {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in {**texts, **{10_000 + n: t for n, t in enumerate(odd)}}.items()}
    found = token_counts.token_counts(more, path, cache)
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == expected
    stored = spark.read.parquet(cache).count()
    token_counts.token_counts(more, path, cache).collect()
    assert spark.read.parquet(cache).count() == stored  # nothing was encoded again


def test_other_tokenizers(docs, texts, tmp_path):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    some = docs.filter("doc_id < 20")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(some, path, str(tmp_path / "c")).collect()}
    assert found == {i: len(model.encode(texts[i])) for i in found}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_white_space_counts_where_the_tokenizer_counts_it(spark, name, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path(name)
    rows = ["a b", "a  b", "a\n\nb", "a\n\n\n  b", "a \t \n b", " a b "]
    found = token_counts.token_counts(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), path, str(tmp_path / "c"))
    load = token_counts._load(path)
    count = (lambda t: len(load.encode(t))) if name.endswith(".model") else (lambda t: len(load.encode(t, add_special_tokens=False)))
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == {i: count(t) for i, t in enumerate(rows)}


def test_license_blocks_against_all_blocks(spark):
    rng = random.Random(2)
    filler = [f"f{n}" for n in range(50)] + ["the", "license", "under"]
    rows = []
    for i in range(60):
        words = [rng.choice(filler) for _ in range(rng.randrange(0, 200))]
        for label in rng.sample(sorted(license_scan.TEMPLATES), rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = license_scan.TEMPLATES[label].split()
        rows.append((i, rng.choice((" ", "\n", ", ")).join(words)))
    rows.append((99, "MIT License mit license MIT-license general public License apache license"))
    found = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), block_words=40).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        expected = set()
        for start in range(0, max(len(words), 1), 20):
            block = {*words[start : start + 40]}
            for label, template in license_scan.TEMPLATES.items():
                wanted = {*re.findall(r"[a-z0-9]+", template.lower())}
                if len(block & wanted) >= 0.9 * len(wanted):
                    expected.add((label, start))
        assert {(b["label"], b["first"]) for b in found[i]["blocks"]} == expected
    assert tuple(found[99][c] for c in ("n_base", "first_word", "last_word", "base_labels")) == (5, 0, 9, "apache,gpl,mit")


def test_mix_meets_its_targets(docs):
    rows = source_mix.mix_sources(docs).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s))
    targets = dict(zip(names, source_mix.capped_shares([sizes[s] for s in names], [(5, 2, 1)[n % 3] for n in range(len(names))], 1.5 * sum(sizes.values())), strict=True))
    assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1e-6
    for s in names:
        mine = [r for r in rows if r["source"] == s]
        assert abs(mine[0]["target"] - targets[s]) < 1e-6 and targets[s] <= 2 * sizes[s] + 1e-9
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= max(20, 0.01 * targets[s])
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_balance_with_two_margins(spark):
    cells = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 40.0), ("b", "y", 20.0)], "s string, l string, mass double")
    goal = {"s": {"a": 60.0, "b": 40.0}, "l": {"x": 30.0, "y": 70.0}}
    found = source_mix.entropy_balance(cells, "mass", goal)
    mass = {(r["s"], r["l"]): r["mass"] * np.exp(found["s"][r["s"]] + found["l"][r["l"]]) for r in cells.collect()}
    for n, column in enumerate(goal):
        for key, wanted in goal[column].items():
            assert abs(sum(m for k, m in mass.items() if k[n] == key) - wanted) < 1e-6


@pytest.mark.parametrize(("name", "label", "least"), [("op5_quality", "quality", 0.9), ("op6_toxicity", "toxic", 0.85)])
def test_held_out_labels(spark, name, label, least):
    rows = QUERIES[name](spark, SF.replace("0.001", "0.01")).join(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet"), "doc_id").filter("held_out")
    assert rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_pairs_order_what_they_saw():
    values = np.random.default_rng(0).normal(size=(400, len(pair_rank.MEASURES))).astype(np.float32)
    labels = (values[:, 3] > -1).astype(int)
    model = pair_rank.fit_pairs(values, labels)
    assert ((model.score(values) >= pair_rank.CUT) == labels).mean() > 0.95


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = toxic_gru.Network.fresh({b"aa": 0, b"bb": 1}, rng)
    parts = net.projected(net.inputs([b"aa", b"bb", b"cc"])[0])
    ids = np.concatenate([rng.integers(0, 3, (3, toxic_gru.WINDOW)), np.full((1, toxic_gru.WINDOW), -1)])
    ids[1, 9:] = -1
    up = rng.normal(size=4).astype(np.float32)
    logit, cache = net.forward(parts, ids, keep=True)
    dense, d_parts = net.gradients(parts, ids, up, cache)
    for table, gradient in ((net.dense["Uf"], dense["Uf"]), (net.dense["A"], dense["A"]), (parts["b"], d_parts["b"]), (net.dense["Ub"], dense["Ub"])):
        for at in ((0, 1), (2, 5)):
            before = table[at]
            table[at] = before + 1e-2
            high = net.forward(parts, ids)[0] @ up
            table[at] = before - 1e-2
            low = net.forward(parts, ids)[0] @ up
            table[at] = before
            assert abs((high - low) / 2e-2 - gradient[at]) < 2e-3


def test_planted_leaks_are_found_and_nothing_else(spark, docs, texts):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    plain = lambda t: b" ".join(license_scan.words_of(t.encode())).decode()
    known = {(i, k) for i, t in texts.items() for k, b in items.items() if f" {plain(b)} " in f" {plain(t)} "}
    clean = [i for i in texts if i not in {i for i, _ in known}][:80]
    rng, planted, changed = random.Random(4), set(), dict(texts)
    for n, i in enumerate(clean[:40]):
        k = sorted(items)[n % len(items)]
        words = [w.upper() if n % 2 else w for w in items[k].split()]
        words = [w for at, w in enumerate(words) if at % 17 != 5]  # near copies lack some words
        own = changed[i].split()
        at = rng.randrange(len(own) + 1)
        changed[i] = " ".join(own[:at] + words + own[at:])
        planted.add((i, k))
    frame = spark.createDataFrame(list(changed.items()), "doc_id long, text string").repartition(4)
    found = {(r["doc_id"], r["item_id"]) for r in latent_leaks.find_leaks(frame, benchmark).collect()}
    assert found == known | planted


def test_a_text_leaked_into_a_third_of_all_documents_is_found_in_each(spark):
    """Rarer benchmark words beside the copies must not hide them."""
    rng = random.Random(8)
    items = [" ".join(f"wide{n}" for n in range(24)), *(" ".join(f"rare{k}x{n}" for n in range(40)) for k in range(30))]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows, planted = [], set()
    for i in range(600):
        words = [f"f{rng.randrange(200)}" for _ in range(300)]
        if i % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = [*rng.choice(items[1:]).split()[:10], *items[0].split()]
            planted.add((i, 0))
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(r["doc_id"], r["item_id"]) for r in latent_leaks.find_leaks(frame, benchmark).collect()} == planted


@pytest.mark.parametrize("picks", [0, 1, 700, 9000])
def test_rows_are_summed_by_group_however_unequal_the_groups(picks):
    """Hot groups, with more rows than one group of a sum adds at once, next to empty ones."""
    random = np.random.default_rng(picks)
    table, groups = random.integers(-8, 8, size=(50, 3)).astype(np.float32), 40
    of, rows = np.where(random.random(picks) < 0.7, 5, random.integers(0, groups - 1, picks)), random.integers(0, 50, picks)
    expected = np.zeros((groups, 3), np.float32)
    np.add.at(expected, of, table[rows])
    assert np.array_equal(latent_leaks.summed_rows(of, groups, rows, table), expected)


def test_svd_equals_a_dense_one():
    rng = np.random.default_rng(0)
    weight = np.concatenate([[0], rng.random(30)])
    texts = [rng.integers(0, 31, n).astype(np.uint16).tobytes() for n in (5, 70, 200, 33)]
    rows = latent_leaks.Rows(texts, weight, np.uint16)
    dense = rows.passages(np.diag(weight).astype(np.float32))
    words, back = rows.transposed(dense, weight)
    expected = dense.T @ dense
    assert np.allclose(back, expected[words], atol=1e-4)
    assert latent_leaks.common_subsequence(latent_leaks.masks_of([1, 2, 3, 4]), 4, [2, 9, 1, 3, 1, 4]) == 3


def test_the_basis_is_fitted_on_every_document(spark):
    """Against the dense decomposition of all passages: a few documents with words of their own count, among many others."""
    rng = np.random.default_rng(5)
    n = 12_000
    common, rare = rng.integers(1, 9, (n, 6)), np.tile([9, 10, 11, 12], 16)
    texts = [rare.astype(np.uint16).tobytes() if i in (77, 5_000) else common[i].astype(np.uint16).tobytes() for i in range(n)]
    coded = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, ids binary").repartition(3)
    weight, energy = latent_leaks.word_weights(coded, 12, [latent_leaks.Probe(0, tuple(range(1, 13)))], np.uint16)
    rows = latent_leaks.Rows(texts, weight, np.uint16)
    assert np.isclose(energy, (weight[rows.words] ** 2).sum())
    dense = rows.passages(np.diag(weight).astype(np.float32)).astype(float)
    for probes in (None, np.eye(13)[[9, 3]] * weight):
        gram = dense.T @ dense
        if probes is not None:
            gram += latent_leaks.PROBE_SHARE * 2 * energy / (probes**2).sum() * probes.T @ probes
        vectors, singular = latent_leaks.randomised_svd(coded, weight, np.uint16, 12, energy, probes)
        expected = np.sqrt(np.maximum(np.linalg.eigvalsh(gram)[::-1], 0))
        assert np.allclose(singular[:9], expected[:9], rtol=1e-3)
        assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-6)
        assert np.linalg.norm(vectors[9:13]) > 0.9  # the rare words' direction


def test_policies_and_ablations(docs):
    ledger = rule_ledger.ledger(docs).cache()
    rows = ledger.collect()
    for r in rule_ledger.ablation(ledger).collect():
        mask, bit = rule_ledger.mask_of(rule_ledger.POLICIES[r["policy"]]), rule_ledger.BITS[r["rule"]]
        bits = [x["failed_bits"] for x in rows]
        assert (r["rows"], r["rejected"], r["fails"], r["only_this"]) == (
            len(bits), sum(b & mask > 0 for b in bits), sum(b & bit > 0 for b in bits), sum(b & mask == bit for b in bits),
        )
    kept = {r["doc_id"] for r in rule_ledger.apply_policy(ledger).filter("kept").collect()}
    assert {r["doc_id"] for r in rule_ledger.keep_good(docs).collect()} == kept


def test_bloom_filter_loses_nothing_and_drops_most(spark):
    listed = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 125
    bloom = url_filter.bloom_blocks(listed, "key", blocks)
    assert url_filter.possible_hits(listed, "key", bloom, blocks).count() == 2000
    other = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    assert url_filter.possible_hits(other, "key", bloom, blocks).count() < 200


def lcs(a, b):
    """Longest common subsequence by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_retrieval_recall_against_all_passages(spark, docs, texts):
    """Every document and benchmark text compared in full; latent retrieval has to find at least nine in ten."""
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rng, changed = random.Random(11), dict(texts)
    for n, i in enumerate(sorted(texts)[:90]):
        words = items[sorted(items)[n % len(items)]].split()
        share = (0.0, 0.1, 0.2)[n % 3]  # words replaced, and half as many lost
        words = [f"other{rng.randrange(99)}" if rng.random() < share else w for w in words if rng.random() >= share / 2]
        own = changed[i].split()
        at = rng.randrange(len(own) + 1)
        changed[i] = " ".join([*own[:at], *words, *own[at:]])
    coded = {k: latent_leaks.folded_words(t.encode()) for k, t in items.items()}
    block, expected = latent_leaks.BLOCK_WORDS, set()
    for i, text in changed.items():
        words = latent_leaks.folded_words(text.encode())
        for k, wanted in coded.items():
            if not wanted or len(wanted) > 2 * block:
                continue
            mine = {*wanted}
            for start in range(0, len(words), block):
                around = words[max(0, start - len(wanted)) : start + 2 * block + len(wanted)]
                if sum(w in mine for w in around) < 0.6 * len(wanted):
                    continue
                shared, tail = lcs(wanted, around) / len(wanted), wanted[-max(1, len(wanted) // 3) :]
                if shared >= latent_leaks.COPY or shared >= latent_leaks.PARAPHRASE and lcs(tail, around) / len(tail) >= latent_leaks.ANSWER:
                    expected.add((i, k))
                    break
    frame = spark.createDataFrame(list(changed.items()), "doc_id long, text string").repartition(4)
    found = {(r["doc_id"], r["item_id"]) for r in latent_leaks.find_leaks(frame, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert len(expected) > 60 and len(found & expected) >= 0.9 * len(expected)
    assert found <= expected


def test_mixed_sizes_are_the_words_of_the_texts(spark):
    rows = [(1, "a b  c", "x", 5), (2, None, None, 5), (3, "", "x", 5), (4, " one\ttwo\x0bthree\x85four ", None, 5)]
    found = {r["doc_id"]: r for r in source_mix.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string, size int")).collect()}
    assert {i: r["size"] for i, r in found.items()} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}


def test_rounding_flips_reach_the_share():
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 12, 40, 400):
        sizes, rate = np.sort(rng.integers(1, 3000, n))[::-1], float(rng.uniform(0, 2))
        copies = source_mix._rounded(sizes, np.full(n, rate), 2.0)
        off, exact = abs(int((copies * sizes).sum()) - rate * sizes.sum()), rate * sizes.sum()
        assert copies.min() >= 0 and copies.max() <= 2
        if n >= 40:
            assert off < (5 if n >= 400 else 20) and copies.min() >= int(rate) and copies.max() <= int(np.ceil(rate))
        if n >= 12:
            assert off <= max(20, 0.01 * exact)
    assert source_mix._rounded(np.zeros(0, int), np.zeros(0), 2.0).tolist() == []
    assert source_mix._rounded(np.array([0, 0]), np.array([0.5, 1.5]), 2.0).max() <= 2


def test_the_nearest_sum_equals_all_choices():
    import itertools

    rng = random.Random(9)
    for _ in range(60):
        sizes = [rng.randrange(0, 60) for _ in range(rng.randrange(1, 6))]
        wanted = rng.uniform(0, 2.2 * sum(sizes))
        found = source_mix._nearest_sum(sizes, [1.2] * len(sizes), wanted, 2)
        best = min(abs(sum(c * s for c, s in zip(cs, sizes, strict=True)) - wanted) for cs in itertools.product(range(3), repeat=len(sizes)))
        assert abs(abs(sum(c * s for c, s in zip(found, sizes, strict=True)) - wanted) - best) < 1e-9
