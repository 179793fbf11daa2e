"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns in every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortflow.llm import latent_leaks, license_scan, odd_sketch, pair_rank, ppm, rule_ledger, source_mix, token_counts, toxic_gru, url_filter

LONG = " ".join(f"word{i % 997} runs" for i in range(60_000))
ROWS = [
    (1, "a plain text of a few words.\n" * 3, "en", "s1", 1), (2, None, None, None, None), (3, "", "en", "s1", 0), (4, "   \n\t ", "en", None, 5),
    (None, "a text without an id", "en", "s2", 3), (5, LONG, "en", "s2", 9), (6, "same words here again and again", "en", "s1", 1),
    (6, "same words here again and again", "en", "s1", 1), (7, "same words here again and again", "en", "s3", 1), (8, "é中 \U0001f600 ñ", "xx", "s3", 2),
]
#: Names that operators use for results and helpers.
CLASHES = ("score", "kept", "n_words", "target", "rate", "size", "labels", "failed_bits", "component_id", "n_tokens", "host", "_row", "_rest", "measures", "digest")


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return base.withColumns({c: F.lit(f"own {c}") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (6, 1, 0), (7, None, None), (None, 0, 1), (5, 0, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "nothing in the documents says quite this sentence"), (2, None), (3, ""), (None, "no id")], "item_id long, text string")


@pytest.fixture(scope="module")
def runs(spark, labels, benchmark, tmp_path_factory):
    import public_tokenizers

    def tokens(d):
        return token_counts.token_counts(d, public_tokenizers.path("word_bpe_49k.json"), str(tmp_path_factory.mktemp("cache")))

    return {
        "tokens": tokens,
        "licenses": license_scan.license_scan,
        "mix": source_mix.mix_sources,
        "quality": lambda d: pair_rank.quality_scores(d, labels),
        "keep_quality": lambda d: pair_rank.keep_quality(d, labels),
        "toxicity": lambda d: toxic_gru.toxicity_scores(d, labels, fit_rows=20),
        "leaks": lambda d: latent_leaks.contamination(d, benchmark),
        "drop_leaks": lambda d: latent_leaks.drop_leaks(d, benchmark),
        "ledger": lambda d: rule_ledger.apply_policy(rule_ledger.ledger(d)),
        "keep_good": rule_ledger.keep_good,
        "near": odd_sketch.near_duplicates,
        "drop_near": odd_sketch.drop_near_duplicates,
        "language": ppm.language_scores,
    }


PER_ROW = ("tokens", "licenses", "mix", "quality", "toxicity", "leaks", "ledger", "near", "language")
FILTERS = ("keep_quality", "drop_leaks", "keep_good", "drop_near")


@pytest.mark.parametrize("name", PER_ROW)
def test_a_result_per_row(runs, docs, name):
    found = runs[name](docs)
    assert len(set(found.columns)) == len(found.columns)
    ids = sorted((r["doc_id"] for r in found.select("doc_id").collect()), key=repr)
    assert ids == sorted((r[0] for r in ROWS), key=repr)


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns(runs, docs, name):
    found = runs[name](docs)
    assert found.columns == docs.columns
    assert all(r["score"] == "own score" for r in found.collect())


@pytest.mark.parametrize("name", PER_ROW + FILTERS)
def test_empty_tables(runs, docs, name):
    assert runs[name](docs.limit(0)).collect() == []


def test_no_labels_and_no_benchmark(docs, labels, benchmark):
    assert {r["predicted"] for r in pair_rank.quality_scores(docs, labels.limit(0)).collect()} == {1}
    assert {r["predicted"] for r in toxic_gru.toxicity_scores(docs, labels.limit(0)).collect()} == {0}
    assert {r["contaminated"] for r in latent_leaks.contamination(docs, benchmark.limit(0)).collect()} == {False}


def test_results_of_empty_texts(runs, docs):
    empty = F.col("doc_id").isin(2, 3, 4)
    assert {(r["n_words"], r["n_base"], r["score"]) for r in runs["licenses"](docs).filter(empty).collect()} == {(0, 0, 0.0)}
    assert {(r["size"], r["taken"]) for r in runs["mix"](docs).filter(empty).collect()} == {(0, 0)}
    near = runs["near"](docs).filter(empty).collect()
    assert all(r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] and r["kept"] for r in near)
    assert {(r["n_words"], r["kept"]) for r in runs["ledger"](docs).filter(empty).collect()} == {(0, False)}


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://Sub.Example.NET/en/x?q#f"), (6, "x://net"), (6, "x://net"), (None, "x://a.net/"), (7, "x://example.com/de/é"), (8, "x://a.org/fr/..//"), (9, "x://" + "a." * 300 + "net/" + "b/" * 300)]
    pages = spark.createDataFrame([(i, u, "own") for i, u in rows], "page_id long, url string, rule string").drop("rule").withColumn("key", F.lit("own"))
    rules = url_filter.rule_entries(spark.createDataFrame([("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")], "rule string, verdict string"))
    listing = rules.unionByName(url_filter.page_entries(url_filter.repeated_pages(pages)))
    found = sorted(((r["page_id"], r["host"][-12:], r["path"][:9], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, listing).collect()), key=repr)
    assert found == sorted(
        [
            (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
            (5, ".example.net"[-12:], "/en/x", "example.net/en/", "allow"), (6, "net", "", None, "block"), (6, "net", "", None, "block"), (None, "a.net", "/", "net/", "block"),
            (7, "example.com", "/de/é", "example.com/de/", "block"), (8, "a.org", "/fr/..//", "org/fr/", "allow"), (9, ".a.a.a.a.net", "/b/b/b/b/", "net/", "block"),
        ],
        key=repr,
    )
    assert url_filter.judge_urls(pages.limit(0), listing).collect() == []
    assert {r["verdict"] for r in url_filter.judge_urls(pages, listing.limit(0)).collect()} == {"allow"}


def test_stages_keep_document_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
