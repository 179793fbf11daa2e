"""The corpus pipeline, stage by stage, each against plain code on the stage's own input."""

import os
import re

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from cohortflow.llm import latent_leaks, source_mix
from cohortflow.llm.queries import RULES_SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """Documents before each stage, and the last result: name -> (input rows, output rows)."""
    found, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(out.columns) == sorted(columns)
        found[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()])
        docs = out
    return found


def ids(rows):
    return [r["doc_id"] for r in rows]


def test_order_and_shrinking(chain):
    assert list(chain) == ["quality", "rules", "near_duplicates", "decontamination", "mix"]
    for before, after in list(chain.values())[:-1]:
        assert {*ids(after)} <= {*ids(before)} and len(after) > 0.4 * len(before)
        texts = {r["doc_id"]: r["text"] for r in before}
        assert all(r["text"] == texts[r["doc_id"]] for r in after)


def test_rules_are_those_of_the_sql(chain, tmp_path):
    before, after = chain["rules"]
    import pandas as pd

    documents = pd.DataFrame(before)  # noqa: F841  (read by the SQL)
    kept = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM ({RULES_SQL}) WHERE kept").fetchall()}
    assert {*ids(after)} == kept


def test_one_document_of_each_group_stays(chain):
    before, after = chain["near_duplicates"]
    sets = {}
    for r in before:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[r["doc_id"]] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    assert sorted(ids(after)) == sorted(i for i in sets if root(i) == i)


def test_no_benchmark_text_is_left(chain, spark):
    before, after = chain["decontamination"]
    words = lambda t: b" ".join(latent_leaks.folded_words((t or "").encode()))
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in before if any(b" " + i + b" " in b" " + words(r["text"]) + b" " for i in items if i)}
    assert holds and not holds & {*ids(after)}
    assert len(before) - len(after) <= 2 * len(holds)


def test_the_mix_counts_words_and_meets_targets(chain):
    before, after = chain["mix"]
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in before}
    assert {r["doc_id"]: r["size"] for r in after} == sizes
    by_source = {}
    for r in after:
        by_source.setdefault(r["source"], []).append(r)
    names = sorted(by_source, key=lambda s: (s is None, s))
    totals = [sum(r["size"] for r in by_source[s]) for s in names]
    targets = source_mix.capped_shares(totals, [(5, 2, 1)[n % 3] for n in range(len(names))], 1.5 * sum(totals))
    for name, target in zip(names, targets, strict=True):
        rows = by_source[name]
        assert abs(rows[0]["target"] - target) < 1e-6 * max(target, 1)
        reachable = 1  # bit n: some choice of 0, 1 or 2 copies of each document takes n words
        for r in rows:
            reachable |= reachable << r["size"] | reachable << 2 * r["size"]
        best = min(abs(n - target) for n in range(reachable.bit_length()) if reachable >> n & 1)
        assert abs(sum(r["taken"] for r in rows) - target) <= max(20, 0.01 * target, 1.5 * best)
        assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_run_gives_the_rows_of_the_chain(chain, spark):
    got = sorted((r["doc_id"], r["size"], r["taken"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["size"], r["taken"]) for r in chain["mix"][1])


def test_whole_texts_travel_in_small_batches(spark):
    """Every stage called by itself bounds what its lazy result reads and sends at once: before, this was one batch of 3,000 rows and 30 MB."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    docs, long = spark.read.parquet(f"{SF}/documents.parquet").limit(20), spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text")
    short = spark.range(0, 3000, 1, 1).selectExpr("'x' AS text")
    for name, stage in corpus_pipeline.STAGES:
        for conf in corpus_pipeline.BATCHES:
            spark.conf.unset(conf)
        stage(spark, docs, SF)
        sent = long.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in sent) == 3000 and max(r["size"] for r in sent) < 5 << 20, name
        assert [r["n"] for r in short.mapInArrow(sizes, "n long, size long").collect()] == [1000] * 3, name
        assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "512", name
