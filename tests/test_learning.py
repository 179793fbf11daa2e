import random
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortflow.learning import bins, encode, ensemble, metrics, runs, search, split, train
from cohortflow.learning.model_registry import CHALLENGER, CHAMPION, ModelRegistry, batch_score, champion_gate, inference_check, schema_check
from cohortflow.learning.search import SearchSpace, param_search
from cohortflow.learning.train import BoosterParams, FeatureColumns, ablate_feature, evaluate_splits, feature_importance, prefixes, train_gbt, with_probability
from cohortflow.operators.quality import assert_probability
from cohortflow.plans.lineage import broadcast_if_small, shared_dir
from cohortflow.plans.ordered import running_totals


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def test_running_totals_match_brute_force_over_many_partitions(spark):
    rng = random.Random(3)
    data = sorted({(rng.choice("ab"), rng.randrange(5000)) for _ in range(3000)})
    frame = spark.createDataFrame([(g, k, (k * 7) % 11) for g, k in data], "g string, k int, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running_totals(frame.repartition(6), ["k"], ["n"], by=["g"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    reached = {"a": 0, "b": 0}
    for row in sorted(found, key=lambda r: (r["g"], r["k"])):
        reached[row["g"]] += row["n"]
        assert row["n_upto"] == reached[row["g"]]
    assert {r["g"]: r["n_total"] for r in found} == reached and len(found) == len(data)


def test_ties_and_one_class(spark):
    tied = scored(spark, [(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)])
    assert metrics.roc_auc(tied, "label", "score").first()["roc_auc"] == 0.5
    assert metrics.average_precision(tied, "label", "score").first()[0] == 0.5
    assert metrics.roc_auc(scored(spark, [(1, 0.1), (1, 0.9)]), "label", "score").first()["roc_auc"] is None


def test_metrics_match_brute_force(spark):
    rng = random.Random(5)
    pairs = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(300)]
    pairs = [(y, round(min(1.0, s + 0.2 * y), 2)) for y, s in pairs]
    frame = scored(spark, pairs).repartition(4)
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    area, recall = 0.0, 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        tp, called = sum(p >= t for p in pos), sum(s >= t for _, s in pairs)
        area, recall = area + (tp / len(pos) - recall) * tp / called, tp / len(pos)
    found = metrics.evaluate(frame, "label", "score").first()
    called = frame.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    hits = metrics.f1_accuracy(called, "label", "predicted").first()
    assert (found["f1"], found["accuracy"]) == (pytest.approx(hits["f1"]), pytest.approx(hits["accuracy"]))
    assert found["roc_auc"] == pytest.approx(won) and found["pr_auc"] == pytest.approx(area)
    mirrored = metrics.roc_auc(frame.withColumn("score", -F.col("score")), "label", "score").first()["roc_auc"]
    assert mirrored == pytest.approx(1 - won)
    curve = metrics.roc_curve(frame, "label", "score").orderBy("fpr", "tpr").collect()
    trapezoids = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(curve, curve[1:]))
    assert trapezoids == pytest.approx(won)


def test_report_and_confusion_with_an_absent_class(spark, rows):
    frame = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "label int, predicted int")
    assert rows(metrics.confusion_matrix(frame, "label", "predicted")) == [(0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 1, 2)]
    report = {r["class"]: r for r in metrics.classification_report(frame, "label", "predicted").collect()}
    assert report["0"]["f1"] == 0.0 and report["0"]["support"] == 0
    assert report["1"]["recall"] == pytest.approx(2 / 3) and report["accuracy"]["f1"] == pytest.approx(2 / 3)


def test_codes_for_unseen_and_missing(spark, rows):
    train = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "c string, id int")
    codes = encode.fit_ordinal(train, ["c"])
    assert rows(codes) == [("c", "a", 1), ("c", "b", 2)]
    other = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "c string, id int")
    assert rows(encode.ordinal_encode(other, codes, ["c"]), "id", "c") == [(1, 1), (2, -1), (3, -2)]


@pytest.mark.parametrize("buckets", [4, 65_536])
def test_split_is_exact_disjoint_and_repeatable(spark, rows, buckets):
    frame = spark.range(1, 1001).withColumn("y", (F.col("id") % 10 < 3).cast("int"))
    one = split.stratified_split(frame, "id", "y", buckets=buckets)
    again = split.stratified_split(frame.repartition(5), "id", "y", buckets=buckets)
    assert rows(one) == rows(again) and one.count() == 1000
    counts = {(r["y"], r["split"]): r["n"] for r in split.split_report(one, "y").collect()}
    assert counts == {(1, "train"): 210, (1, "validation"): 45, (1, "test"): 45, (0, "train"): 490, (0, "validation"): 105, (0, "test"): 105}
    assert rows(one) == rows(split.stratified_split(frame, "id", "y", buckets=16))


def test_split_of_tiny_and_unlabelled_groups(spark):
    frame = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, None)], "id long, y int")
    found = {r["id"]: r["split"] for r in split.stratified_split(frame, "id", "y").collect()}
    assert found[1] == "train" and found[4] is None and {found[2], found[3]} <= {"train", "validation", "test"}


def test_hash_split_shares(spark):
    counts = dict(split.hash_split(spark.range(20000), "id").groupBy("split").count().collect())
    assert abs(counts["train"] / 20000 - 0.7) < 0.02 and abs(counts["test"] / 20000 - 0.15) < 0.02


def test_best_run_takes_the_smallest_id_among_equals(spark, tmp_path, rows):
    path = str(tmp_path / "runs")
    parent = runs.log_run(spark, path, "search", "tuning", params={"k": 1})
    runs.log_run(spark, path, "search", "tuning", metrics={"auc": 0.7}, parent_id=parent)
    best = runs.log_run(spark, path, "search", "tuning", metrics={"auc": 0.9, "f1": None}, tags={"t": "x"})
    found = runs.best_run_by_metric(runs.read_runs(spark, path), "auc")
    assert rows(found) == [("search", best, 0.9)]
    tied = spark.createDataFrame([("n", "b", {"m": 1.0}), ("n", "a", {"m": 1.0})], "name string, run_id string, metrics map<string,double>")
    assert rows(runs.best_run_by_metric(tied, "m")) == [("n", "a", 1.0)]
    odd = spark.createDataFrame([("r1", "n", {"m": 0.5}), ("r3", "n", {"m": 0.7}), ("r2", "n", {"m": float("nan")})], "run_id string, name string, metrics map<string,double>")
    assert rows(runs.best_run_by_metric(odd, "m")) == [("n", "r3", 0.7)]


def test_search_draws_are_seeded_and_in_range():
    space = SearchSpace()
    drawn = space.draw(32, 42)
    assert drawn == space.draw(32, 42) and drawn != space.draw(32, 43)
    for p in drawn:
        assert 50 <= p.trees <= 500 and p.trees % 25 == 0 and 0.01 <= p.learning_rate <= 0.3 and 3 <= p.max_depth <= 12
        assert 1 <= p.depth <= 6 and 0.6 <= p.row_share <= 1.0


def training_rows(spark, n=600):
    base = spark.range(n).select(
        "id",
        (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") % 2 + F.rand(1) * 0.5).alias("leak"),
        (F.col("id") % 2 * 0.5 + F.rand(2)).alias("weak"),
        F.when(F.rand(3) < 0.5, "x").otherwise("y").alias("kind"),
        (F.rand(4) < 0.5).alias("flag"),
    )
    return split.hash_split(base, "id").cache()


SMALL = BoosterParams(trees=3, leaves=4, min_rows=5)


def test_leak_raises_the_score_and_its_removal_lowers_it(spark):
    rows = training_rows(spark)
    features = FeatureColumns.of(rows, ["id", "label", "split"])
    assert features == FeatureColumns(["kind"], ["leak", "weak"], ["flag"])
    table = {r["metric"]: r for r in ablate_feature(rows, "label", features, "leak", SMALL).collect()}
    assert table["test_roc_auc"]["with"] > 0.99 > table["test_roc_auc"]["without"]
    assert table["test_roc_auc"]["difference"] < 0


def test_gate_registry_and_inference(spark, tmp_path):
    rows = training_rows(spark)
    features = FeatureColumns.of(rows, ["id", "label", "split"])
    registry = ModelRegistry(spark, str(tmp_path / "models"))
    good = train_gbt(rows, "label", features, SMALL)
    poor = train_gbt(rows, "label", FeatureColumns([], [], ["flag"]), BoosterParams(trees=1, leaves=2), early_stop=False)
    test = rows.filter("split = 'test'")
    first = champion_gate(registry, "m", good, test, "label", rows.schema.json()).first()
    assert first["decision"] == CHAMPION and first["champion_version"] is None
    second = champion_gate(registry, "m", poor, test, "label").first()
    assert second["decision"] == CHALLENGER and registry.version_of("m", CHALLENGER) == 2
    third = champion_gate(registry, "m", good, test, "label").first()
    assert third["decision"] == CHAMPION and registry.version_of("m", CHAMPION) == 3
    assert registry.version_of("m", CHALLENGER) is None
    shown = inference_check(registry, "m", rows, "label", "id", ["kind"]).collect()
    assert len(shown) == 10 and all(r["predicted_class"] == r["actual"] for r in shown)
    assert schema_check(registry.input_schema("m", 1), rows.drop("kind")).first()["column"] == "kind"
    # a category the training rows did not have still gets a score
    odd = rows.limit(3).withColumn("kind", F.lit("never seen"))
    assert batch_score(good, odd).filter("predicted_probability BETWEEN 0 AND 1").count() == 3


def test_trees_are_walked_once_a_row_whatever_asks_for_the_score(spark):
    rows = training_rows(spark)
    model = train_gbt(rows, "label", FeatureColumns.of(rows, ["id", "label", "split"]), SMALL)
    checked = assert_probability(batch_score(model, rows), "predicted_probability")
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    # assembling, margins, probabilities and the array of them: one function each, none again in the check
    assert plan.count("UDF(") == 4
    assert checked.count() == rows.count()


def test_both_models_of_an_ablation_are_judged_on_stored_test_rows(spark, monkeypatch):
    judged, real = [], train.evaluate_splits
    monkeypatch.setattr(train, "evaluate_splits", lambda model, rows, *more: judged.append(rows) or real(model, rows, *more))
    rows = training_rows(spark)
    ablate_feature(rows, "label", FeatureColumns.of(rows, ["id", "label", "split"]), "leak", SMALL)
    assert len(judged) == 2 and all(len(r.inputFiles()) > 0 and r.count() == rows.filter("split = 'test'").count() for r in judged)


def test_a_fit_reads_all_labelled_rows(spark, monkeypatch):
    fitted, judged = [], []
    fit, margins = train.GBTClassifier.fit, ensemble.running_margins
    monkeypatch.setattr(train.GBTClassifier, "fit", lambda self, rows, *more: fitted.append(rows.count()) or fit(self, rows, *more))
    monkeypatch.setattr(ensemble, "running_margins", lambda rows, *more: judged.append(rows.count()) or margins(rows, *more))
    rows = training_rows(spark, 64_000)
    ablate_feature(rows, "label", FeatureColumns.of(rows, ["id", "label", "split"]), "leak", SMALL)
    assert fitted == 2 * [rows.filter("split = 'train'").count()] and judged == 2 * [rows.filter("split = 'validation'").count()]


@pytest.mark.parametrize("n", [0, 1, 25_000, 25_001, 340_000, 20_400_000, 10**9])
def test_partitions_of_a_fit_hold_a_bounded_number_of_rows(n):
    parts = train.fit_partitions(n)
    assert parts >= 1 and n / parts <= 250_000 and (n < 25_000 * 64 or parts >= 64)


def test_thresholds_come_from_all_rows(spark):
    x = F.when(F.col("id") == 77, 500.0).when(F.col("id") % 10 == 0, float("nan")).otherwise((F.col("id") % 3).cast("double"))
    rows = VectorAssembler(inputCols=["x", "id", "same"], outputCol="features", handleInvalid="keep").transform(spark.range(1000).select("id", x.alias("x"), F.lit(-0.0).alias("same")))
    few, many, none = bins.thresholds(rows.repartition(5), "features", 8)
    assert few == [0.5, 1.5, 251.0] and none == []  # one row of a thousand has the last value
    assert many == [124.5, 249.5, 374.5, 499.5, 624.5, 749.5, 874.5]
    found = {r["id"]: vector.toArray().tolist() for r in bins.to_bins(rows, "features", [few, many, none]).collect() for vector in [r["features"]]}
    assert found[77] == [3, 0, 0] and np.isnan(found[10][0]) and found[10][1:] == [0, 0] and found[124] == [1, 0, 0] and found[125] == [2, 1, 0] and found[999] == [0, 7, 0]
    assert bins.between(1.0, np.nextafter(1.0, 2)) == 1.0 and bins.between(float("-inf"), float("inf")) == float("-inf") and bins.between(3.0, float("inf")) == 3.0


def test_a_large_fit_states_its_thresholds_over_the_values(spark, monkeypatch):
    rows = training_rows(spark)
    features = FeatureColumns(["kind"], ["weak", "third"], ["flag"])
    rows = rows.withColumn("third", (F.col("id") % 5 / 7).cast("double"))
    params = BoosterParams(trees=4, leaves=8, min_rows=5)
    small = train_gbt(rows, "label", FeatureColumns(["kind"], ["third"], ["flag"]), params, early_stop=False)
    seen, fit = [], train.GBTClassifier.fit
    monkeypatch.setattr(train, "BINS", 16)  # more than 256 rows are many now
    monkeypatch.setattr(train.GBTClassifier, "fit", lambda self, rows, *more: seen.append((self, rows, fit(self, rows, *more))) or seen[-1][2])
    large = train_gbt(rows, "label", FeatureColumns(["kind"], ["third"], ["flag"]), params, early_stop=False)
    assert large.stages[-1].toDebugString.split("\n")[1:] == small.stages[-1].toDebugString.split("\n")[1:]  # all values had thresholds before
    assert (large.stages[-1].featureImportances.toArray() == small.stages[-1].featureImportances.toArray()).all()
    model = train_gbt(rows, "label", features, params)
    learner, numbers, booster = seen[-1]
    assert learner.getMaxBins() ** 2 >= numbers.count() == rows.filter("split = 'train'").count()
    assert max(max(r["features"]) for r in numbers.collect()) <= 15
    kept = model.stages[-1].getNumTrees
    over_bins = sorted(r["probability"][1] for r in ensemble.shortened(booster, kept).transform(numbers).collect())
    over_values = sorted(r["probability"][1] for r in model.transform(rows.filter("split = 'train'")).collect())
    assert over_bins == pytest.approx(over_values, abs=1e-12)
    with pytest.raises(Exception, match="NaN"):  # refused, as in small fits
        train_gbt(rows.withColumn("third", F.when(F.col("id") % 50 != 7, F.col("third"))), "label", features, params)


def test_search_reports_one_row_per_trial(spark):
    rows = training_rows(spark, 300)
    features = FeatureColumns.of(rows, ["id", "label", "split", "leak"])
    space = SearchSpace(trees=(2, 2, 1), max_depth=(1, 2), leaves=(2, 4), min_rows=(1, 2))
    found = param_search(rows, "label", features, trials=2, space=space, parallelism=2).collect()
    assert [r["trial"] for r in found] == [0, 1] and all(0 <= r["metrics"]["validation_roc_auc"] <= 1 for r in found)


def test_a_column_may_have_any_number_of_values_and_reloads_with_them(spark, tmp_path):
    """The dictionary is part of the artefact: -1 for unseen values, -2 for missing ones, also after a reload."""
    base = spark.range(12000).select("id", F.concat(F.lit("v"), "id").alias("wide"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 2 + F.rand(1)).alias("x"))
    rows = split.hash_split(base, "id").cache()
    features = FeatureColumns.of(rows, ["id", "label", "split"])
    model = train_gbt(rows, "label", features, SMALL)
    path = str(tmp_path / "m")
    model.save(path)
    again = PipelineModel.load(path)
    asked = rows.filter("split = 'train'").limit(20).unionByName(rows.limit(1).withColumn("wide", F.lit("never"))).unionByName(rows.limit(1).withColumn("wide", F.lit(None).cast("string")))
    codes = {r["wide"]: r["wide__code"] for r in again.stages[0].transform(asked).collect()}
    assert codes["never"] == -1 and codes[None] == -2
    train = sorted(r["wide"] for r in rows.filter("split = 'train'").select("wide").collect())
    assert all(code == 1 + train.index(value) for value, code in codes.items() if value not in ("never", None))
    scores = [sorted((r["id"], r["wide"] or "", r["probability"]) for r in with_probability(m, asked).collect()) for m in (model, again)]
    assert scores[0] == scores[1]


def test_split_counts_and_margins_equal_a_walk_of_the_trees(spark):
    rows = training_rows(spark)
    features = FeatureColumns.of(rows, ["id", "label", "split"])
    model = train_gbt(rows, "label", features, BoosterParams(trees=5, leaves=8, min_rows=5), early_stop=False)
    booster, counted, number = model.stages[-1], {}, re.compile(r"If \(feature (\d+) ")
    for tree in booster.trees:
        for found in number.findall(tree.toDebugString):
            counted[features.names[int(found)]] = counted.get(features.names[int(found)], 0) + 1
    table = {r["feature"]: r for r in feature_importance(model, rows, features).collect()}
    assert {f: r["splits"] for f, r in table.items()} == {f: counted.get(f, 0) for f in features.names}
    assert abs(sum(r["importance"] for r in table.values()) - 1) < 1e-9
    prepared = model.transform(rows)
    trees = ensemble.Trees.of(ensemble.node_table(booster, spark), booster.treeWeights)
    margins = {r["id"]: r["margins"] for r in ensemble.running_margins(prepared, trees, "features", ["id"]).collect()}
    for r in prepared.select("id", "rawPrediction").collect():
        assert abs(2 * margins[r["id"]][-1] - r["rawPrediction"][1]) < 1e-9 or abs(margins[r["id"]][-1] - r["rawPrediction"][1]) < 1e-9
    short = ensemble.shortened(booster, 2)
    assert short.getNumTrees == 2
    cut = {r["id"]: r["rawPrediction"][1] for r in short.transform(prepared.select("id", "features")).collect()}
    assert all(abs(cut[i] - m[1]) < 1e-9 or abs(cut[i] - 2 * m[1]) < 1e-9 for i, m in margins.items())


def prefix_frame(spark, aucs):
    return spark.createDataFrame(list(enumerate(aucs, 1)), "trees int, roc_auc double")


@pytest.mark.parametrize(
    ("aucs", "patience", "reached", "kept"),
    [
        ([0.5, 0.6, 0.6, 0.55, 0.9], 2, 4, 2),  # ends before the last one is seen
        ([0.5, 0.6, 0.6, 0.55, 0.9], 3, 5, 5),
        ([0.7, 0.7, 0.7], 20, 3, 1),
        ([None, None], 1, 1, 1),
        ([0.4, 0.5, 0.4], 1, 3, 2),
    ],
)
def test_patience(spark, aucs, patience, reached, kept):
    found = ensemble.kept_prefix(prefix_frame(spark, aucs), patience).collect()
    assert len(found) == reached and [r["trees"] for r in found if r["kept"]] == [kept]


def test_patience_goes_on_where_a_tolerance_stops(spark):
    """Two flags decide together: one tree of depth 1 brings next to nothing, later ones do."""
    base = spark.range(4000).select("id", (F.rand(5) < 0.5).cast("int").alias("a"), (F.rand(6) < 0.5).cast("int").alias("b"), F.rand(7).alias("noise"))
    labelled = base.withColumn("label", F.when(F.rand(8) < 0.05, 1 - (F.col("a") + F.col("b") > 0).cast("int")).otherwise((F.col("a") + F.col("b") > 0).cast("int")))
    rows = split.hash_split(labelled, "id").cache()
    features = FeatureColumns([], ["a", "b", "noise"], [])
    params = BoosterParams(trees=8, leaves=2, learning_rate=0.05, row_share=1.0, column_share=1.0, min_rows=1)
    kept = train_gbt(rows, "label", features, params).stages[-1].getNumTrees
    whole = train_gbt(rows, "label", features, params, early_stop=False)
    prepared = whole.transform(rows.filter("split = 'validation'")).select("features", "label")
    table = {r["trees"]: r["roc_auc"] for r in prefixes(whole.stages[-1], prepared, "label").collect()}
    assert table[2] - table[1] < 0.01 or table[kept] > table[1]
    assert kept > 1 and table[kept] == max(table.values())


def test_search_agrees_with_itself_and_beats_random_places():
    centre = (0.2, 0.7, 0.5, 0.9, 0.4, 0.3, 0.6, 0.1)
    value = lambda place, number: -sum((x - c) ** 2 for x, c in zip(place, centre, strict=True))
    assert search.search(value, 8, seed=3) == search.search(value, 8, seed=3) != search.search(value, 8, seed=4)
    modelled = [max(t.value for t in search.search(value, 8, seed=s, stale=99)) for s in range(12)]
    random = [max(value(p, 0) for p in np.random.default_rng(s).uniform(size=(32, 8))) for s in range(12)]
    assert np.mean(modelled) > np.mean(random)
    assert len(search.search(lambda place, number: 1.0, 2)) == search.STALE + 1  # nothing better for 20 trials
    assert len(search.search(lambda place, number: float(number), 2)) == search.TRIALS
    done = search.search(value, 8, trials=9, seed=3)
    assert search.next_place(done, 8, 3) == search.search(value, 8, trials=10, seed=3)[-1].place  # goes on from stored trials
    odd = [search.Trial(0, (0.5,), float("nan")), search.Trial(1, (0.5,), None), search.Trial(2, (0.1,), 0.3)]
    assert max(odd, key=lambda t: t.rank).number == 2


def test_registered_training_uses_the_whole_budget():
    assert BoosterParams().trees == 200 and search.TRIALS == 32 and search.STARTUP == 5 and ensemble.PATIENCE == 20


def test_broadcast_needs_a_proven_size(spark):
    big, small = spark.range(1000), spark.range(10)
    assert "broadcast" in broadcast_if_small(small, 100)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(big, 100)._jdf.queryExecution().logical().toString().lower()
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
