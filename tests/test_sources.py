import json

import pytest
from pyspark.sql import functions as F, types as T

from cohortflow.clinical import gold
from cohortflow.clinical.silver import SILVER_TABLES
from cohortflow.config import JobConfig, session_user
from cohortflow.plans import medallion
from cohortflow.plans.layout import cluster_rows
from cohortflow.registry.gold_queries import raw_rows
from cohortflow.sources import tables
from cohortflow.sources import json_files
from cohortflow.sources.json_files import infer_schema
from cohortflow.sources.snapshots import apply_changes, snapshot_diff
from cohortflow.streaming.ingest import BAD_RECORD, ingest_json_stream

SF = "/root/testdata/sf0.001"


def test_ingest_reads_each_file_once_and_filters_by_name(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "events_1.json").write_text(json.dumps([{"id": 1, "ok": True, "x": 1.5}, {"id": 2, "ok": False, "x": 2.0}], indent=2))
    (src / "other.json").write_text(json.dumps([{"id": 99}]))
    schema = infer_schema(spark, str(src), "events_*.json")
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [("id", "bigint"), ("ok", "boolean"), ("x", "double")]
    args = (str(src), schema, str(tmp_path / "bronze"), str(tmp_path / "marks"), "events_*.json")
    assert ingest_json_stream(spark, *args).count() == 2
    assert ingest_json_stream(spark, *args).count() == 2
    (src / "events_2.json").write_text(json.dumps([{"id": 3, "ok": True, "x": 0.0}]))
    bronze = ingest_json_stream(spark, *args, max_files=1)
    assert sorted(r["id"] for r in bronze.collect()) == [1, 2, 3]
    assert bronze.filter("_ingestion_timestamp IS NULL").count() == 0


def test_layers_from_shared_json_files_to_gold(spark, tmp_path, rows):
    src = tmp_path / "in"
    src.mkdir()
    frames = {t.entity: raw_rows(spark, SF, f"raw_{t.entity}") for t in SILVER_TABLES}
    for name, frame in frames.items():
        (src / f"{name}.json").write_text("[" + ",".join(frame.toJSON().collect()) + "]")
    tables.reset_database(spark, "layers", allow_drop=True)
    schemas = {name: infer_schema(spark, str(src), f"{name}.json") for name in frames}
    for _ in range(2):  # the second run finds no new files
        medallion.ingest_bronze(spark, "layers", {name: str(src) for name in frames}, str(tmp_path / "marks"), schemas)
    medallion.refresh_silver(spark, "layers")
    medallion.refresh_gold(spark, "layers")
    assert tables.missing_tables(spark, "layers", medallion.TABLES).count() == 0
    assert spark.read.table("layers.bronze_adverse_events").count() == frames["adverse_events"].count()
    report = {(r["table"], r["rule"]): r for r in medallion.silver_report(spark, "layers").collect()}
    assert len(report) == 10
    safety = spark.read.table("layers.gold_trial_safety_summary")
    sums = safety.agg(F.sum("total_adverse_events"), F.sum(F.col("severe_count") + F.col("moderate_count") + F.col("mild_count"))).first()
    assert sums[0] == sums[1] == spark.read.table("layers.silver_adverse_events").count()
    efficacy = spark.read.table("layers.gold_drug_efficacy")
    responses = sum((F.col(c) for c in gold.RESPONSE_COUNTS), F.lit(0))
    assert efficacy.filter(responses != F.col("total_observations")).count() == 0
    outcomes = spark.read.table("layers.gold_patient_outcomes")
    assert outcomes.count() == spark.read.table("layers.silver_trial_results").select("patient_id", "trial_id").distinct().count()
    assert {t["table"]: t["comment"] for t in tables.catalog_tables(spark, "layers").collect()}["silver_patients"] == SILVER_TABLES[2].comment
    tables.reset_database(spark, "layers", allow_drop=True)


def test_failed_refresh_leaves_the_old_rows(spark):
    tables.reset_database(spark, "publish", allow_drop=True)
    tables.materialize(spark.range(5), "publish.t", ["id"], "Five rows")
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.materialize(broken, "publish.t")
    assert spark.read.table("publish.t").count() == 5
    again = tables.materialize(spark.read.table("publish.t").filter("id > 1"), "publish.t")  # a table may replace itself
    assert again.count() == 3 and [t.name for t in spark.catalog.listTables("publish")] == ["t"]
    tables.reset_database(spark, "publish", allow_drop=True)


def test_bad_records_keep_their_text(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"id": 1}\n{"id": \n{"id": "x"}\n')
    found = ingest_json_stream(spark, str(src), T.StructType().add("id", "long"), str(tmp_path / "b"), str(tmp_path / "m"), multi_line=False, keep_bad=True)
    assert sorted((r["id"] or 0, r[BAD_RECORD]) for r in found.collect() if r["id"]) == [(1, None)]
    assert sorted(r[BAD_RECORD] for r in found.collect() if r[BAD_RECORD]) == ['{"id": ', '{"id": "x"}']


def test_hot_key_is_spread_over_files(spark):
    hot = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("k"), "id")
    laid = cluster_rows(hot, ["k"], partitions=8).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in laid.groupBy("part").count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 12000
    assert laid.filter("k = 7").select("part").distinct().count() > 2


def test_snapshot_diff_with_null_keys_and_duplicates(spark, rows):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "d"), (5, "d")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "x"), (None, "m"), (5, "d")], schema)
    changes = snapshot_diff(old, new, ["k"])
    assert rows(changes) == sorted(
        [
            (2, "b", "update_preimage", 1), (2, "B", "update_postimage", 1), (3, "c", "delete", 1), (4, "x", "insert", 1),
            (None, "n", "update_preimage", 1), (None, "m", "update_postimage", 1), (5, "d", "delete", 1),
        ],
        key=repr,
    )
    assert rows(apply_changes(old, changes), *["k", "v"]) == rows(new)


def test_fingerprint_ignores_order_but_not_content(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    first = tables.dataset_fingerprint(frame, "t").first()
    assert tables.dataset_fingerprint(frame.orderBy(F.desc("i")).repartition(3), "t").first() == first
    changed = tables.dataset_fingerprint(frame.withColumn("s", F.upper("s")), "t").first()
    assert changed["content_hash"] != first["content_hash"] and changed["n_rows"] == 2


def test_comments_survive_parquet(spark, tmp_path, rows):
    described = tables.describe_columns(spark.range(1), {"id": "Row number"})
    described.write.parquet(str(tmp_path / "t"))
    assert rows(tables.column_comments(spark.read.parquet(str(tmp_path / "t")))) == [("id", "Row number")]


def test_config_from_session(spark):
    spark.conf.set("cohortflow.seed", "10")
    try:
        config = JobConfig.from_session(spark)
    finally:
        spark.conf.unset("cohortflow.seed")
    assert config.seed == 10 and config.table("x") == "default.x" and session_user(spark)


def test_written_json_is_compressed_in_bounded_files(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(json_files, "FILE_ROWS", 40)
    frame = spark.range(0, 100, 1, 1).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("\u00e9\n"), F.col("id"))).alias("t"))
    path = json_files.write_json(frame, str(tmp_path / "j"))
    files = sorted((tmp_path / "j").glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    assert rows(json_files.read_json(spark, path, frame.schema)) == rows(frame)
    assert infer_schema(spark, path, "*.json.gz", multi_line=False).simpleString() == "struct<id:bigint,t:string>"


def test_gold_is_computed_once_before_it_is_laid_out(spark, tmp_path, monkeypatch):
    tables.reset_database(spark, "once", allow_drop=True)
    for t in SILVER_TABLES:
        frame = raw_rows(spark, SF, f"raw_{t.entity}")
        frame.write.saveAsTable(f"once.{t.name}")
    seen = {}
    kept = medallion.materialize
    monkeypatch.setattr(medallion, "materialize", lambda df, name, *a, **k: (seen.update({name: df._jdf.queryExecution().executedPlan().toString()}), kept(df, name, *a, **k))[1])
    medallion.refresh_gold(spark, "once")
    assert len(seen) == 3 and not any("Join" in plan or "Exchange" in plan for plan in seen.values())
    assert spark.read.table("once.gold_patient_outcomes").count() == spark.read.table("once.silver_trial_results").select("patient_id", "trial_id").distinct().count()
    tables.reset_database(spark, "once", allow_drop=True)
