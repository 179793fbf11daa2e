"""Tables that grow batch by batch, schemas that change, layouts on a curve."""

import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from cohortflow.clinical.silver import ADVERSE_EVENTS, SILVER_TABLES, to_silver
from cohortflow.config import JobConfig
from cohortflow.plans import medallion
from cohortflow.plans.incremental import GroupState, StateTable, sign_of, touched
from cohortflow.plans.layout import cluster_on_curve, with_curve_position
from cohortflow.plans.model_job import ModelJob
from cohortflow.registry import growth_queries
from cohortflow.registry.gold_queries import raw_rows
from cohortflow.sources import tables
from cohortflow.sources.snapshots import snapshot_diff
from cohortflow.streaming.batches import SilverBatches
from cohortflow.streaming.evolving import RESCUED, grown_schema, ingest_growing, merged_schema, parsed_lines, stored_schema
from cohortflow.streaming.ingest import BAD_RECORD, INGESTED_AT

SF = "/root/testdata/sf0.001"


@pytest.fixture
def bronze(spark):
    return raw_rows(spark, SF, "raw_adverse_events").withColumn(INGESTED_AT, F.current_timestamp())


def test_a_replayed_batch_counts_once(spark, tmp_path, bronze):
    silver = SilverBatches(spark, str(tmp_path / "s"), ADVERSE_EVENTS)
    like = to_silver(bronze, ADVERSE_EVENTS).schema
    assert silver.rows(like).count() == 0 and silver.report().count() == 0
    first, second = bronze.filter("days_on_treatment <= 60"), bronze.filter("days_on_treatment > 60")
    silver.write(first, 0)
    silver.write(second, 1)
    before = sorted(map(tuple, silver.report().collect()))
    for _ in range(2):
        silver.write(second, 1)
    assert sorted(map(tuple, silver.report().collect())) == before
    assert silver.rows(like).count() == to_silver(bronze, ADVERSE_EVENTS).count()


@pytest.mark.parametrize("name", ["silver_incremental", "silver_ledger"])
def test_the_second_batch_is_given_once_more(spark, monkeypatch, bronze, rows, name):
    given, write = [], SilverBatches.write
    raw = bronze.drop(INGESTED_AT).withColumn("dosage_mg", F.col("dosage_mg").cast("double")).limit(500).cache()
    monkeypatch.setattr(SilverBatches, "write", lambda self, batch, number: given.append((number, rows(batch, "event_id", "days_on_treatment"))) or write(self, batch, number))
    monkeypatch.setattr(growth_queries, "raw_rows", lambda *_: raw)
    found = growth_queries.QUERIES[name][0](spark, SF)
    first, second = (rows(raw.filter(part), "event_id", "days_on_treatment") for part in ("days_on_treatment <= 90", "days_on_treatment > 90"))
    assert given == [(0, first), (1, second), (1, second)] and first and second
    if name == "silver_incremental":
        assert found.count() == to_silver(raw.withColumn(INGESTED_AT, F.current_timestamp()), ADVERSE_EVENTS).count()
    else:
        assert {r["passed"] + r["failed"] for r in found.collect()} == {raw.count()}


def test_a_batch_without_a_ledger_entry_is_not_seen(spark, tmp_path, bronze):
    silver = SilverBatches(spark, str(tmp_path / "s"), ADVERSE_EVENTS)
    kept = to_silver(bronze, ADVERSE_EVENTS)
    silver.write(bronze.filter("days_on_treatment <= 60"), 0)
    kept.write.parquet(f"{silver.root}/rows/batch=1")  # died before its last act
    assert silver.rows(kept.schema).count() == kept.filter("days_on_treatment <= 60").count()
    silver.write(bronze.filter("days_on_treatment > 60"), 1)
    assert silver.rows(kept.schema).count() == kept.count()


def test_a_batch_also_brings_the_reports_up_to_date(spark, tmp_path, bronze, rows):
    state = GroupState(("trial_id",), "n", {"serious": F.col("serious")}, {"risk": ("risk_score", 2)})
    report = StateTable.at(to_silver(bronze, ADVERSE_EVENTS), str(tmp_path / "gold"), state)
    silver = SilverBatches(spark, str(tmp_path / "s"), ADVERSE_EVENTS, (report,))
    for number, part in enumerate(("days_on_treatment <= 60", "days_on_treatment > 60")):
        silver.write(bronze.filter(part), number)
    silver.write(bronze.filter("days_on_treatment > 60"), 1)
    assert rows(report.report()) == rows(state.report(state.of(to_silver(bronze, ADVERSE_EVENTS))))


def plain_state():
    return GroupState(("k",), "n", {"big": F.col("v") > 5}, {"mean": ("v", 2)})


def test_states_add_up_to_the_report_of_all_rows(spark, tmp_path, rows):
    data = [("a", 1.5), ("a", 9.0), ("b", None), (None, 7.0), ("b", 2.0), ("c", 6.0), ("a", 0.1), ("a", 0.2)]
    frame = spark.createDataFrame(data, "k string, v double")
    state = plain_state()
    whole = rows(state.report(state.of(frame)))
    assert whole == sorted([("a", 4, 1, 2.7), ("b", 2, 0, 2.0), (None, 1, 1, 7.0), ("c", 1, 1, 6.0)], key=repr)
    table = StateTable.at(frame, str(tmp_path / "t"), state)
    assert rows(table.report()) == []
    for number in range(4):
        table.add(number, spark.createDataFrame(data[2 * number : 2 * number + 2], "k string, v double"))
        if number == 1:
            table.fold(1)
            table.fold(1)  # nothing left to do
    assert rows(table.report()) == whole
    table.add(3, spark.createDataFrame(data[6:], "k string, v double"))  # repeated
    table.fold(3)
    assert rows(table.report()) == whole
    assert table.current().schema["mean__sum"].dataType == T.DecimalType(38, 9) and rows(table.current(), "mean__sum")[0] == (Decimal("10.800000000"),)


def test_change_rows_move_the_report_to_the_new_state(spark, tmp_path, rows):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "a", 8.0), (3, "b", 6.0), (4, "c", 2.0), (5, None, 3.0)], "id int, k string, v double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 8.0), (4, "c", 2.5), (6, "d", 9.0), (5, None, 3.0)], "id int, k string, v double")
    state, changes = plain_state(), snapshot_diff(old, new, ["id"])
    table = StateTable.at(old, str(tmp_path / "t"), state)
    table.add(0, old)
    table.add(1, changes, sign_of(changes))
    assert rows(table.report()) == rows(state.report(state.of(new)))
    assert {r["k"] for r in touched(state, table, changes).collect()} == {"a", "b", "c", "d"}


def test_bringing_a_table_up_to_date_reads_the_changed_rows_only(spark, tmp_path):
    root, state = str(tmp_path / "t"), plain_state()
    old, changed = str(tmp_path / "old"), str(tmp_path / "changed")
    spark.range(100).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").cast("double").alias("v")).write.parquet(old)
    spark.range(2).select(F.lit("1").alias("k"), F.lit(2.0).alias("v")).write.parquet(changed)
    table = StateTable.at(spark.read.parquet(old), root, state)
    table.add(0, spark.read.parquet(old))
    assert all("/changed/" in f for f in state.of(spark.read.parquet(changed)).inputFiles())
    table.fold(0)
    table.add(1, spark.read.parquet(changed))
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "(batch" in plan.split("> 0)")[0]  # folders of folded batches are pruned


def test_lines_of_all_kinds(spark):
    schema = T.StructType().add("id", "long").add("name", "string").add("tags", T.ArrayType(T.StringType()))
    texts = ['{"id": 1, "name": "a", "tags": ["x"]}', '{"id": "one", "name": "b"}', '{"id": 2, "more": {"k": 1}, "other": null}', '{"id": 3', "[1]", "  ", '{"id": null, "tags": 5}', "{}"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    found = {r["id"] or r["name"] or r[BAD_RECORD] or str(r[RESCUED]): r for r in parsed_lines(frame, schema).collect()}
    assert found[1][RESCUED] is None and found[1]["tags"] == ["x"]
    assert found["b"][RESCUED] == {"id": "one"} and found["b"]["id"] is None
    assert found[2][RESCUED] == {"more": '{"k":1}'}
    assert found['{"id": 3'][BAD_RECORD] and found["[1]"][BAD_RECORD]
    assert len(found) == 7


def test_a_schema_grows_and_keeps_its_types(spark, tmp_path, rows):
    src, target, marks = tmp_path / "in", str(tmp_path / "b"), str(tmp_path / "m")
    src.mkdir()
    (src / "a.json").write_text('{"id": 1, "x": 5}\n')
    assert ingest_growing(spark, str(src), target, marks).count() == 1
    (src / "b.json").write_text('{"id": 2, "x": 1.5, "city": "A"}\n{"id": 3, "city": "B", "x": 7}\nnothing\n')
    for _ in range(2):  # the second start finds nothing new
        found = ingest_growing(spark, str(src), target, marks)
    got = sorted(((r["id"], r["x"], r["city"], r[RESCUED], r[BAD_RECORD]) for r in found.collect()), key=repr)
    assert got == sorted([(1, 5, None, None, None), (2, None, "A", {"x": "1.5"}, None), (3, 7, "B", None, None), (None, None, None, None, "nothing")], key=repr)
    number, schema = stored_schema(spark, f"{marks}/schema")
    assert number == 2 and [f.name for f in schema.fields if not f.name.startswith("_")] == ["id", "x", "city"]
    assert grown_schema(spark, str(src), f"{marks}/schema") == schema
    assert merged_schema(None, schema) == schema


def test_only_newer_files_are_looked_at(spark, tmp_path):
    src, versions = tmp_path / "in", str(tmp_path / "v")
    src.mkdir()
    (src / "a.json").write_text('{"id": 1}\n')
    assert grown_schema(spark, str(src), versions).names == ["id"]
    (src / "old.json").write_text('{"id": 2, "unseen": 1}\n')
    os.utime(src / "old.json", (1, 1))
    os.utime(src / "a.json", (1, 1))
    assert grown_schema(spark, str(src), versions).names == ["id"]  # no newer file
    (src / "b.json").write_text('{"city": "x"}\n')
    assert grown_schema(spark, str(src), versions).names == ["id", "city"]
    assert stored_schema(spark, versions)[0] == 2


def test_layers_with_growing_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    frames = {t.entity: raw_rows(spark, SF, f"raw_{t.entity}") for t in SILVER_TABLES}
    for name, frame in frames.items():
        (src / f"{name}.json").write_text("\n".join(frame.toJSON().collect()))
    tables.reset_database(spark, "growing", allow_drop=True)
    sources, marks = {name: str(src) for name in frames}, str(tmp_path / "marks")
    medallion.ingest_bronze(spark, "growing", sources, marks)
    silver = medallion.silver_batches(spark, "growing", str(tmp_path / "silver"))
    more = json.dumps({"event_id": "late", "patient_id": "PAT-1", "trial_id": "TRIAL-1", "site": "north", "dosage_mg": "many"})
    (src / "adverse_events_2.json").write_text(more + "\nbroken\n")
    medallion.ingest_bronze(spark, "growing", sources, marks)
    silver = medallion.silver_batches(spark, "growing", str(tmp_path / "silver"))
    bronze = spark.read.table("growing.bronze_adverse_events")
    late = bronze.filter("event_id = 'late'").first()
    assert late["site"] == "north" and late[RESCUED] == {"dosage_mg": "many"}
    bad = {r["table"]: (r["n_rows"], r["bad"]) for r in medallion.bad_records(spark, "growing").collect()}
    assert bad["bronze_adverse_events"] == (frames["adverse_events"].count() + 2, 1) and bad["bronze_patients"][1] == 0
    report = {r["rule"]: r for r in silver["adverse_events"].report().collect()}
    raw = frames["adverse_events"]
    assert report["valid_event_id"]["dropped"] == raw.filter("event_id IS NULL").count() + 1
    assert report["valid_event_id"]["passed"] == raw.filter("event_id IS NOT NULL").count() + 1
    tables.reset_database(spark, "growing", allow_drop=True)


def test_a_filter_on_either_column_touches_few_files(spark, tmp_path):
    base = spark.range(0, 40_000, 1, 4).select((F.col("id") * 7919 % 1000).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 104729 % 997).cast("string"), 3, "0")).alias("b"), "id")
    path = str(tmp_path / "z")
    cluster_on_curve(base, ["a", "b"], partitions=64).write.parquet(path)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert back.count() == 40_000
    spans = back.groupBy("file").agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1")).collect()
    assert len(spans) >= 32
    for low, high, value in (("a0", "a1", 500), ("b0", "b1", "k500")):
        hit = sum(r[low] <= value <= r[high] for r in spans)
        assert hit <= len(spans) / 3


def test_curve_with_hot_values_and_nulls(spark):
    hot = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("b"), "id")
    laid = cluster_on_curve(hot, ["a", "b"], partitions=8).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in laid.groupBy("part").count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 12_000 and laid.filter("a IS NULL").count() == 0


def test_curve_places_are_the_bits_of_the_ranks_and_no_row_walks_all_edges(spark):
    value = F.when(F.col("id") % 7 > 0, F.when(F.col("id") % 11 == 0, float("nan")).otherwise((F.col("id") * 37 % 101).cast("double")))
    rows = spark.range(0, 2000, 1, 1).select("id", value.alias("a"), F.lit(5).alias("b"), F.lit(None).cast("int").alias("c"))
    placed = with_curve_position(rows, ["a", "b", "c"])
    assert placed.columns == ["id", "a", "b", "c", "_curve"]
    assert "lambda" not in placed._jdf.queryExecution().executedPlan().toString()
    edges = rows.agg(F.percentile_approx("a", [k / 256 for k in range(1, 256)], 2000)).first()[0]
    edges = [float("inf") if e != e else e for e in {*edges}]  # no value is infinite here, so it may stand for NaN
    for r in placed.collect():
        a = float("inf") if r["a"] is not None and r["a"] != r["a"] else r["a"]
        ranks = [0 if a is None else sum(e <= a for e in edges), 1, 0]
        assert r["_curve"] == sum((rank >> bit & 1) << (bit * 3 + n) for n, rank in enumerate(ranks) for bit in range(8))


def test_the_layered_run_takes_its_parameters_from_the_session(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for t in SILVER_TABLES:
        (src / f"{t.entity}.json").write_text("\n".join(raw_rows(spark, SF, f"raw_{t.entity}").limit(200).toJSON().collect()))
    values = {"database": "from_session", "source_dir": str(src), "work_dir": str(tmp_path / "work"), "seed": "7"}
    for name, value in values.items():
        spark.conf.set(f"cohortflow.{name}", value)
    try:
        assert medallion.run_layers(spark).count() == 0
        assert ModelJob.of(JobConfig.from_session(spark), "m", "silver_adverse_events").source == "from_session.silver_adverse_events"
    finally:
        for name in values:
            spark.conf.unset(f"cohortflow.{name}")
    comments = {r["column"]: r["comment"] for r in tables.column_comments(spark.read.table("from_session.gold_drug_efficacy")).collect()}
    assert comments["phase"] == "Phase I to Phase IV" and comments["total_observations"] is None
    tables.reset_database(spark, "from_session", allow_drop=True)


def test_publishing_never_removes_the_table(spark, tmp_path):
    tables.reset_database(spark, "steady", allow_drop=True)
    tables.materialize(spark.range(5), "steady.t", ["id"], "Five rows")
    reader = spark.read.table("steady.t")
    old = reader.inputFiles()
    tables.materialize(spark.range(9), "steady.t", ["id"], "Nine rows")
    assert spark.read.table("steady.t").count() == 9 and not {*old} & {*spark.read.table("steady.t").inputFiles()}
    assert reader.count() in (5, 9)  # the version before is still there for those who read it
    wider = tables.materialize(spark.range(3).withColumn("x", F.lit(1)), "steady.t")
    assert wider.columns == ["id", "x"] and wider.count() == 3
    tables.reset_database(spark, "steady", allow_drop=True)
