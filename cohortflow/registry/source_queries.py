"""Streaming ingest, table publishing, layout, snapshots, provenance and the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.clinical import gold
from cohortflow.clinical.silver import SILVER_TABLES
from cohortflow.plans import medallion
from cohortflow.plans.layout import cluster_rows
from cohortflow.plans.lineage import scratch_path
from cohortflow.registry.bindings import table, with_views
from cohortflow.registry.gold_queries import SAFETY_SQL, raw_rows, raw_sql
from cohortflow.sources import json_files, snapshots, tables
from cohortflow.streaming.ingest import BAD_RECORD, INGESTED_AT, ingest_json_stream


def _events_as_json(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    events = table(spark, d, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return json_files.write_json(events, scratch_path(spark, "json")), events


EVENTS_SQL = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"


def _round_trip(spark: SparkSession, d: str) -> DataFrame:
    path, events = _events_as_json(spark, d)
    return json_files.read_json(spark, path, events.schema)


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """All files, then a second run that finds nothing new."""
    path, _ = _events_as_json(spark, d)
    schema = json_files.infer_schema(spark, path, "*.json.gz", multi_line=False)
    target, marks = scratch_path(spark, "bronze"), scratch_path(spark, "marks")
    for _ in range(2):
        bronze = ingest_json_stream(spark, path, schema, target, marks, "*.json.gz", multi_line=False)
    return bronze.drop(INGESTED_AT)


def _schema(spark: SparkSession, d: str) -> DataFrame:
    path, _ = _events_as_json(spark, d)
    return json_files.schema_as_rows(spark, json_files.infer_schema(spark, path, "*.json.gz", multi_line=False))


#: Every record of these numbers is broken on purpose, one kind with a cut line, the other with a text where a number belongs.
BROKEN, MISTYPED = 97, 89


def _bad_records(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON lines of which some are broken: good rows, and the text of the bad ones, all kept."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    cut = F.concat(F.lit("{\"event_id\": "), F.col("event_id").cast("string"))
    mistyped = F.to_json(F.struct("event_id", F.concat(F.lit("u"), F.col("user_id")).alias("user_id"), "event_type"))
    lines = events.select(F.when(F.col("event_id") % BROKEN == 0, cut).when(F.col("event_id") % MISTYPED == 0, mistyped).otherwise(line))
    path = scratch_path(spark, "lines")
    lines.write.text(path)
    bronze = ingest_json_stream(
        spark, path, events.schema, scratch_path(spark, "bronze"), scratch_path(spark, "marks"), multi_line=False, keep_bad=True
    )
    bad = F.col(BAD_RECORD).isNotNull()
    return bronze.select(
        F.when(~bad, F.col("event_id")).alias("event_id"), F.when(~bad, F.col("user_id")).alias("user_id"), F.when(~bad, F.col("event_type")).alias("event_type"), F.col(BAD_RECORD).alias("bad_text")
    )


BAD_SQL = f"""SELECT CASE WHEN fine THEN event_id END AS event_id, CASE WHEN fine THEN user_id END AS user_id, CASE WHEN fine THEN event_type END AS event_type,
  CASE WHEN event_id % {BROKEN} = 0 THEN '{{"event_id": ' || event_id
       WHEN event_id % {MISTYPED} = 0 THEN '{{"event_id":' || event_id || ',"user_id":"u' || user_id || '","event_type":"' || event_type || '"}}' END AS bad_text
FROM (SELECT *, event_id % {BROKEN} <> 0 AND event_id % {MISTYPED} <> 0 AS fine FROM events)"""


def _write_raw(spark: SparkSession, d: str, entity: str) -> tuple[str, DataFrame]:
    rows = raw_rows(spark, d, f"raw_{entity}")
    return json_files.write_json(rows, scratch_path(spark, entity)), rows


def _bronze(entity: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        path, rows = _write_raw(spark, d, entity)
        bronze = ingest_json_stream(
            spark, path, rows.schema, scratch_path(spark, "bronze"), scratch_path(spark, "marks"), "*.json.gz", multi_line=False
        )
        return bronze.drop(INGESTED_AT, "pre_existing_conditions")

    return run


def _fresh_database(spark: SparkSession) -> str:
    name = f"cohortflow_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def _run_layers(spark: SparkSession, d: str) -> str:
    """Raw JSON through bronze, silver and gold tables of a fresh database."""
    database = _fresh_database(spark)
    written = {t.entity: _write_raw(spark, d, t.entity) for t in SILVER_TABLES}
    medallion.ingest_bronze(
        spark,
        database,
        {entity: path for entity, (path, _) in written.items()},
        scratch_path(spark, "marks"),
        {entity: rows.schema for entity, (_, rows) in written.items()},
        name_glob="*.json.gz",
        multi_line=False,
    )
    medallion.refresh_silver(spark, database)
    medallion.refresh_gold(spark, database)
    return database


def _layer(name: str):
    return lambda spark, d: spark.read.table(f"{_run_layers(spark, d)}.{name}")


LAYERS_SQL = with_views(
    SAFETY_SQL.replace("b_events", "kept_events").replace("b_trials", "kept_trials"),
    raw_adverse_events=raw_sql("raw_adverse_events"),
    raw_clinical_trials=raw_sql("raw_clinical_trials"),
    kept_events="SELECT * FROM raw_adverse_events WHERE event_id IS NOT NULL AND patient_id IS NOT NULL",
    kept_trials="SELECT * FROM raw_clinical_trials WHERE trial_id IS NOT NULL",
)


def _materialized(spark: SparkSession, d: str) -> DataFrame:
    database = _fresh_database(spark)
    return tables.materialize(
        table(spark, d, "orders"), f"{database}.orders", ["o_custkey", "o_orderdate"], "Orders by customer and day"
    )


def _laid_out(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "layout")
    cluster_rows(table(spark, d, "lineitem"), ["l_suppkey", "l_shipdate"]).write.parquet(path)
    return spark.read.parquet(path)


def _published(spark: SparkSession, d: str) -> str:
    """Two given tables in a fresh database."""
    database = _fresh_database(spark)
    for name in ("nation", "supplier"):
        tables.materialize(table(spark, d, name), f"{database}.{name}", comment=f"Given table {name}")
    return database


def _absent(spark: SparkSession, d: str) -> DataFrame:
    return tables.missing_tables(spark, _published(spark, d), ["nation", "supplier", "orders"])


# --- snapshots: one status deleted, one priority changed, one status added under new keys ----------


def _states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    old = table(spark, d, "orders")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    added = old.filter("o_orderstatus = 'F'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    new = old.filter("o_orderstatus <> 'P'").withColumn("o_totalprice", price).unionByName(added)
    return old, new


def _changes(spark: SparkSession, d: str) -> DataFrame:
    old, new = _states(spark, d)
    return snapshots.snapshot_diff(old, new, ["o_orderkey"])


STATES_SQL = """WITH new_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'F')
"""
CHANGES_SQL = (
    STATES_SQL
    + """SELECT n.*, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _copies FROM new_orders n ANTI JOIN orders o ON n.o_orderkey = o.o_orderkey
UNION ALL SELECT o.*, 'delete', CAST(1 AS BIGINT) FROM orders o ANTI JOIN new_orders n ON n.o_orderkey = o.o_orderkey
UNION ALL SELECT o.*, 'update_preimage', CAST(1 AS BIGINT) FROM orders o JOIN new_orders n ON n.o_orderkey = o.o_orderkey WHERE n.o_totalprice <> o.o_totalprice
UNION ALL SELECT n.*, 'update_postimage', CAST(1 AS BIGINT) FROM orders o JOIN new_orders n ON n.o_orderkey = o.o_orderkey WHERE n.o_totalprice <> o.o_totalprice"""
)


def _applied(spark: SparkSession, d: str) -> DataFrame:
    """Old state plus the changes gives the new state."""
    old, new = _states(spark, d)
    return snapshots.apply_changes(old, snapshots.snapshot_diff(old, new, ["o_orderkey"])).drop("_copies")


#: A row's text that every engine writes alike.
ROW_TEXT = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")


def _content(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ROW_TEXT])
    return tables.dataset_fingerprint(table(spark, d, "lineitem"), "lineitem", "l_returnflag", text).drop("schema")


CONTENT_SQL = f"""SELECT 'lineitem' AS source, 'l_returnflag' AS target, count(*) AS n_rows,
  CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(ROW_TEXT)})), 1, 15) AS BIGINT)) AS VARCHAR) AS content_hash FROM lineitem"""

QUERIES = {
    "json_roundtrip": (_round_trip, EVENTS_SQL),
    "ingest_json_stream": (_stream, EVENTS_SQL),
    "ingest_bad_records": (_bad_records, BAD_SQL),
    "infer_schema": (
        _schema,
        """SELECT column_name AS "column", CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS type
FROM (DESCRIBE events)""",
    ),
    **{
        f"bronze_{t.entity}": (
            _bronze(t.entity),
            with_views(f"SELECT * FROM raw_{t.entity}", **{f"raw_{t.entity}": raw_sql(f"raw_{t.entity}")}),
        )
        for t in SILVER_TABLES
    },
    "medallion_gold_safety": (_layer(gold.SAFETY.name), LAYERS_SQL),
    "materialize": (_materialized, "SELECT * FROM orders"),
    "layout_by_key": (_laid_out, "SELECT * FROM lineitem"),
    "snapshot_diff": (_changes, CHANGES_SQL),
    "apply_changes": (_applied, STATES_SQL + "SELECT * FROM new_orders"),
    "catalog_columns": (
        lambda s, d: tables.catalog_columns(s, _published(s, d)).drop("type"),
        """SELECT 'nation' AS "table", column_name AS "column" FROM (DESCRIBE nation)
UNION ALL SELECT 'supplier', column_name FROM (DESCRIBE supplier)""",
    ),
    "missing_tables": (_absent, """SELECT DISTINCT 'orders' AS "table" FROM orders"""),
    "content_fingerprint": (_content, CONTENT_SQL),
    "dataset_fingerprint": (lambda s, d: tables.dataset_fingerprint(table(s, d, "lineitem"), "lineitem", "l_returnflag"), None),
}
