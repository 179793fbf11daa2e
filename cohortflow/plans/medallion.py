"""One run of the layered tables: new files into bronze, then silver and gold recomputed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortflow.clinical import gold
from cohortflow.clinical.silver import SILVER_TABLES, to_silver, typed_columns
from cohortflow.config import JobConfig
from cohortflow.operators.quality import quality_report
from cohortflow.plans.lineage import stored
from cohortflow.semantic.clinical import clinical_model
from cohortflow.sources.tables import materialize, missing_tables, reset_database
from cohortflow.streaming.batches import SilverBatches
from cohortflow.streaming.evolving import append_growing
from cohortflow.streaming.ingest import BAD_RECORD, append_to_table, json_stream

TABLES = tuple(
    [t.source for t in SILVER_TABLES]
    + [t.name for t in SILVER_TABLES]
    + [t.name for t in (gold.SAFETY, gold.OUTCOMES, gold.EFFICACY)]
)


def ingest_bronze(
    spark: SparkSession,
    database: str,
    sources: Mapping[str, str],
    checkpoint_dir: str,
    schemas: Mapping[str, T.StructType] | None = None,
    name_glob: str = "{entity}*.json",
    multi_line: bool = True,
    keep_bad: bool = True,
) -> None:
    """One stream per entity, running side by side. Entities may share a folder: the file name tells them apart.

    With ``keep_bad`` records that do not fit keep their text. Without ``schemas`` the files are JSON lines whose fields may grow: the
    schema is stored next to the checkpoints, new fields become columns, and what does not fit is kept per record.
    """
    queries = []
    for table in SILVER_TABLES:
        glob, marks, name = name_glob.format(entity=table.entity), f"{checkpoint_dir}/{table.entity}", f"{database}.{table.source}"
        if schemas is None:
            queries.append(append_growing(spark, sources[table.entity], name, marks, glob))
        else:
            stream = json_stream(spark, sources[table.entity], schemas[table.entity], glob, multi_line, keep_bad=keep_bad)
            queries.append(append_to_table(stream, name, marks))
    for query in queries:
        query.awaitTermination()


def refresh_silver(spark: SparkSession, database: str) -> None:
    """Recompute the silver tables from bronze."""
    for table in SILVER_TABLES:
        silver = to_silver(spark.read.table(f"{database}.{table.source}"), table)
        materialize(silver, f"{database}.{table.name}", table.cluster_by, table.comment)


def bad_records(spark: SparkSession, database: str) -> DataFrame:
    """table, n_rows, bad: how many bronze records did not fit, per table that keeps them."""
    parts = []
    for table in SILVER_TABLES:
        bronze = spark.read.table(f"{database}.{table.source}")
        bad = F.count(BAD_RECORD) if BAD_RECORD in bronze.columns else F.lit(0).cast("long")
        parts.append(bronze.agg(F.count(F.lit(1)).alias("n_rows"), bad.alias("bad")).select(F.lit(table.source).alias("table"), "n_rows", "bad"))
    return reduce(DataFrame.unionByName, parts)


def silver_batches(spark: SparkSession, database: str, work_dir: str) -> dict[str, SilverBatches]:
    """Silver tables that grow with bronze, by entity: new bronze rows only, each micro-batch once, its rule counts in the ledger."""
    found = {t.entity: SilverBatches(spark, f"{work_dir}/{t.name}", t) for t in SILVER_TABLES}
    for table in SILVER_TABLES:
        found[table.entity].update(spark.readStream.table(f"{database}.{table.source}"))
    return found


def silver_report(spark: SparkSession, database: str) -> DataFrame:
    """table, rule, action, passed, failed, dropped for all rules, counted over bronze.

    Reads only the columns the rules mention. Counting apart from the write keeps the numbers right when
    the write's range sort or a lost executor runs a part of its plan twice.
    """
    parts = [
        quality_report(typed_columns(spark.read.table(f"{database}.{t.source}"), t), t.rules).select(
            F.lit(t.name).alias("table"), "*"
        )
        for t in SILVER_TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def gold_frames(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three gold tables from silver tables given by entity name."""
    events, trials = silver["adverse_events"], silver["clinical_trials"]
    results, patients = silver["trial_results"], silver["patients"]
    return {
        gold.SAFETY.name: gold.trial_safety_summary(events, trials),
        gold.OUTCOMES.name: gold.patient_outcomes(results, patients, events),
        gold.EFFICACY.name: gold.drug_efficacy(results, trials),
    }


def refresh_gold(spark: SparkSession, database: str) -> None:
    """Recompute the gold tables from silver, with the governed model's column descriptions.

    Laying a table out reads its rows three times (edges, ranges, rows), so they are joined and grouped once and stored before that.
    """
    described = clinical_model().comments
    frames = gold_frames({t.entity: spark.read.table(f"{database}.{t.name}") for t in SILVER_TABLES})
    for table in (gold.SAFETY, gold.OUTCOMES, gold.EFFICACY):
        materialize(stored(frames[table.name], table.name), f"{database}.{table.name}", table.cluster_by, table.comment, column_comments=described.get(table.name))


def run_layers(spark: SparkSession, config: JobConfig | None = None) -> DataFrame:
    """The whole layered run with the session's parameters: new files of ``source_dir`` into bronze, silver and gold of ``database``.

    Marks and schema versions lie below ``work_dir``. Returns the expected tables that are missing, that is none.
    """
    config = config or JobConfig.from_session(spark)
    reset_database(spark, config.database)
    ingest_bronze(spark, config.database, {t.entity: config.source_dir for t in SILVER_TABLES}, f"{config.work_dir}/marks")
    refresh_silver(spark, config.database)
    refresh_gold(spark, config.database)
    return missing_tables(spark, config.database, TABLES)
