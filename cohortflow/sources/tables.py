"""Catalog tables: publishing with layout, comments and statistics, and looking around."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cohortflow.plans.layout import cluster_on_curve, cluster_rows


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The rows below ``path`` in the given columns; none if nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def materialize(
    df: DataFrame,
    table: str,
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    statistics: bool = True,
    column_comments: Mapping[str, str] | None = None,
) -> DataFrame:
    """Recompute ``table`` from ``df`` and return it as read back.

    The new rows go to a folder of their own; when they are complete, one change of the table's location publishes them. So the table is never
    absent, a job that fails leaves the old rows readable, nothing is copied, and ``df`` may read the table it replaces. Only a change
    of columns drops the table's entry and makes it anew. The folder of the version before stays for readers that still use it.

    Statistics (row count from the file footers, column figures for the clustered columns only) let later
    plans size their joins from facts instead of guesses.
    """
    spark = df.sparkSession
    out = describe_columns(df, {c: t for c, t in (column_comments or {}).items() if c in df.columns})
    if cluster_by:  # several columns share the files' order, so that each of them prunes
        out = cluster_rows(out, cluster_by) if len(cluster_by) == 1 else cluster_on_curve(out, cluster_by)
    database, _, name = table.rpartition(".")
    folder = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = f"{folder.rstrip('/')}/{name}__{uuid.uuid4().hex[:12]}"
    out.write.parquet(path)
    fresh = spark.read.parquet(path).schema
    if spark.catalog.tableExists(table) and spark.read.table(table).schema != fresh:
        spark.sql(f"DROP TABLE {table}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION {_quoted(path)}")
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")
    if statistics:
        columns = f" FOR COLUMNS {', '.join(cluster_by)}" if cluster_by else ""
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{columns}")
    return spark.read.table(table)


def describe_columns(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments as metadata; Parquet schemas keep them."""
    for name, text in comments.items():
        df = df.withMetadata(name, {"comment": text})
    return df


def column_comments(df: DataFrame) -> DataFrame:
    """column, comment — what :func:`describe_columns` attached."""
    rows = [(f.name, f.metadata.get("comment")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, comment string")


def reset_database(spark: SparkSession, database: str, allow_drop: bool = False) -> None:
    """Create the database; with ``allow_drop`` remove it and everything in it first."""
    if allow_drop:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def catalog_tables(spark: SparkSession, database: str) -> DataFrame:
    rows = [(t.name, t.tableType, t.description) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "table string, kind string, comment string")


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """table, column, type of every table of a database."""
    rows = [
        (t.name, c.name, c.dataType)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
        for c in spark.catalog.listColumns(f"{database}.{t.name}")
    ]
    return spark.createDataFrame(rows, "table string, column string, type string")


def missing_tables(spark: SparkSession, database: str, expected: Sequence[str]) -> DataFrame:
    """Expected tables the database does not have; empty after a complete run."""
    wanted = spark.createDataFrame([(name,) for name in expected], "table string")
    return wanted.join(catalog_tables(spark, database), "table", "left_anti")


def dataset_fingerprint(df: DataFrame, source: str, target: str | None = None, content: Column | None = None) -> DataFrame:
    """One provenance row: source, target, schema, row count and an order-free content hash.

    With ``content``, a text of each row, the hash is one that other engines can check: the sum of the first 60 bits of its MD5.
    """
    row_hash = F.xxhash64(*df.columns).cast("decimal(20,0)") if content is None else F.conv(F.substring(F.md5(content), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(row_hash).cast("string").alias("content_hash")).select(
        F.lit(source).alias("source"),
        F.lit(target).alias("target"),
        F.lit(df.schema.json()).alias("schema"),
        "n_rows",
        "content_hash",
    )
