"""Ingest of JSON lines whose fields change over time.

The schema is stored in versions. At every start the fields of the files are merged into it: new ones are added, known ones keep their type.
What does not fit is kept: fields of other types, and fields that came after the start, in a map per record; lines that are no JSON object as text.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cohortflow.sources.json_files import infer_schema
from cohortflow.sources.tables import read_parquet
from cohortflow.streaming.ingest import BAD_RECORD, INGESTED_AT, append_to_path, append_to_table

RESCUED = "_rescued_fields"
VERSIONS = "version int, schema string, at timestamp"
#: Files this much older than the last look are looked at once more: clocks of file systems are coarse.
OVERLAP = timedelta(seconds=5)


def stored_schema(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    """The newest version below ``path`` and its schema; version 0 if there is none."""
    row = read_parquet(spark, path, VERSIONS).orderBy(F.desc("version"), F.desc("at")).first()
    return (row["version"], T.StructType.fromJson(json.loads(row["schema"]))) if row else (0, None)


def merged_schema(known: T.StructType | None, found: T.StructType) -> T.StructType:
    """``known`` with the fields it lacks, in the order found. Fields it has keep their type, as rows of that type are stored."""
    if known is None:
        return found
    names = set(known.names)
    return T.StructType([*known.fields, *(f for f in found.fields if f.name not in names)])


def grown_schema(spark: SparkSession, source_dir: str, versions: str, name_glob: str | None = None) -> T.StructType:
    """The schema to read with: only files newer than the last look are inferred, and new fields make a new version.

    Every look is stored with its time, so the next one knows where to begin.
    """
    began = datetime.now(timezone.utc)
    number, known = stored_schema(spark, versions)
    last = read_parquet(spark, versions, VERSIONS).agg(F.unix_micros(F.max("at"))).first()[0]
    after = datetime.fromtimestamp(last / 1e6, timezone.utc) - OVERLAP if last else None
    try:
        found = infer_schema(spark, source_dir, name_glob, multi_line=False, modified_after=after)
    except AnalysisException as error:
        if known is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return known  # no newer file
    merged = merged_schema(known, T.StructType([f for f in found.fields if f.name != BAD_RECORD]))
    row = (number + (merged != known), merged.json(), began)
    spark.createDataFrame([row], VERSIONS).coalesce(1).write.mode("append").parquet(versions)
    return merged


def _rescued(raw: Column, typed: Column, fields: Sequence[T.StructField]) -> Column:
    """name -> text of the record's fields that the typed columns do not hold; null if there are none."""
    unfit = [F.when(raw[f.name].isNotNull() & typed[f.name].isNull(), F.struct(F.lit(f.name).alias("key"), raw[f.name].alias("value"))) for f in fields]
    known = F.array(*[F.lit(f.name) for f in fields])
    unknown = F.filter(F.map_entries(F.map_filter(raw, lambda k, v: ~F.array_contains(known, k) & v.isNotNull())), lambda e: e.isNotNull())
    entries = F.concat(F.filter(F.array(*unfit), lambda e: e.isNotNull()), unknown)
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def parsed_lines(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """The schema's columns, the rescued fields and the bad text of every line of JSON. Blank lines are left out."""
    text = F.col(line)
    typed = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    raw = F.from_json(text, "map<string,string>")
    bad = F.get_json_object(text, "$").isNull() | ~F.ltrim(text).startswith("{") | raw.isNull()
    parts = lines.filter(F.trim(text) != "").select(text.alias("_line"), typed.alias("_typed"), raw.alias("_raw"), bad.alias("_bad"))
    columns = [F.when(~F.col("_bad"), F.col("_typed")[f.name]).alias(f.name) for f in schema.fields]
    rescued = F.when(~F.col("_bad"), _rescued(F.col("_raw"), F.col("_typed"), schema.fields))
    return parts.select(*columns, rescued.alias(RESCUED), F.when(F.col("_bad"), F.col("_line")).alias(BAD_RECORD))


def growing_stream(spark: SparkSession, source_dir: str, schema: T.StructType, name_glob: str | None = None) -> DataFrame:
    """Unstarted stream over a folder of JSON lines."""
    reader = spark.readStream.option("pathGlobFilter", name_glob) if name_glob else spark.readStream
    return parsed_lines(reader.text(source_dir), schema).withColumn(INGESTED_AT, F.current_timestamp())


def ingest_growing(spark: SparkSession, source_dir: str, target_dir: str, marks: str, name_glob: str | None = None) -> DataFrame:
    """Bring ``target_dir`` up to date with the folder and return it in the newest schema. ``marks`` holds the checkpoint and the
    schema versions. A rerun adds nothing; older rows are null in newer columns."""
    schema = grown_schema(spark, source_dir, f"{marks}/schema", name_glob)
    append_to_path(growing_stream(spark, source_dir, schema, name_glob), target_dir, f"{marks}/files").awaitTermination()
    extra = T.StructType().add(RESCUED, T.MapType(T.StringType(), T.StringType())).add(BAD_RECORD, T.StringType()).add(INGESTED_AT, T.TimestampType())
    return spark.read.schema(T.StructType([*schema.fields, *extra.fields])).parquet(target_dir)


def append_growing(spark: SparkSession, source_dir: str, table: str, marks: str, name_glob: str | None = None):
    """The same into a catalog table, to which new columns are added before the stream starts. Returns the running query."""
    schema = grown_schema(spark, source_dir, f"{marks}/schema", name_glob)
    stream = growing_stream(spark, source_dir, schema, name_glob)
    if spark.catalog.tableExists(table):
        present = {c.name for c in spark.catalog.listColumns(table)}
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields if f.name not in present]
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    return append_to_table(stream, table, f"{marks}/files")
