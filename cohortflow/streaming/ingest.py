"""Append-only ingest: every new JSON file is read exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

INGESTED_AT = "_ingestion_timestamp"
#: The raw text of a record that does not parse or does not fit the schema; null for all others.
BAD_RECORD = "_corrupt_record"


def json_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    name_glob: str | None = None,
    multi_line: bool = True,
    max_files: int | None = None,
    keep_bad: bool = False,
) -> DataFrame:
    """Unstarted stream over a folder, with the ingest time as an audit column.

    With ``keep_bad`` a record that is broken or of other types keeps its text in a column of its own.

    A ``multi_line`` file (one JSON array) is read by one task as a whole; JSON lines
    (``multi_line=False``) split. ``max_files`` bounds a micro-batch.
    """
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    reader = spark.readStream.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", BAD_RECORD)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(source_dir).withColumn(INGESTED_AT, F.current_timestamp())


def _append(stream: DataFrame, checkpoint_dir: str):
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )


def append_to_table(stream: DataFrame, table: str, checkpoint_dir: str) -> StreamingQuery:
    """Ingest what is there into a catalog table; the checkpoint remembers the files."""
    return _append(stream, checkpoint_dir).format("parquet").toTable(table)


def append_to_path(stream: DataFrame, path: str, checkpoint_dir: str) -> StreamingQuery:
    """The same into a Parquet folder."""
    return _append(stream, checkpoint_dir).format("parquet").start(path)


def ingest_json_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target_dir: str,
    checkpoint_dir: str,
    name_glob: str | None = None,
    multi_line: bool = True,
    max_files: int | None = None,
    keep_bad: bool = False,
) -> DataFrame:
    """Bring ``target_dir`` up to date with the source folder and return it. A rerun adds nothing."""
    stream = json_stream(spark, source_dir, schema, name_glob, multi_line, max_files, keep_bad)
    append_to_path(stream, target_dir, checkpoint_dir).awaitTermination()
    return spark.read.parquet(target_dir)
