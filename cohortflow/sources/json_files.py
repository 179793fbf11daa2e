"""JSON files in batch: schema inference, writing, round trips."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T


def infer_schema(
    spark: SparkSession,
    path: str,
    name_glob: str | None = None,
    multi_line: bool = True,
    sampling_ratio: float = 1.0,
    modified_after: datetime | None = None,
) -> T.StructType:
    """Typed schema of JSON files, to be stored (``schema.json()``) and given to every later stream.

    ``sampling_ratio`` below 1 infers from a share of the records; reading itself stays complete. ``modified_after`` looks at
    newer files only.
    """
    reader = spark.read.option("multiLine", multi_line).option("samplingRatio", sampling_ratio)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    return reader.json(path).schema


def schema_as_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """column, type — a schema as a table."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "column string, type string")


#: Rows of one written file: a compressed file is read by one task as a whole.
FILE_ROWS = 250_000


def write_json(df: DataFrame, path: str) -> str:
    """Replace ``path`` by JSON lines under gzip (``*.json.gz``), at least one file per task of ``df``. Returns the path.

    Every line repeats the field names, so the files shrink to about a tenth. They do not split on the way back; FILE_ROWS bounds each.
    """
    df.write.mode("overwrite").option("ignoreNullFields", "false").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
