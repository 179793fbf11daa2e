"""Ordinal encoding with a fitted dictionary that stays a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from cohortflow.operators.profile import long_format
from cohortflow.plans.lineage import broadcast_if_small, cut_lineage
from cohortflow.plans.ordered import running_totals

UNSEEN, MISSING = -1, -2


def fit_ordinal(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes 1..k in alphabetical order, fitted on the given rows only.

    The distinct values are numbered by a distributed sort, so a column may have any number of them.
    """
    values = long_format(train, columns, as_type="string").filter(F.col("value").isNotNull()).distinct()
    numbered = running_totals(values.withColumn("one", F.lit(1).cast("bigint")), order=["value"], sums=["one"], by=["column"])
    return cut_lineage(numbered.select("column", "value", F.col("one_upto").alias("code")))


def ordinal_encode(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its code; a value unseen in training becomes -1, a null -2."""
    for column in columns:
        mapping = codes.filter(F.col("column") == column).select(F.col("value").alias(column), F.col("code").alias("_code"))
        df = (
            df.withColumn(column, F.col(column).cast("string"))
            .join(broadcast_if_small(mapping), column, "left")
            .withColumn(column, F.when(F.col(column).isNull(), MISSING).otherwise(F.coalesce("_code", F.lit(UNSEEN))))
            .drop("_code")
        )
    return df


def bool_to_int(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1."""
    booleans = [name for name, kind in df.dtypes if kind == "boolean"]
    return df.withColumns({name: F.col(name).cast("int") for name in booleans})


def select_features(df: DataFrame, target: str, drop: Sequence[str]) -> DataFrame:
    """``df`` without ids, metadata and leaking columns, and the target as 0/1 ``label``."""
    return df.drop(*drop).withColumn("label", F.col(target).cast("int")).drop(target)


class OrdinalCodes(Transformer, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """``ordinal_encode`` as a pipeline stage: text columns in, codes as numbers out, -1 for unseen values and -2 for missing ones.

    ``codes`` is the dictionary of ``fit_ordinal``. It is saved next to the stage as a table and stays one when it is loaded, so a column may
    have any number of values.
    """

    @keyword_only
    def __init__(self, inputCols: Sequence[str] = (), outputCols: Sequence[str] = (), codes: DataFrame | None = None):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols))
        self.codes = codes
        self._sides: dict[str, DataFrame] = {}

    def _side(self, column: str) -> DataFrame:
        if column not in self._sides:
            values = self.codes.filter(F.col("column") == column).select(F.col("value").alias(f"{column}__value"), F.col("code").alias(f"{column}__found"))
            self._sides[column] = broadcast_if_small(values)
        return self._sides[column]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, out in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            side, text = self._side(column), F.col(column).cast("string")
            code = F.when(F.col(column).isNull(), MISSING).otherwise(F.coalesce(f"{column}__found", F.lit(UNSEEN)))
            joined = dataset.join(side, text == F.col(f"{column}__value"), "left")
            dataset = joined.withColumn(out, code.cast("double")).drop(f"{column}__value", f"{column}__found")
        return dataset

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader()


class _CodesWriter(MLWriter):
    def __init__(self, stage: OrdinalCodes):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.codes.write.parquet(f"{path}/codes")


class _CodesReader(MLReader):
    def load(self, path: str) -> OrdinalCodes:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = OrdinalCodes(codes=self.sparkSession.read.parquet(f"{path}/codes"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
