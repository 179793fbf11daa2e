"""Model versions and aliases in an append-only table next to the saved pipelines."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortflow.learning import metrics
from cohortflow.learning.train import with_probability
from cohortflow.operators.latest import latest_per_group
from cohortflow.operators.quality import assert_probability
from cohortflow.plans.lineage import cut_lineage

CHAMPION, CHALLENGER = "Champion", "Challenger"
SCHEMA = "name string, version int, event string, alias string, at timestamp, sequence long"


@dataclass(frozen=True)
class ModelRegistry:
    """``root`` is a shared folder. Rows are only appended; one writer at a time decides versions."""

    spark: SparkSession
    root: str

    @property
    def log_path(self) -> str:
        return f"{self.root}/registry"

    def _append(self, name: str, version: int, event: str, alias: str | None) -> None:
        sequence = self.events().filter(F.col("name") == name).count()  # orders moves of the same instant
        row = (name, version, event, alias, datetime.now(timezone.utc), sequence)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.log_path)

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.log_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def register(self, name: str, model: PipelineModel, input_schema: str | None = None) -> int:
        """Save the whole pipeline as the next version."""
        last = self.events().filter(F.col("name") == name).agg(F.max("version")).first()[0] or 0
        version = last + 1
        model.save(self.model_path(name, version))
        if input_schema:
            frame = self.spark.createDataFrame([(input_schema,)], "schema string")
            frame.coalesce(1).write.mode("overwrite").parquet(f"{self.model_path(name, version)}-input")
        self._append(name, version, "registered", None)
        return version

    def model_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version}"

    def load(self, name: str, version: int) -> PipelineModel:
        return PipelineModel.load(self.model_path(name, version))

    def input_schema(self, name: str, version: int) -> str | None:
        return self.spark.read.parquet(f"{self.model_path(name, version)}-input").first()["schema"]

    def set_alias(self, name: str, alias: str, version: int | None) -> None:
        """Point the alias at a version; ``None`` takes the alias away."""
        self._append(name, version or 0, "alias", alias)

    def aliases(self, name: str) -> DataFrame:
        """alias, version — the latest pointer of each alias."""
        moves = self.events().filter((F.col("name") == name) & (F.col("event") == "alias"))
        return latest_per_group(moves, ["alias"], ["sequence"]).filter("version > 0").select("alias", "version")

    def version_of(self, name: str, alias: str) -> int | None:
        row = self.aliases(name).filter(F.col("alias") == alias).first()
        return row["version"] if row else None


def champion_gate(
    registry: ModelRegistry, name: str, model: PipelineModel, test_rows: DataFrame, label: str, input_schema: str | None = None
) -> DataFrame:
    """Register ``model`` and promote it if it is at least as good as the champion on the same rows.

    The first version promotes without a comparison. A loser becomes the challenger; a promotion removes
    the challenger alias. Returns version, test_auc, champion_version, champion_auc, decision.
    """
    champion = registry.version_of(name, CHAMPION)

    def auc(candidate: PipelineModel) -> float | None:
        return metrics.roc_auc(with_probability(candidate, test_rows), label, "probability").first()["roc_auc"]

    new_auc = auc(model)
    old_auc = auc(registry.load(name, champion)) if champion else None
    version = registry.register(name, model, input_schema)
    promote = champion is None or (new_auc is not None and (old_auc is None or new_auc >= old_auc))
    if promote:
        registry.set_alias(name, CHAMPION, version)
        if registry.version_of(name, CHALLENGER) is not None:
            registry.set_alias(name, CHALLENGER, None)
    else:
        registry.set_alias(name, CHALLENGER, version)
    row = (version, new_auc, champion, old_auc, CHAMPION if promote else CHALLENGER)
    return registry.spark.createDataFrame(
        [row], "version int, test_auc double, champion_version int, champion_auc double, decision string"
    )


def schema_check(expected_json: str, rows: DataFrame) -> DataFrame:
    """column, expected, actual for every column of a saved input schema that is absent or of another type."""
    wanted = {f.name: f.dataType.simpleString() for f in StructType.fromJson(json.loads(expected_json)).fields}
    present = dict(rows.dtypes)
    wrong = [(c, kind, present.get(c)) for c, kind in wanted.items() if present.get(c) != kind]
    return rows.sparkSession.createDataFrame(wrong, "column string, expected string, actual string")


def batch_score(model: PipelineModel, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Raw rows plus ``predicted_probability`` and ``predicted_class``; runs on the executors."""
    scored = with_probability(model, rows, "predicted_probability")
    return scored.withColumn("predicted_class", (F.col("predicted_probability") >= threshold).cast("int"))


def inference_check(
    registry: ModelRegistry, name: str, rows: DataFrame, label: str, order: str, shown: list[str], n: int = 10
) -> DataFrame:
    """Score all raw rows with the champion and show the first ``n`` next to the actual label.

    Fails if any row's score is not a probability.
    """
    version = registry.version_of(name, CHAMPION)
    if version is None:
        raise LookupError(f"{name} has no {CHAMPION} yet")
    scored = cut_lineage(assert_probability(batch_score(registry.load(name, version), rows), "predicted_probability"))
    return scored.orderBy(order).limit(n).select(
        *shown, "predicted_probability", "predicted_class", F.col(label).cast("int").alias("actual")
    )
