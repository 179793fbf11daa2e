"""The whole classification job: split, baseline, search, final model, gate and inference check.

Everything from the event table to the champion stays on DataFrames; the driver sees metric rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortflow.config import JobConfig
from cohortflow.learning import runs
from cohortflow.learning.encode import select_features
from cohortflow.learning.model_registry import ModelRegistry, champion_gate, inference_check
from cohortflow.learning.search import TRIALS, SearchSpace, param_search, params_of
from cohortflow.learning.split import hash_split, stratified_split
from cohortflow.learning.train import BoosterParams, FeatureColumns, evaluate_splits, params_as_text, train_gbt
from cohortflow.plans.lineage import materialise_evenly
from cohortflow.sources.tables import dataset_fingerprint

# What a model must not see, because it is an id, decided after the event or derived from the label.
NOT_FEATURES = ("event_id", "patient_id", "onset_date", "outcome", "severity", "risk_score", "_ingestion_timestamp")
TARGET = "serious"


@dataclass(frozen=True)
class ModelJob:
    """``work_dir`` is a shared folder for the registry and the run table."""

    name: str
    work_dir: str
    source: str
    id_column: str = "event_id"
    target: str = TARGET
    drop: Sequence[str] = NOT_FEATURES
    baseline: BoosterParams = BoosterParams()
    space: SearchSpace = SearchSpace()
    trials: int = TRIALS
    parallelism: int = 1
    seed: int = 42
    exact_split: bool = True

    @classmethod
    def of(cls, config: JobConfig, name: str, source: str, **more) -> ModelJob:
        """A job with the session's parameters: its seed, its working folder and a table of its database."""
        return cls(name, f"{config.work_dir}/models", config.table(source), seed=config.seed, **more)

    @property
    def runs_path(self) -> str:
        return f"{self.work_dir}/runs"

    def prepare(self, events: DataFrame) -> tuple[DataFrame, FeatureColumns]:
        """Rows with id, label, split and features, materialised once in even partitions."""
        ids = events.withColumn("row_id", F.col(self.id_column))
        rows = select_features(ids, self.target, self.drop)
        if self.exact_split:
            rows = stratified_split(rows, "row_id", "label", seed=self.seed)
        else:
            rows = hash_split(rows, "row_id", seed=self.seed)
        return materialise_evenly(rows, "row_id"), FeatureColumns.of(rows, ["row_id", "label", "split"])

    def run(self, events: DataFrame) -> DataFrame:
        """Train, search, promote; returns the gate's decision. The steps are in the run table."""
        spark = events.sparkSession
        rows, features = self.prepare(events)
        data = dataset_fingerprint(rows, self.source, self.target).first().asDict()
        tags = {"dataset": self.source, "content_hash": data["content_hash"], "n_rows": str(data["n_rows"])}

        def log(stage: str, params: BoosterParams, metrics: dict, parent: str | None = None) -> str:
            return runs.log_run(spark, self.runs_path, self.name, stage, params_as_text(params), metrics, tags, parent)

        baseline = train_gbt(rows, "label", features, self.baseline, early_stop=False)
        log("baseline", self.baseline, evaluate_splits(baseline, rows, "label"))

        found = param_search(rows, "label", features, self.trials, self.space, self.seed, self.parallelism).collect()
        parent = runs.log_run(spark, self.runs_path, self.name, "search", {"trials": str(self.trials)}, tags=tags)
        for row in found:
            log("trial", params_of(row), row["metrics"], parent)

        def rank(row) -> tuple:  # a trial without an AUC comes last
            auc = row["metrics"].get("validation_roc_auc")
            return (auc is not None and auc == auc, auc or 0.0, -row["trial"])

        best = params_of(max(found, key=rank))

        final = train_gbt(rows, "label", features, best)
        log("final", best, evaluate_splits(final, rows, "label"))
        registry = ModelRegistry(spark, f"{self.work_dir}/models")
        inputs = rows.select(*features.names).schema.json()
        return champion_gate(registry, self.name, final, rows.filter("split = 'test'"), "label", inputs)

    def check(self, events: DataFrame, shown: Sequence[str], n: int = 10) -> DataFrame:
        """Score the first events with the current champion, next to what happened."""
        registry = ModelRegistry(events.sparkSession, f"{self.work_dir}/models")
        return inference_check(registry, self.name, events, self.target, self.id_column, list(shown), n)

