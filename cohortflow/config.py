"""Job parameters, read once from the session configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class JobConfig:
    """Where the job reads and writes. Every field can be set as ``cohortflow.<field>`` on the session."""

    database: str = "default"
    source_dir: str = ""
    work_dir: str = ""
    seed: int = 42

    @classmethod
    def from_session(cls, spark: SparkSession) -> "JobConfig":
        base = cls()
        values = {
            name: type(default)(spark.conf.get(f"cohortflow.{name}", str(default)))
            for name, default in vars(base).items()
        }
        return cls(**values)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def session_user(spark: SparkSession) -> str:
    return spark.sql("SELECT current_user() AS user").first()["user"]
