"""Session helpers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def with_package(spark: SparkSession) -> SparkSession:
    """spark, whose Python workers find this package even if it is run from its source folder without installation."""
    env = spark.sparkContext.environment
    if ROOT not in (path := env.get("PYTHONPATH", "")).split(":"):
        env["PYTHONPATH"] = f"{path}:{ROOT}" if path else ROOT
    return spark
