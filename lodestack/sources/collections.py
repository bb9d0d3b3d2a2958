"""Collections of vector rows as versions in a folder: create, reset, back up, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .storage import deleted, exists, renamed


def create(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The collection, which is made, empty, if it isn't there."""
    path = f"{root}/{name}"
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def reset(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The collection, empty, whatever it held."""
    deleted(spark, f"{root}/{name}")
    return create(spark, root, name, schema)


def backed_up(spark: SparkSession, root: str, name: str, stamp: str) -> str | None:
    """Renames a collection to <name>_backup_<stamp>, at once; where it is now, or None without one to rename."""
    if not exists(spark, f"{root}/{name}"):
        return None
    new = f"{root}/{name}_backup_{stamp}"
    if exists(spark, new) or not renamed(spark, f"{root}/{name}", new):
        raise ValueError(f"can't rename to {new}")
    return new
