"""Folders that driver and executors share, through Hadoop's file systems."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only on a local master without it, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="lodestack-")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Something is there; the last parts of path may be a pattern."""
    p, store = _path(spark, path)
    found = store.globStatus(p)
    return found is not None and len(found) > 0


def renamed(spark: SparkSession, old: str, new: str) -> bool:
    p, store = _path(spark, old)
    return bool(store.rename(p, spark._jvm.org.apache.hadoop.fs.Path(new)))


def deleted(spark: SparkSession, path: str) -> bool:
    p, store = _path(spark, path)
    return bool(store.delete(p, True))


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there, so that it is computed once and lost executors cost no more."""
    sc = df.sparkSession.sparkContext._jsc.sc()
    if sc.getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def created(spark: SparkSession, path: str, text: str) -> None:
    """A new file with the text; it must not be there."""
    p, store = _path(spark, path)
    out = store.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def listed_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it isn't there."""
    p, store = _path(spark, path)
    return [f.getPath().getName() for f in store.listStatus(p)] if store.exists(p) else []
