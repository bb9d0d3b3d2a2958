"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters in either case, for lower-casing that leaves all other letters alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is configured, as in tests."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = sc._jsc.sc().getCheckpointDir()
    if found.isEmpty():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestack-"))
        found = sc._jsc.sc().getCheckpointDir()
    return found.get()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unused(df: DataFrame, name: str) -> str:
    """A name for a column of the operator's own that df has none of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once even if body uses it inside further lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    is_ascii = F.length(text) == F.octet_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def within(texts: DataFrame, most: int, size: Column | None = None) -> DataFrame:
    """The rows of `texts` (id, t, and more; a bounded sample, written), by the hash of their id, as far as their texts
    have at most `most` characters, or the size given, together, and one row at least. Only ids and sizes come to the driver."""
    size = F.length("t") if size is None else size
    sizes = sorted((r["h"], r["id"], r["n"] or 0) for r in texts.select("id", F.xxhash64("id").alias("h"), size.alias("n")).collect())
    total, last = 0, None
    for h, i, n in sizes:
        total += n
        if last is not None and total > most:
            return texts.where((F.xxhash64("id") < last[0]) | ((F.xxhash64("id") == last[0]) & (F.col("id") <= last[1])))
        last = h, i
    return texts
