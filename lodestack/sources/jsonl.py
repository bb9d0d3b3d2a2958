"""JSON-lines tables: scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import exists


def unused(names: list[str], name: str) -> str:
    """A name that isn't among names."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1, blank ones counted), value of text files. A file is read in blocks; the lines before a block
    are summed over the counts of blocks, so that no task needs a whole file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("c"), F.min("n").alias("first"))
    before = F.coalesce(F.sum("c").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("file", "block", "first", before.alias("before"))
    return lines.join(starts, ["file", "block"]).select("file", (F.col("n") - F.col("first") + F.col("before") + 1).alias("line"), "value")


def scan(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True, limit: int | None = None, where: bool = True) -> DataFrame:
    """Rows of JSON lines, gzip by suffix. Blank lines are no rows and a leading byte-order mark is no part of a line; a
    path without files has no rows.

    strict: a line that is no JSON object fails the job with its file and line; else it is no row. Lines are numbered by
    counting those of each block first; `where=False` saves that and names no place. limit: the first so many rows by
    file and line.
    """
    known = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not exists(spark, path):
        return spark.createDataFrame([], known)
    placed = strict and where or limit is not None
    lines = numbered(spark, path) if placed else spark.read.text(path).select(F.lit("").alias("file"), F.lit(0).cast("long").alias("line"), "value")
    lines = lines.select("file", "line", F.regexp_replace("value", "^\ufeff", "").alias("v")).where(F.trim("v") != "")
    if limit is not None:
        lines = lines.orderBy("file", "line").limit(limit)
    bad = unused(known.fieldNames(), "bad")
    wide = T.StructType([*known.fields, T.StructField(bad, T.StringType())])
    rows = lines.select("file", "line", "v", F.from_json("v", wide, {"columnNameOfCorruptRecord": bad}).alias("r"))
    broken = F.col("r").isNull() | F.col("r")[bad].isNotNull()
    if strict:
        place = F.concat(F.col("file"), F.lit(":"), F.col("line").cast("string"), F.lit(": ")) if placed else F.lit("")
        rows = rows.withColumn("r", F.when(broken, F.raise_error(F.concat(place, F.lit("not a JSON line: "), F.substring("v", 1, 200)))).otherwise(F.col("r")))
    else:
        rows = rows.where(~broken)
    return rows.select(*(F.col("r")[c].alias(c) for c in known.fieldNames()))


def snapshots(rows: DataFrame, root: str, kind: str, day: Column) -> None:
    """Raw answers and pages added as they came, below root/kind=/day=; a replay reads them back by kind and day."""
    rows.select("*", F.lit(kind).alias("kind"), day.alias("day")).write.mode("append").partitionBy("kind", "day").parquet(root)


def append(df: DataFrame, path: str, compression: str = "none") -> None:
    """Lines added to a table; the committer makes a retried task write once."""
    df.write.mode("append").option("compression", compression).option("ignoreNullFields", "false").json(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish(spark: SparkSession, root: str, batch: str, **tables: DataFrame) -> None:
    """Writes a batch of several tables below root, each to <table>/batch=<batch>, and then its marker; readers see
    batches with a marker only, so that all tables of a batch appear at once. Writing a batch again replaces it."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
    spark.createDataFrame([(batch,)], "done string").coalesce(1).write.mode("overwrite").parquet(f"{root}/_published/batch={batch}")


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of a table in published batches, with their batch."""
    done = spark.read.parquet(f"{root}/_published").select(F.col("batch").cast("string").alias("batch")).distinct()
    return spark.read.parquet(f"{root}/{name}").withColumn("batch", F.col("batch").cast("string")).join(done, "batch", "left_semi")


def report(df: DataFrame) -> DataFrame:
    """A one-row DataFrame as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("report"))
