"""A keyed collection in hash buckets, of which an upsert writes those only that its keys fall into."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.corpus import last_wins, unused
from ..operators.retrieval import upserted
from .storage import created, deleted, exists, listed_names, renamed, written

#: Where nothing else is said: buckets of some 100 MB each at 100 GB.
BUCKETS = 1024


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The latest state: its version, key, number of buckets, schema, and for each bucket the folder that holds it."""
    names = sorted(n for n in listed_names(spark, f"{root}/_states") if n.endswith(".json"))
    if not names:
        return None
    return json.loads(spark.read.text(f"{root}/_states/{names[-1]}", wholetext=True).first()[0])


def _read(spark: SparkSession, root: str, state: dict, buckets: list[int]) -> DataFrame:
    paths = [f"{root}/{state['folders'][str(b)]}/bucket={b}" for b in buckets if str(b) in state["folders"]]
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def collection(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the latest state, which later upserts don't change."""
    state = manifest(spark, root)
    if state is None:
        raise ValueError(f"no collection at {root}")
    return _read(spark, root, state, [int(b) for b in state["folders"]])


def upsert(spark: SparkSession, root: str, batch: DataFrame, key: str, version: str, buckets: int = BUCKETS) -> list[int]:
    """Merges a batch into the collection at root, made if it isn't there: of each key the row of the greatest version,
    rows with a blank key left out. Returns the buckets that were written.

    Rows of the touched buckets are read, merged and written to a new folder, a bucket by a task (keys are single there,
    so a hot key of the batch is one row); then a state that names it for those buckets is renamed into place, so readers
    see all of a batch or nothing. Another upsert that got there first makes this one fail. `buckets` holds for a new
    collection. Only numbers of buckets come to the driver.
    """
    state = manifest(spark, root)
    count, no = (state["buckets"], state["version"] + 1) if state else (buckets, 1)
    if unused(batch, "bucket") != "bucket":
        raise ValueError("bucket is a name of the collection's own")
    if state and (state["key"] != key or T.StructType.fromJson(state["schema"]).fieldNames() != batch.columns):
        raise ValueError("the collection has another key or other columns")
    state = state or {"key": key, "buckets": count, "schema": batch.schema.jsonValue(), "folders": {}}
    fresh = written(last_wins(batch, [key], [version]).select(*batch.columns))
    touched = sorted(r[0] for r in fresh.select(_bucket(key, count)).distinct().collect())
    if not touched and no > 1:
        return []
    folder, b = f"v{no:08d}-{uuid.uuid4().hex}", "bucket"
    merged = upserted(_read(spark, root, state, touched), fresh, key, version).select(*batch.columns, _bucket(key, count).alias(b))
    if touched:
        merged.repartition(len(touched), b).write.partitionBy(b).parquet(f"{root}/{folder}")
    state |= {"version": no, "folders": state["folders"] | {str(t): folder for t in touched}}
    made, own = f"{root}/_states/{no:08d}.json", f"{root}/_states/.{uuid.uuid4().hex}"
    created(spark, own, json.dumps(state))
    if exists(spark, made) or not renamed(spark, own, made):
        deleted(spark, own)
        deleted(spark, f"{root}/{folder}")
        raise RuntimeError(f"another upsert has made state {no}; read it and merge again")
    return touched


def swept(spark: SparkSession, root: str) -> int:
    """Deletes earlier states, and folders that the latest doesn't name; says how many folders. Readers of an earlier
    state must be done."""
    state = manifest(spark, root)
    if state is None:
        return 0
    for name in listed_names(spark, f"{root}/_states"):
        if name != f"{state['version']:08d}.json":
            deleted(spark, f"{root}/_states/{name}")
    old = [n for n in listed_names(spark, root) if n.startswith("v") and n not in set(state["folders"].values())]
    for n in old:
        deleted(spark, f"{root}/{n}")
    return len(old)
