"""Running a stream over what is there and reading the result as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..sources.storage import shared_folder


def drained(stream: DataFrame, path: str | None = None) -> DataFrame:
    """The stream's rows, all that are available now, as a table in a new folder of the shared one, or in `path`, where
    another run goes on after the last."""
    spark = stream.sparkSession
    path = path or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    run = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
