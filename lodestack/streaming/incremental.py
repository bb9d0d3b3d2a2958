"""Incremental loads: checkpoints from what is stored, late rows by an overlap, and streams into tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import date_iso
from ..functions.text import bound
from ..operators.corpus import without_known
from ..operators.retrieval import upserted


def checkpoint(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the greatest value over all date columns; null if nothing is stored. Values compare as ISO strings."""
    of_row = F.greatest(*(F.col(c) for c in columns)) if len(columns) > 1 else F.col(columns[0])
    return stored.agg(F.max(of_row).alias("checkpoint"))


def since(rows: DataFrame, cutoff: Column, columns: Sequence[str]) -> DataFrame:
    """Rows not older than the cutoff by the first of the columns that has a date; rows without any date stay."""
    day = F.coalesce(*(bound(date_iso(F.col(c)), lambda d: F.when(d != "", d)) for c in columns))
    return rows.where(bound(day, lambda d: d.isNull() | (d >= cutoff)))


def distinct_events(events: DataFrame, keys: Sequence[str], time: str, late: str = "1 day") -> DataFrame:
    """A stream without repeats of a key within the watermark; state is dropped as the watermark passes."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(events: DataFrame, time: str, by: str, value: str, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Count and sum for each window and group of a stream or a table."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.window(time, size).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def new_rows(batch: DataFrame, stored: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of a batch that aren't stored, by any of the keys. Of the batch's own rows of one first key the least stays,
    by its JSON, whatever the order they come in; rows with a blank one are no repeats."""
    own = keys[0][0]
    blank = F.coalesce(F.trim(F.col(own).cast("string")), F.lit("")) == ""
    least = batch.where(~blank).groupBy(F.col(own).alias("key")).agg(F.min_by(F.struct("*"), F.to_json(F.struct("*"))).alias("row")).select("row.*")
    return without_known(least.unionByName(batch.where(blank)), stored, keys)


def backfilled(rows: DataFrame, stored: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """All rows of a full scan that aren't stored, without any checkpoint."""
    return new_rows(rows, stored, keys)


def repaired(docs: DataFrame, key: str, tables: dict[str, tuple[DataFrame, Callable[[DataFrame], DataFrame]]]) -> dict[str, DataFrame]:
    """For each table (what it holds, and how to derive it from documents) the rows of the documents that it lacks."""
    return {name: derive(docs.join(held.select(key).distinct(), key, "left_anti")) for name, (held, derive) in tables.items()}


def counted(rows: DataFrame, name: str, **tests: Column) -> tuple[DataFrame, Observation]:
    """rows, and an observation that counts them (as n) and those of each test while they pass on to whatever reads
    them, without a job of its own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("n"), *(F.count_if(F.coalesce(t, F.lit(False))).alias(k) for k, t in tests.items())), seen


def run_counts(found: DataFrame, stored: DataFrame, key: str, passes: Column, fails: Column) -> DataFrame:
    """One row: discovered, duplicates (stored before, or again), filtered (don't pass), failed, saved."""
    d = found.groupBy(key).agg(F.count("*").alias("times"), F.bool_and(passes).alias("ok"), F.bool_or(fails).alias("bad"))
    d = d.join(stored.select(key).distinct().withColumn("known", F.lit(True)), key, "left").withColumn("known", F.col("known").isNotNull())
    fresh = ~F.col("known")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return d.agg(
        total("times").alias("discovered"),
        total(F.col("times") - F.when(fresh, 1).otherwise(0)).alias("duplicates"),
        F.count_if(fresh & ~F.col("ok") & ~F.col("bad")).alias("filtered"),
        F.count_if(fresh & F.col("bad")).alias("failed"),
        F.count_if(fresh & F.col("ok") & ~F.col("bad")).alias("saved"),
    )


def newest_first(rows: DataFrame, day: str, key: str) -> DataFrame:
    """By date, latest first and those without one last, then by key."""
    return rows.orderBy(F.nullif(date_iso(F.col(day)), F.lit("")).desc_nulls_last(), key)


def upsert_batches(read: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], key: str, version: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges each batch into the table that read() gives and writes it as version `epoch`; writing
    an epoch again replaces it, so a retried batch counts once."""

    def each(batch: DataFrame, epoch: int) -> None:
        stored = read()
        write(upserted(stored if stored is not None else batch.limit(0), batch, key, version), epoch)

    return each
