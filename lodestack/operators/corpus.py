"""Joins, deduplication and counts that build a corpus out of records and chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip, text_of

def unused(df: DataFrame, name: str) -> str:
    """A name for a column of the operator's own that df has none of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by `order`; rows with a blank key are left out.

    A maximum over structs, combined before the shuffle, so that a key with very many rows is no task's burden.
    """
    rest = [c for c in rows.columns if c not in keys]
    ordered = [*order, *(c for c in rest if c not in order)]
    test = None
    for k in keys:
        own = strip(text_of(F.col(k))) != ""
        test = own if test is None else test & own
    best = rows.where(test).groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("m"))
    return best.select(*(F.col(c) if c in keys else F.col(f"m.{c}").alias(c) for c in rows.columns))


def first_keys(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """Rows of the first `most` different keys by the least `order` of each; blank keys are left out. The keys are combined
    before the shuffle, and each task keeps its first ones, so that only bounded lists of keys meet."""
    known = rows.where(strip(text_of(F.col(key))) != "")
    name = unused(rows, "first")
    keys = known.groupBy(F.col(key).alias(name)).agg(F.min(order).alias(f"{name}_at")).orderBy(f"{name}_at", name).limit(most)
    return known.join(keys, F.col(key) == F.col(name), "left_semi")


def without_known(rows: DataFrame, known: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows none of whose keys is known: one anti-join for each pair (column of rows, column of known); blanks never
    match. An OR of keys in one join would compare all pairs."""
    for own, other in keys:
        name = unused(rows, "known")
        index = known.select(F.col(other).alias(name)).where(strip(text_of(F.col(name))) != "").distinct()
        rows = rows.join(index, rows[own] == F.col(name), "left_anti")
    return rows


def with_document(chunks: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Chunks with the columns of their document, which come from docs where both have them; others are dropped."""
    return chunks.select(key, *(c for c in chunks.columns if c not in docs.columns)).join(docs, key)


def without_chunks(docs: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    return docs.join(chunks.select(key).distinct(), key, "left_anti")


def zero_filled_counts(targets: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """key and n of its rows for each target, 0 where there are none."""
    counts = rows.join(targets.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.count("*").alias("n"))
    return targets.select(key).distinct().join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def missing_outputs(docs: DataFrame, key: str, **outputs: DataFrame) -> DataFrame:
    """Documents that lack an output, with needs_<output> for each: what a repair has to derive again."""
    d = docs.select(key).distinct()
    for name, rows in outputs.items():
        d = d.join(rows.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left").withColumn(f"needs_{name}", F.col(f"_{name}").isNull()).drop(f"_{name}")
    return d.where(F.exists(F.array(*(f"needs_{n}" for n in outputs)), lambda x: x))


def status_counts(rows: DataFrame, status: str, allowed: Column) -> DataFrame:
    """Rows, kept and skipped by status; blank ones as <missing>."""
    s = strip(text_of(F.col(status)))
    return (
        rows.select(F.when(s == "", "<missing>").otherwise(s).alias("status"), allowed.alias("ok"))
        .groupBy("status")
        .agg(F.count("*").alias("n"), F.count_if("ok").alias("kept"), F.count_if(~F.col("ok")).alias("skipped"))
    )


def label_counts(rows: DataFrame, labels: str) -> DataFrame:
    return rows.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def distinct_documents(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(strip(text_of(F.col(key))) != "").agg(F.count_distinct(key).alias("documents"))


#: Ranges that order_statistics deals distinct values to.
RANGES = 64


def order_statistics(rows: DataFrame, value: str, shares: dict[str, float], low: int, high: int) -> DataFrame:
    """One row: n, min, max, rows under `low` and over `high`, and for each share the element at floor(n * share),
    counted from 0 and at most the last. Nulls don't count; without values n is 0 and the elements are null.

    Values, which are numbers, are counted first. Approximate quantiles of the distinct ones split them into ranges; a rank
    is the sum over the ranges before plus a running sum within its own, so that no task sees all distinct values, and
    the result is exact however the ranges fall. Only sums of the ranges meet in one place.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    splits = counts.agg(F.percentile_approx("v", [k / RANGES for k in range(1, RANGES)], 1000).alias("splits"))
    dealt = counts.crossJoin(F.broadcast(splits)).select("v", "c", F.size(F.filter("splits", lambda x: x < F.col("v"))).alias("range"))  # one row
    sums = dealt.groupBy("range").agg(F.sum("c").alias("c"))
    whole = sums.agg(F.collect_list(F.struct("range", "c")).alias("sums"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"))  # RANGES structs
    before = F.aggregate(F.filter("sums", lambda x: x["range"] < F.col("range")), F.lit(0).cast("long"), lambda t, x: t + x["c"])
    within = F.sum("c").over(W.partitionBy("range").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    ranked = dealt.withColumn("within", within).crossJoin(F.broadcast(whole)).withColumn("upto", F.col("within") + before)  # one row
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * q), F.col("n") - 1), F.col("v")))
    return ranked.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.min("v").alias("min"),
        *(at(q).alias(k) for k, q in shares.items()),
        F.max("v").alias("max"),
        F.coalesce(F.sum(F.when(F.col("v") < low, F.col("c")).otherwise(0)), F.lit(0)).alias("under"),
        F.coalesce(F.sum(F.when(F.col("v") > high, F.col("c")).otherwise(0)), F.lit(0)).alias("over"),
    )


def counted(rows: DataFrame, groups: Sequence[str], key: str, precision: int = 14) -> DataFrame:
    """Counts of a batch that can be merged with those of others: groups, rows, and a sketch of the distinct keys, blank
    ones left out. A sketch has at most 2**precision registers, whatever it counts; its estimate is off by about
    1.04 / 2**(precision / 2) of the true number (0.8 % for 14), and exact for few keys."""
    text = strip(text_of(F.col(key)))
    return rows.groupBy(*groups).agg(F.count("*").alias("rows"), F.hll_sketch_agg(F.when(text != "", text), precision).alias("sketch"))


def merged(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """counted() of several batches as one: groups, rows (a key that comes in two batches has rows in both) and documents,
    the estimate of distinct keys over all of them. The rows of no batch are read again."""
    return counts.groupBy(*groups).agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("documents"))


def count_gate(n: Column, expected: int, pilot_below: int = 100_000, share: float = 0.95) -> Column:
    """pilot, incomplete or complete."""
    return F.when(n < pilot_below, "pilot").when(n < share * expected, "incomplete").otherwise("complete")
