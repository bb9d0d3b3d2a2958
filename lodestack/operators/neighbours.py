"""Exact nearest neighbours of unit vectors with pruning by pivots.

The angle between unit vectors is a metric. Vectors are filed under the nearest of a few pivots with their angle to it. A
query compares its nearest groups first; the k-th angle found there bounds the rest by the triangle inequality: whole
groups whose ring of angles is too far off are dropped, and of the others only the ring that can hold a neighbour is read.

Rows are compared as blocks: matrices of a bounded number of vectors, whose products bound the scores, so that only pairs
that may be among a query's k best so far are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.storage import written

#: Pivots, and the vectors (those of the least hash) that they are chosen among, each the farthest from those before.
PIVOTS, SAMPLE = 64, 2000
#: More than rounding can move an angle, a norm or a score of six places.
SLACK = 5e-6
#: Rows of a block at most, and its numbers.
BLOCK_ROWS, BLOCK_NUMBERS = 2048, 1 << 17
#: Tasks that the rows of one group are dealt to.
DEALT = 16
#: More than two scores may differ that are equal to six places.
ROUNDED = 2e-6


def _blocked(by_group: bool, numbers: int):
    """Batches of (id, x, group and `numbers` columns of doubles) as rows of blocks: group, ids, width, values (rows of
    vectors, filled up with zeros), null (which vectors are), and the doubles as lists."""

    def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        groups = batch.column(2).to_numpy(zero_copy_only=False) if by_group else np.zeros(batch.num_rows, np.int64)
        for group in np.unique(groups):
            part = batch.take(pa.array(np.flatnonzero(groups == group))) if by_group else batch
            lists = part.column(1)
            width = max([n for n in pa.compute.list_value_length(lists).to_pylist() if n is not None] or [0])
            rows = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(width, 1)))
            for a in range(0, part.num_rows, rows):
                yield block(int(group), part.slice(a, rows), width)

    def block(group: int, part: pa.RecordBatch, width: int) -> pa.RecordBatch:
        lists = part.column(1)
        lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = pa.compute.fill_null(lists.flatten().cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        x = np.zeros((part.num_rows, width))
        x[np.arange(width) < lengths[:, None]] = flat
        whole = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
        values = [pa.array([group], pa.int64()), whole(part.column(0)), pa.array([width], pa.int32()), pa.array([x.tobytes()], pa.binary()), whole(lists.is_null())]
        values += [whole(part.column(3 + i)) for i in range(numbers)]
        return pa.RecordBatch.from_arrays(values, ["group", "ids", "width", "data", "none", *(f"d{i}" for i in range(numbers))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            yield from blocks(batch) if batch.num_rows else ()

    return run


def blocked(rows: DataFrame, id_column: str, vector: str, group: str | None = None, numbers: tuple[str, ...] = ()) -> DataFrame:
    """rows as blocks, numbered, of their group, or of all; `numbers` are columns of doubles that stay with the vectors."""
    d = rows.repartition(F.col(group), F.pmod(F.xxhash64(id_column), F.lit(DEALT))) if group else rows
    d = d.select(F.col(id_column).alias("i"), F.col(vector).alias("x"), (F.col(group) if group else F.lit(0)).cast("long").alias("g"), *(F.col(c).cast("double").alias(f"d{k}") for k, c in enumerate(numbers)))
    more = "".join(f", d{k} array<double>" for k in range(len(numbers)))
    return d.mapInArrow(_blocked(group is not None, len(numbers)), f"group long, ids array<{dict(d.dtypes)['i']}>, width int, data binary, none array<boolean>{more}").withColumn("block", F.monotonically_increasing_id())


def _met(k: int, ringed: bool):
    """From pairs of blocks (a: queries, b: vectors) the pairs that may be among the k best of a query by what was seen so
    far in this task: (q, v, raw), raw the products added up in order. Null vectors have null scores, which come last.

    ringed: only vectors whose angle to the pivot (b's d0) is within d1 of the query's (a's d0) are compared; a query with
    d2 is compared with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, np.ndarray] = {}  # of each block of queries the k best so far
        for batch in batches:
            cell = lambda name, i: batch.column(batch.schema.get_field_index(name))[i]  # noqa: E731, B023
            matrix = lambda side, i: np.frombuffer(cell(f"{side}_data", i).as_buffer(), np.float64).reshape(len(cell(f"{side}_ids", i)), -1)  # noqa: E731, B023
            flat = lambda name, i: cell(name, i).values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
            for i in range(batch.num_rows):
                q, v = matrix("a", i), matrix("b", i)
                width = max(q.shape[1], v.shape[1])
                q, v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (q, v))
                with np.errstate(invalid="ignore", over="ignore"):
                    s = q @ v.T
                    size = np.abs(q).sum(axis=1) * (np.abs(v).max() if v.size else 0.0)
                odd = ~np.isfinite(s)  # always scored
                s[odd] = np.inf
                none = flat("a_none", i)[:, None] | flat("b_none", i)[None, :]
                s[none] = -np.finfo(float).max
                if ringed:
                    off = np.abs(flat("a_d0", i)[:, None] - flat("b_d0", i)[None, :])
                    s[(off > flat("a_d1", i)[:, None]) & (flat("a_d2", i)[:, None] == 0)] = -np.inf
                key = cell("a_block", i).as_py()
                best = least.get(key)
                top = s if s.shape[1] <= k else np.partition(s, s.shape[1] - k, axis=1)[:, -k:]
                best = top if best is None else np.concatenate([best, top], axis=1)
                least[key] = best = best if best.shape[1] <= k else np.partition(best, best.shape[1] - k, axis=1)[:, -k:]
                kth = best.min(axis=1) if best.shape[1] >= k else np.full(len(q), -np.inf)
                with np.errstate(invalid="ignore"):
                    bound = kth - ROUNDED - 1e-9 * np.where(np.isfinite(size), size, 0.0)
                bound[~np.isfinite(bound)] = -np.inf
                at, of = np.nonzero((s >= bound[:, None]) & (s > -np.inf))
                for a in range(0, len(at), 1 << 14):
                    x, y = at[a : a + (1 << 14)], of[a : a + (1 << 14)]
                    with np.errstate(invalid="ignore", over="ignore"):
                        raw = np.cumsum(q[x] * v[y], axis=1)[:, -1] + 0.0 if width else np.zeros(len(x))
                    yield pa.RecordBatch.from_arrays([cell("a_ids", i).values.take(pa.array(x)), cell("b_ids", i).values.take(pa.array(y)), pa.array(raw, mask=none[x, y])], ["q", "v", "raw"])

    return run


def met(queries: DataFrame, vectors: DataFrame, k: int, ringed: bool = False) -> DataFrame:
    """(q, v, raw) of pairs of blocks of the same group (all, if not ringed), for each query its k best and others."""
    side = lambda d, name: d.select(*(F.col(c).alias(f"{name}_{c}") for c in d.columns))
    a, b = side(queries, "a"), side(vectors, "b")
    both = b.join(a, F.col("a_group") == F.col("b_group")) if ringed else b.crossJoin(a)
    kinds = {c: dict(d.dtypes)["ids"].removeprefix("array<")[:-1] for c, d in (("q", queries), ("v", vectors))}
    return both.mapInArrow(_met(k, ringed), f"q {kinds['q']}, v {kinds['v']}, raw double")


def pivots_of(vectors: DataFrame, embedding: str, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """At most `pivots` unit vectors of the table's, spread out; from a bounded sample."""
    rows = vectors.select(F.col(embedding).cast("array<double>").alias("x")).where("x IS NOT NULL").orderBy(F.xxhash64("x")).limit(sample).collect()
    width = max((len(r["x"]) for r in rows), default=0)
    if not width:
        return np.zeros((0, 0))
    have = np.array([r["x"] for r in rows if len(r["x"]) == width and None not in r["x"]], float).reshape(-1, width)
    have = have[np.abs(np.linalg.norm(have, axis=1) - 1) < SLACK]
    if not len(have):
        return np.zeros((0, width))
    chosen, near = [0], have @ have[0]
    while len(chosen) < min(pivots, len(have)) and near.min() < 1 - SLACK:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, have @ have[chosen[-1]])
    return have[chosen]


def _angles(part: pa.Array, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each is a unit vector of the pivots' width, and its angles to them."""
    width = pivots.shape[1]
    lists = part.to_pylist()
    fit = np.array([x is not None and len(x) == width and None not in x for x in lists], bool)
    x = np.zeros((len(lists), width))
    if fit.any():
        x[fit] = np.array([v for v, f in zip(lists, fit) if f], float)
    unit = fit & (np.abs(np.linalg.norm(x, axis=1) - 1) < SLACK) & (len(pivots) > 0)
    return unit, np.arccos(np.clip(x @ pivots.T, -1, 1))


def _filed(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, angles = _angles(batch.column(1), pivots)
            group = np.where(unit, angles.argmin(axis=1) if len(pivots) else -1, -1)
            angle = np.where(unit, angles.min(axis=1) if len(pivots) else 0.0, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group.astype(np.int32)), pa.array(angle)], ["v", "x", "group", "angle"])

    return run


def filed(vectors: DataFrame, vec_id: str, embedding: str, pivots: np.ndarray) -> DataFrame:
    """(v, x, group, angle); what is no unit vector of the pivots' width is in group -1, which is never dropped."""
    rows = vectors.select(F.col(vec_id).alias("v"), F.col(embedding).alias("x"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_filed(pivots), f"v {kinds['v']}, x {kinds['x']}, group int, angle double")


def _ringed(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, angles = _angles(batch.column(1), pivots)
            to = [a.tolist() if u else None for u, a in zip(unit, angles)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.list_(pa.float64()))], ["q", "e", "to"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, vec_id: str, embedding: str, query_id: str, query: str, k: int) -> DataFrame:
    """(q, v, score) of all vectors and queries compared in blocks: for each query its k best, and others. Every task meets
    some vectors with some queries, so neither side has to fit anywhere."""
    parts = max(1, -(-queries.count() // BLOCK_ROWS))
    a = written(blocked(queries.repartition(parts), query_id, query))
    return met(a, written(blocked(vectors, vec_id, embedding)), k).select("q", "v", F.round("raw", 6).alias("score"))


def neighbours(vectors: DataFrame, queries: DataFrame, vec_id: str, embedding: str, query_id: str, query: str, k: int, score: Column | None = None, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """(q, v, score) of pairs, for each query its k best and others, and the rows (row, group) that were compared. The
    score is the sum of products to six places, which is the cosine of unit vectors; `score` may be left out, no other is
    computed.

    Queries and vectors of another length, or that are no unit vectors, are compared with everything. Rows of one id, and
    equal vectors, are compared each; an empty side gives none.
    """
    at = pivots_of(vectors, embedding, pivots)
    v = written(blocked(filed(vectors, vec_id, embedding, at), "v", "x", "group", ("angle",)))
    groups = v.groupBy("group").agg(F.sum(F.size("ids")).alias("n"), F.min(F.array_min("d0")).alias("low"), F.max(F.array_max("d0")).alias("high"))
    rings = [r.asDict() for r in groups.collect()]  # at most one for each pivot, and one more
    asked = queries.select(F.col(query_id).alias("q"), F.col(query).alias("e"))
    kinds = dict(asked.dtypes)
    asked = written(asked.mapInArrow(_ringed(at), f"q {kinds['q']}, e {kinds['e']}, to array<double>").withColumn("row", F.monotonically_increasing_id()))
    ring = F.array(*(F.struct(*(F.lit(r[c]).alias(c) for c in ("group", "n", "low", "high"))) for r in rings)) if rings else F.array().cast("array<struct<group:bigint,n:bigint,low:double,high:double>>")
    away = F.when(F.col("to").isNull() | (F.col("r.group") < 0), 0.0).otherwise(F.get("to", F.col("r.group")))
    each = asked.select("row", "to", F.explode(ring).alias("r")).select("row", F.col("r.group").alias("group"), F.col("r.n").alias("n"), away.alias("away"), F.col("to").isNull().alias("all"), "r.low", "r.high")
    nearest = F.when(F.col("all") | (F.col("group") < 0), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.col("away") - F.col("high"), F.col("low") - F.col("away")))
    each = written(each.withColumn("nearest", nearest))
    before = F.sum("n").over(W.partitionBy("row").orderBy("away", "group").rowsBetween(W.unboundedPreceding, -1))
    first = each.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < k).withColumn("most", F.lit(4.0))

    def compared(some: DataFrame) -> DataFrame:
        every = some.withColumn("every", F.col("all") | (F.col("group") < 0)).join(asked.select("row", "e"), "row")
        a = written(blocked(every, "row", "e", "group", ("away", "most", "every")))
        return met(a, v, k, ringed=True).select(F.col("q").alias("row"), "v", F.round("raw", 6).alias("score"))

    kth = compared(first).withColumn("r", F.row_number().over(W.partitionBy("row").orderBy(F.desc("score")))).where(F.col("r") == k)
    reach = each.join(kth.select("row", "score"), "row", "left")
    #: beyond this angle a score is below the k-th; without k vectors there is no such
    most = F.when(F.col("score").isNull(), F.lit(4.0)).otherwise(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("score") - SLACK))) + SLACK)
    kept = reach.withColumn("most", most).where(F.col("nearest") <= F.col("most")).select("row", "group", "away", "all", "most")
    return compared(kept).join(asked.select("row", "q"), "row").select("q", "v", "score"), kept
