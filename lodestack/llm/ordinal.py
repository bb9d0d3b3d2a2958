"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight for each hashed text feature is shared by all grades; ordered thresholds turn the score into the
probabilities of the grades: P(grade <= k) = logistic(threshold[k] - score). Selection goes by the tail probability of
the highest grade; the expected grade is given besides.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched, chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table, within

#: Labelled rows that a model is fitted on at most: those of the least hash of their id. Everything else covers all rows.
SAMPLE = 12_000
#: Characters that the texts of these rows have together at most, which bounds what comes to the driver.
SAMPLE_CHARS = 60_000_000
DIMENSIONS = 1 << 18
#: Parts in which the feature vectors come to the driver, and rows that it unpacks together.
PARTS, ROWS = 16, 500
#: Features of fewer sampled documents have no weight.
MIN_DOCS = 8
GRADES = 3
#: Least probability of the highest grade of a selected document.
TAIL = 0.7

_TOKEN, _WORD = re.compile(r"\S+"), re.compile(r"\w+")
SYMBOLS = "#*$%&|<>!"


def grade(quality: Column, toxic: Column) -> Column:
    """0: poor; 1: sound but toxic; 2: sound. Null where either label is."""
    return F.when(quality.isNull() | toxic.isNull(), F.lit(None)).when(quality == 0, 0).when(toxic == 1, 1).otherwise(2)


def _hashed(feature: str) -> int:
    return crc32(feature.encode("utf-8", "replace")) % DIMENSIONS


@functools.lru_cache(maxsize=100_000)
def _of_token(token: str) -> tuple[int, ...]:
    core, marks = (token, "") if token.isalnum() else ("".join(_WORD.findall(token)), _WORD.sub("", token)[:8])
    low = core.lower()
    shape = _hashed(f"s{marks}{'U' if len(core) > 1 and core.isupper() else 'l'}")
    if not low.isascii():
        return _hashed(f"w{low}"), _hashed(f"p{low[:5]}"), _hashed(f"q{low[:4]}"), shape
    raw = low.encode()  # the same numbers, in fewer steps
    return (crc32(b"w" + raw) % DIMENSIONS, crc32(b"p" + raw[:5]) % DIMENSIONS, crc32(b"q" + raw[:4]) % DIMENSIONS, shape) if raw else (shape,)


def _level(share: float) -> int:
    return int(math.log2(1 + share * 64))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their values: damped counts of unit length, and 1 for each property of the text."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    numbers, counts = np.unique(np.fromiter(chain.from_iterable(map(_of_token, tokens)), np.int32), return_counts=True)
    values = np.log1p(counts)
    values /= math.sqrt(float(values @ values))
    n = len(tokens)
    lines = [x for x in text.split("\n") if x.strip()]
    properties = (
        f"U{min(9, int(10 * len(set(tokens)) / n))}n{min(8, int(math.log2(n)))}",
        f"R{_level(sum(map(str.__eq__, tokens, tokens[1:])) / n)}",
        f"S{_level(sum(map(text.count, SYMBOLS)) / len(text))}",
        f"C{_level(sum(map(str.isupper, tokens)) / n)}",
        f"D{_level(1 - len(set(lines)) / len(lines))}",
    )
    return np.concatenate([numbers, np.array([_hashed(p) for p in properties], np.int32)]), np.concatenate([values, np.ones(len(properties))]).astype(np.float32)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        numbers, values = features(text)
        return 1 - _logistic(self.thresholds - float(values @ self.weights[numbers]))


@dataclass
class Sparse:
    """Feature vectors of several texts: row i is at starts[i] to ends[i]."""

    numbers: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        ends = np.cumsum([len(n) for n, _ in rows])
        return cls(np.concatenate([n for n, _ in rows]), np.concatenate([v for _, v in rows]), np.concatenate([[0], ends[:-1]]), ends)

    def only(self, keep: np.ndarray) -> Sparse:
        """Without the features for which keep, by number, is false."""
        chosen = keep[self.numbers]
        before = np.concatenate([[0], np.cumsum(chosen, dtype=np.int64)])
        return Sparse(self.numbers[chosen], self.values[chosen], before[self.starts], before[self.ends])

    def rows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in `at`, feature number and value of each entry of these rows."""
        spans = [slice(a, b) for a, b in zip(self.starts[at], self.ends[at])]
        of = np.repeat(np.arange(len(at)), self.ends[at] - self.starts[at])
        return of, np.concatenate([self.numbers[x] for x in spans]), np.concatenate([self.values[x] for x in spans])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, min_docs: int = MIN_DOCS, **more) -> Model:
    """A model of feature vectors and their grades; features of fewer than min_docs rows have no weight."""
    if len(np.unique(grades)) < 2:
        return constant()
    every = Sparse.of(rows)
    return fit_sparse(every.only(np.bincount(every.numbers, minlength=DIMENSIONS) >= min_docs), grades, **more)


def constant(grades_n: int = GRADES) -> Model:
    """A model that selects everything."""
    return Model(np.zeros(DIMENSIONS, np.float32), np.full(grades_n - 1, -30.0))


def slopes(score: np.ndarray, y: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Negative log-likelihood of each row by its score and grade, its derivative by the score, and the sums of the
    derivatives by the thresholds t."""
    last = len(t)
    bounds = np.concatenate([[-30.0], t, [30.0]])
    above = np.where(y < last, _logistic(bounds[y + 1] - score), 1.0)
    below = np.where(y > 0, _logistic(bounds[y] - score), 0.0)
    p = np.maximum(above - below, 1e-9)
    d_above, d_below = above * (1 - above) / p, below * (1 - below) / p
    return -np.log(p), d_above - d_below, np.array([d_below[y == k + 1].sum() - d_above[y == k].sum() for k in range(last)])


def fit_sparse(x: Sparse, grades: np.ndarray, grades_n: int = GRADES, epochs: int = 30, rate: float = 1.0, ridge: float = 1e-6, batch: int = 256) -> Model:
    """By adaptive gradient steps on the negative log-likelihood."""
    w, w_sum = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-8)
    t, t_sum = np.arange(grades_n - 1) - (grades_n - 1) / 2, np.full(grades_n - 1, 1e-8)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for part in np.array_split(order.permutation(len(grades)), max(1, len(grades) // batch)):
            of, numbers, values = x.rows(part)
            _, by_score, by_threshold = slopes(np.bincount(of, values * w[numbers], len(part)), grades[part], t)
            g = np.bincount(numbers, values * by_score[of], DIMENSIONS) / len(part) + ridge * w
            w_sum += g * g
            w -= rate * g / np.sqrt(w_sum)
            g = by_threshold / len(part)
            t_sum += g * g
            t = np.sort(t - 0.3 * g / np.sqrt(t_sum))
    return Model(w.astype(np.float32), t)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [features(t.as_py() or "") for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([n.tobytes() for n, _ in made], pa.binary()), pa.array([v.tobytes() for _, v in made], pa.binary())], ["id", "g", "n", "v"])
    _of_token.cache_clear()


def train(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, min_docs: int = MIN_DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """A model of `ratings` (columns doc_id, quality, toxic), fitted on at most `sample` of them, whose texts have at most
    `chars` characters together; only their feature vectors come to the driver, one of PARTS parts at a time.

    Ratings with a null, and those of documents that docs hasn't, are left out; of several ratings of one document the
    least grade counts, of several texts of one id the least. Null and empty texts have no features; long ones count
    whole. Without ratings, or with one grade only, the model selects everything. Other columns are ignored.
    """
    graded = ratings.select(F.col(doc_id).cast("long").alias("id"), grade(F.col("quality"), F.col("toxic")).alias("g")).where("id IS NOT NULL AND g IS NOT NULL")
    chosen = graded.groupBy("id").agg(F.min("g").alias("g")).orderBy(F.xxhash64("id"), "id").limit(sample)
    found = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen), "id")
    found = cut(found.groupBy("id").agg(F.min("g").alias("g"), F.min("t").alias("t")))  # one text of each id, however often it occurs
    vectors = cut(within(found, chars).select("id", "g", "t").mapInArrow(_vectors, "id long, g int, n binary, v binary")).coalesce(PARTS)
    seen = np.zeros(DIMENSIONS, np.int64)
    for some in batched(vectors.select("n").toLocalIterator(), ROWS):
        seen += np.bincount(np.frombuffer(b"".join(r.n for r in some), np.int32), minlength=DIMENSIONS)
    keep = seen >= min_docs
    total = int(seen[keep].sum())
    numbers, values = np.empty(total, np.int32), np.empty(total, np.float32)
    at, starts, ends, keys, grades = 0, [], [], [], []
    for some in batched(vectors.toLocalIterator(), ROWS):
        bounds = np.cumsum([0, *(len(r.n) // 4 for r in some)])
        part = Sparse(np.frombuffer(b"".join(r.n for r in some), np.int32), np.frombuffer(b"".join(r.v for r in some), np.float32), bounds[:-1], bounds[1:]).only(keep)
        to = at + len(part.numbers)
        numbers[at:to], values[at:to] = part.numbers, part.values
        starts.append(part.starts + at)
        ends.append(part.ends + at)
        at = to
        keys += [(r.id, crc32(r.n)) for r in some]
        grades += [r.g for r in some]
    order = sorted(range(len(keys)), key=keys.__getitem__)  # so that the model doesn't depend on how rows were dealt
    y = np.array(grades, int)[order]
    if len(np.unique(y)) < 2:
        return constant()
    return fit_sparse(Sparse(numbers, values, np.concatenate(starts)[order], np.concatenate(ends)[order]), y)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", tail: float = TAIL) -> DataFrame:
    """A row for each row of docs: its id, expected_grade, tail_probability (of the highest grade), selected.

    Null and empty texts have the score 0. Whole texts are read; repeated rows and rows without an id give a row each; an
    empty table gives none; other columns are ignored, so their names can't clash. Map-only: nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            tails = [m.tails(t.as_py() or "") for t in b.column(1)]
            expected, last = [round(float(x.sum()), 6) for x in tails], [round(float(x[-1]), 6) for x in tails]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expected, pa.float64()), pa.array(last, pa.float64()), pa.array([x >= tail for x in last], pa.bool_())], ["id", "expected_grade", "tail_probability", "selected"])
        _of_token.cache_clear()  # the worker goes on to other stages

    return d.mapInArrow(run, f"id {d.dtypes[0][1]}, expected_grade double, tail_probability double, selected boolean").withColumnRenamed("id", doc_id)


def keep_selected(docs: DataFrame, model: Model, text: str = "text", tail: float = TAIL) -> DataFrame:
    """The rows of docs whose text the model selects, with all their columns, whatever their names. Map-only.

    Null and empty texts have the score 0, by which they stay or go; rows without an id, and repeated ones, go by their
    texts; whole texts are read; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([round(float(m.tails(t.as_py() or "")[-1]), 6) >= tail for t in b.column(at)], pa.bool_()))
        _of_token.cache_clear()

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
