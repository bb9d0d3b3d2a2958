"""Quality rules: text statistics, and line sequence labelling by a linear-chain conditional random field.

Viterbi decoding marks each line as content or boilerplate from the look of the line and of its neighbours; a document
is kept if enough of its characters stand in content lines. The field is trained here, on lines labelled by evidence:
boilerplate are the lines of poor documents, and lines that documents of different openings have in common (licences,
navigation); copies of one text share its opening and are no evidence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table, within

#: Rated documents that the field is trained on at most: those of the least hash of their id.
SAMPLE = 4_000
#: Characters that the texts of these documents have together at most, which bounds what comes to the driver.
SAMPLE_CHARS = 40_000_000
#: Characters that a line counts as besides its own: what comes of a line to the driver is as large for a short one.
LINE_CHARS = 100
#: Documents of different openings that share a line of boilerplate.
SHARED = 3
#: Least share of content characters of a kept document.
SHARE = 0.5
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEAT_PERCENT, SPAN = 20, 30, 8

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_words(words: list[str], span: int = SPAN) -> int:
    """Words in windows of `span` words (a power of two) that the text has twice or more."""
    n = len(words)
    if n <= span:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    size = 1
    while size < span:  # numbers for twice as long windows, equal exactly where the windows are
        pairs = ids[:-size] * n + ids[size:]
        distinct, ids = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        size *= 2
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[: len(again)] += again
    edges[span : span + len(again)] -= again
    return int((np.cumsum(edges)[:n] > 0).sum())


def _level(x: float) -> int:
    return int(math.log2(1 + x))


def line_features(line: str, words: list[str], again: bool) -> list[str]:
    n, chars = len(words), sum(map(len, words))
    letters = sum(map(str.isupper, words))
    stripped = line.rstrip(SPACE)
    return [
        "bias",
        f"words{min(6, _level(n))}",
        f"mean{min(12, chars // n)}",
        f"symbols{min(6, _level(64 * sum(map(line.count, SYMBOLS)) / chars))}",
        f"marks{min(6, _level(64 * line.count('!') / chars))}",
        f"upper{int(4 * letters / n)}",
        f"distinct{int(5 * len(set(words)) / n)}",
        f"runs{int(4 * sum(map(str.__eq__, words, words[1:])) / n)}",
        f"digits{int(4 * sum(w.isdigit() for w in words) / n)}",
        f"end{stripped[-1] if stripped[-1] in '.!?:;,|*#$%&' else 'a' if stripped[-1].isalpha() else '0'}",
        f"bars{min(3, _level(line.count('|')))}",
        f"again{int(again)}",
    ]


def lines_of(text: str) -> tuple[list[tuple[list[str], int]], int]:
    """(features, characters in words) of each line with a word; how many of them equal an earlier line."""
    seen: set[str] = set()
    out, repeats = [], 0
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            continue
        again = line in seen
        repeats += again
        seen.add(line)
        out.append((line_features(line, words, again), sum(map(len, words))))
    return out, repeats


@dataclass
class Field:
    """weights: of features, for content against boilerplate; moves: [from][to]; 0 is boilerplate, 1 content."""

    weights: dict[str, float] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def emissions(self, lines: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in line]) for line in lines]

    def viterbi(self, scores: list[float]) -> list[int]:
        """The likeliest labels; content on ties."""
        (m00, m01), (m10, m11) = self.moves
        b, c, back = 0.0, scores[0] if scores else 0.0, []
        for s in scores[1:]:
            to_b, to_c = int(c + m10 >= b + m00), int(c + m11 >= b + m01)
            back.append((to_b, to_c))
            b, c = (c + m10 if to_b else b + m00), (c + m11 if to_c else b + m01) + s
        label = int(c >= b)
        out = [label] if scores else []
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def expectations(self, scores: list[float]) -> tuple[list[float], list[list[float]]]:
        """P(content) of each line, and the expected count of each move; by forward and backward sums."""
        (m00, m01), (m10, m11) = ([math.exp(x) for x in row] for row in self.moves)
        grow = [math.exp(min(30.0, max(-30.0, s))) for s in scores]
        forward = []
        b, c = 1.0, grow[0]
        for i in range(len(grow)):
            if i:
                b, c = b * m00 + c * m10, (b * m01 + c * m11) * grow[i]
            z = b + c
            b, c = b / z, c / z
            forward.append((b, c))
        probs, moves = [0.0] * len(grow), [[0.0, 0.0], [0.0, 0.0]]
        rb = rc = 1.0
        for i in reversed(range(len(grow))):
            b, c = forward[i]
            probs[i] = c * rc / (b * rb + c * rc)
            if i:
                b, c = forward[i - 1]
                steps = (b * m00 * rb, b * m01 * grow[i] * rc, c * m10 * rb, c * m11 * grow[i] * rc)
                z = sum(steps)
                for k, x in enumerate(steps):
                    moves[k >> 1][k & 1] += x / z
                rb, rc = m00 * rb + m01 * grow[i] * rc, m10 * rb + m11 * grow[i] * rc
                z = rb + rc
                rb, rc = rb / z, rc / z
        return probs, moves


def fit(docs: list[tuple[list[list[str]], list[int]]], epochs: int = 8, rate: float = 0.3, ridge: float = 1e-4) -> Field:
    """By adaptive gradient steps on the log-likelihood of the lines' labels; without both labels, a field that marks all
    as content."""
    model, sums, move_sums = Field(), {}, [[1e-6, 1e-6], [1e-6, 1e-6]]
    if len({y for _, labels in docs for y in labels}) < 2:
        return Field({"bias": 1.0})
    for epoch in range(epochs):
        for at in np.random.default_rng(epoch).permutation(len(docs)):
            lines, labels = docs[at]
            by_feature, by_move = slopes(model, lines, labels)
            n = len(lines)
            for f, g in by_feature.items():
                g = g / n - ridge * model.weights.get(f, 0.0)
                sums[f] = sums.get(f, 1e-6) + g * g
                model.weights[f] = model.weights.get(f, 0.0) + rate * g / math.sqrt(sums[f])
            for i in (0, 1):
                for j in (0, 1):
                    g = by_move[i][j] / n - ridge * model.moves[i][j]
                    move_sums[i][j] += g * g
                    model.moves[i][j] += rate * g / math.sqrt(move_sums[i][j])
    return model


def slopes(model: Field, lines: list[list[str]], labels: list[int]) -> tuple[dict[str, float], list[list[float]]]:
    """Derivatives of the log-likelihood of `labels` by the weights and by the moves: observed less expected counts."""
    probs, expected = model.expectations(model.emissions(lines))
    by_feature: dict[str, float] = {}
    for line, y, p in zip(lines, labels, probs):
        for f in line:
            by_feature[f] = by_feature.get(f, 0.0) + y - p
    by_move = [[-x for x in row] for row in expected]
    for i, j in zip(labels, labels[1:]):
        by_move[i][j] += 1
    return by_feature, by_move


def labelled(rows: list[tuple[int, list[tuple[int, list[str]]]]], shared: int = SHARED) -> list[tuple[list[list[str]], list[int]]]:
    """(features, labels) of the lines of each document, from its rating (0 poor) and, of each line, a hash and features."""
    openings: dict[int, set[int]] = {}
    for _, lines in rows:
        for h, _ in lines:
            openings.setdefault(h, set()).add(lines[0][0])
    return [([f for _, f in lines], [int(q > 0 and len(openings[h]) < shared) for h, _ in lines]) for q, lines in rows if lines]


def line_accuracy(model: Field, docs: list[tuple[list[list[str]], list[int]]]) -> float:
    """The share of lines whose decoded label is the given one."""
    right = [a == b for lines, labels in docs for a, b in zip(model.viterbi(model.emissions(lines)), labels)]
    return sum(right) / len(right) if right else 1.0


def evidence(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled lines of at most `sample` rated documents of at most `chars` characters together, by `labelled`; only
    hashes and features of lines come to the driver. Each line counts as LINE_CHARS more, so that there are at most
    `chars` / LINE_CHARS of them, but for one document, which is taken whatever its size. ratings: doc_id, quality.

    Ratings with a null, and those of documents that docs hasn't, are left out; of several ratings of one document, and
    of several texts of one id, the least counts. Null and empty texts have no lines; long ones count whole.
    """
    rated = ratings.select(F.col(doc_id).cast("long").alias("id"), F.col("quality").alias("q")).where("id IS NOT NULL AND q IS NOT NULL")
    chosen = rated.groupBy("id").agg(F.min("q").alias("q")).orderBy(F.xxhash64("id"), "id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = []
            for t in b.column(2):
                text = t.as_py() or ""
                hashes = [xxhash.xxh64_intdigest(x.strip(SPACE).encode("utf-8", "replace")) for x in text.split("\n") if x.strip(SPACE)]
                lines.append("\n".join(" ".join([str(h), *f]) for h, (f, _) in zip(hashes, lines_of(text)[0])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lines, pa.string())], ["id", "q", "lines"])

    found = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen), "id")
    found = cut(found.groupBy("id").agg(F.min("q").cast("int").alias("q"), F.min("t").alias("t")))  # one text of each id, however often it occurs
    size = F.length("t") + LINE_CHARS * (1 + F.length("t") - F.length(F.replace("t", F.lit("\n"), F.lit(""))))
    rows = within(found, chars, size).select("id", "q", "t").mapInArrow(run, "id long, q int, lines string").toArrow().sort_by([("id", "ascending"), ("lines", "ascending")])
    split = lambda x: (int((p := x.split(" "))[0]), p[1:])
    return labelled([(q.as_py(), [split(x) for x in lines.as_py().split("\n")]) for q, lines in zip(rows["q"], rows["lines"]) if lines.as_py()])


def train(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Field:
    """A field for the lines of evidence(); without ratings one that marks all as content."""
    return fit(evidence(docs, ratings, doc_id, text, sample, chars))


COLUMNS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "content_share": "double", "kept": "boolean"}


def judge(text: str | None, model: Field, share: float = SHARE) -> tuple:
    """The values of COLUMNS. A text without words fails and has no content."""
    text = text or ""
    words = _WORD.findall(text)
    lines, repeats = lines_of(text)
    again = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * again > REPEAT_PERCENT * len(words)
    labels = model.viterbi(model.emissions([f for f, _ in lines]))
    total = sum(n for _, n in lines)
    content = sum(n for (_, n), y in zip(lines, labels) if y) / total if total else 0.0
    return len(words), total, sum(map(text.count, SYMBOLS)), repeats, again, failed, round(content, 6), not failed and content >= share


def assess(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """A row for each row of docs: its id and COLUMNS. Null texts count as empty, which fail; whole texts are read;
    repeated rows and rows without an id give a row each; an empty table gives none; other columns are ignored, so their
    names can't clash. Map-only: nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        for b in batches:
            found = list(zip(*(judge(t.as_py(), m, share) for t in b.column(1)))) or [[]] * len(COLUMNS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, types[k]) for x, k in zip(found, COLUMNS.values()))], ["id", *COLUMNS])

    return d.mapInArrow(run, f"id {d.dtypes[0][1]}, " + ", ".join(f"{c} {k}" for c, k in COLUMNS.items())).withColumnRenamed("id", doc_id)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return assess(docs, train(docs, table(spark, sf_dir, "labels")))


def base_query(spark, sf_dir: str) -> DataFrame:
    """What SQL can express of the above: the statistics, and whether they fail a document."""
    return query(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


BASE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
d AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM t),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM g) WHERE k > 1) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
  len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) AS base_failed
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
"""
