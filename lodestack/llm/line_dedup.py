"""Line dedup across documents by pairwise alignment.

Every common block of enough words is a union of shortest runs: lines that follow each other and have enough words, but
not without their first line or not without their last. Each shortest run points to the first document that has it, so
an earlier holder of any part of a block that could be deleted alone is found, however frequent its lines are. A
document and such an earlier one are aligned by patience diff over the lines of the runs that they share; aligned common
blocks of enough words are deleted from the later document, and nothing else. Blocks that no single alignment can hold, as
they stand in another order or more than once, come out of further alignments of what is left. Only those runs are
brought together, so the work stays in proportion to the lines.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, table, unused

#: Common blocks of fewer words stay.
MIN_WORDS = 25
#: Lines, and pairs of documents, that a Python worker turns over at once.
LINES, PAIRS = 100_000, 100
#: Alignments of what a document and an earlier one share, before runs that are left are aligned one by one.
ROUNDS = 8
#: What \s stands for.
WHITE = " \t\n\x0b\f\r"


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of `pairs`, which rise in the first number, that rises in the second too."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(y)
            at.append(i)
        else:
            tops[k], at[k] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], rising in both.

    Lines that both sides have once are anchors, by their longest common order; the parts between are treated likewise.
    In parts without such lines equal ends are matched, then the n-th occurrence of a line with the n-th on the other side.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        n_a, n_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1)}
        anchors = _longest_rising([(i, place[a[i]]) for i in range(a0, a1) if n_a[a[i]] == 1 and n_b.get(a[i]) == 1])
        if anchors:
            for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
                todo.append((i + 1, k, j + 1, m))
            out += anchors
            continue
        ends = len(out)
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if len(out) > ends:  # what is left may have lines that are now alone on both sides
            todo.append((a0, a1, b0, b1))
            continue
        seen: Counter = Counter()
        nth: dict[tuple[int, int], int] = {}
        for j in range(b0, b1):
            seen[b[j]] += 1
            nth[b[j], seen[b[j]]] = j
        seen, pairs = Counter(), []
        for i in range(a0, a1):
            seen[a[i]] += 1
            if (j := nth.get((a[i], seen[a[i]]))) is not None:
                pairs.append((i, j))
        out += _longest_rising(pairs)
    return sorted(out)


def repeated_lines(runs: list[tuple[bytes, list[int], list[int]]], min_words: int) -> list[int]:
    """Places, in a document, of the lines to delete, from the runs that it shares with an earlier one: lines (of each
    its hash and words), places of the run there, and here.

    Only what patience diff aligns goes. Blocks that stand in another order, or more than once, don't fit one alignment:
    the runs that have lines left are aligned again, `ROUNDS` times at most, and then one by one.
    """

    def places(of: list, which: int) -> list[tuple[int, int, int]]:
        return sorted({(at + j, *line) for run in of for j, line in enumerate(run[0]) for at in run[which]})

    gone: set[int] = set()
    left = [(list(struct.iter_unpack("<qi", lines)), there, here) for lines, there, here in runs]
    for _ in range(ROUNDS):
        before = len(gone)
        gone.update(common_blocks([x[:2] for x in places(left, 1)], places(left, 2), min_words))
        left = [run for run in left if any(at + j not in gone for at in run[2] for j in range(len(run[0])))]
        if not left or len(gone) == before:
            break
    for lines, there, here in left:
        for at in here:
            gone.update(common_blocks([x[:2] for x in places([(lines, there[:1])], 1)], places([(lines, [at])], 1), min_words))
    return sorted(gone)


def common_blocks(a: list[tuple[int, int]], b: list[tuple[int, int, int]], min_words: int) -> list[int]:
    """Places in b of the lines of aligned blocks of enough words. a: (place, hash); b: (place, hash, words); places
    count all lines with words, so that a line between two shared ones ends a block."""
    pairs = patience([x[1] for x in a], [x[1] for x in b])
    out: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*pairs, (-1, -1)]:
        here = (a[i][0], b[j][0]) if i >= 0 else None
        if not here or not last or here != (last[0] + 1, last[1] + 1):
            if sum(b[x][2] for x in block) >= min_words:
                out += [b[x][0] for x in block]
            block = []
        block.append(j)
        last = here
    return out


def shortest_runs(words: np.ndarray, starts: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of lines of `words` words that have at least `min_words`: from each line on, and
    up to each line. Documents begin at `starts`, whose last element is the number of lines; no run crosses them."""
    sums = np.concatenate([[0], np.cumsum(words)])
    lines, doc = np.arange(len(words)), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = np.maximum(np.searchsorted(sums, sums[:-1] + min_words, "left"), lines + 1)
    start = np.minimum(np.searchsorted(sums, sums[1:] - min_words, "right") - 1, lines)
    on, back = end <= starts[doc + 1], start >= starts[doc]
    return sorted({*zip(lines[on].tolist(), end[on].tolist()), *zip(start[back].tolist(), (lines[back] + 1).tolist())})


_RUNS = "id long, th long, k1 long, k2 long, lines binary, at array<int>"


def _shortest(min_words: int):
    """From (id, th, lines with h, h2, w) a row for each different shortest run of a document: its hash (k1, k2), lines
    (of each its hash and words), at (places of its first line)."""

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, ths, lists = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)
        starts = np.asarray(lists.offsets)
        starts = (starts - starts[0]).astype(np.int64)
        h, h2, w = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
        keys, lines = np.stack([h, h2], 1).astype("<i8").tobytes(), np.rec.fromarrays([h, w], dtype="<i8,<i4").tobytes()
        doc = np.repeat(np.arange(len(ids)), np.diff(starts)).tolist()
        found: dict[tuple[int, bytes], list[int]] = {}
        for s, e in shortest_runs(w.astype(np.int64), starts, min_words):
            found.setdefault((doc[s], blake2b(keys[16 * s : 16 * e], digest_size=16).digest() + lines[12 * s : 12 * e]), []).append(s - int(starts[doc[s]]))
        halves = [struct.unpack_from("<qq", run) for _, run in found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ids[k] for k, _ in found], pa.int64()),
                pa.array([ths[k] for k, _ in found], pa.int64()),
                *(pa.array([x[i] for x in halves], pa.int64()) for i in range(2)),
                pa.array([run[16:] for _, run in found], pa.binary()),
                pa.array(list(found.values()), pa.list_(pa.int32())),
            ],
            [x.split()[0] for x in _RUNS.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, a = np.asarray(batch.column(2).offsets), 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + LINES, "right")) - 1)
                yield rows(batch.slice(a, b - a))
                a = b

    return run


def _aligned(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, PAIRS):
                part = batch.slice(k, PAIRS)
                found = [repeated_lines([(r["lines"], r["fat"], r["at"]) for r in runs.as_py()], min_words) for runs in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.int32()))], ["id", "th", "drop"])

    return run


def _parts(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(parts: Column) -> Column:
    """Lines that have a word, with their place among `parts`."""
    return F.filter(F.transform(parts, lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(WHITE)).alias("x"))), lambda y: F.length(y["x"]) > 0)


def dropped_lines(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """id, th (hash of the text), drop (places, among lines with a word, of those to delete)."""
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).where("id IS NOT NULL")
    hashed = F.transform(_filled(_parts(F.col("t"))), lambda l: F.struct(F.xxhash64(l["x"]).alias("h"), F.xxhash64(F.lit(1), l["x"]).alias("h2"), F.size(F.split(l["x"], r"\s+")).alias("w")))
    runs = d.select("id", F.xxhash64("t").alias("th"), hashed.alias("l")).mapInArrow(_shortest(min_words), _RUNS)
    shared = runs.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("k1", "k2", "first")
    shared = cut(shared)  # written, so that the join has an exchange of its own, whose hot keys Spark can split
    own = cut(runs.join(shared, ["k1", "k2"]))
    #: of several texts of the first document one that has the run
    holders = own.where("id = first").groupBy("k1", "k2").agg(F.min(F.struct("th", "at")).alias("f")).select("k1", "k2", F.col("f.th").alias("fth"), F.col("f.at").alias("fat"))
    holders = cut(holders)
    pairs = own.where("id > first").join(holders, ["k1", "k2"]).groupBy("id", "th", "first", "fth").agg(F.collect_set(F.struct("lines", "at", "fat")).alias("runs"))
    drops = pairs.select("id", "th", "runs").mapInArrow(_aligned(min_words), "id long, th long, drop array<int>")
    return drops.groupBy("id", "th").agg(F.array_distinct(F.flatten(F.collect_list("drop"))).alias("drop"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the repeated blocks deleted from `text`, and three more columns: _lines (lines with a word), _dropped
    (those deleted), _emptied (all were). Where docs has such a column, the new one has a further underscore in front.

    Lines are parts between \\n, compared without white space (\\s, \\r included) around; lines without a word are
    never compared and stay. "Later" goes by the id. Every line goes that stands in a block of at least `min_words` words
    that an earlier document has too, in the same order without lines between. Repeats inside one document stay. Rows
    that share an id are one document and don't delete from each other; repeated rows are treated alike; rows without an
    id, null and empty texts come back as they are; whole texts are read. Extra columns of any name are kept; an empty
    table stays empty.
    """
    own = {name: unused(docs, name) for name in ("id", "th", "drop", "done", "_lines", "_dropped", "_emptied")}
    drops = dropped_lines(docs, doc_id, text, min_words).select(*(F.col(x).alias(own[x]) for x in ("id", "th", "drop")))
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    joined = docs.join(drops, (F.col(doc_id).cast("long") == F.col(own["id"])) & (key == F.col(own["th"])), "left")

    def done(parts: Column, filled: Column) -> Column:
        lines, drop = F.size(filled), F.col(own["drop"])
        gone = F.transform(drop, lambda o: F.get(filled, o)["i"])
        kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone), lambda i: F.get(parts, i)), "\n")
        dropped = F.coalesce(F.size(drop), F.lit(0))
        emptied = (dropped > 0) & (dropped >= lines)
        new = F.when(drop.isNull(), F.col(text)).when(emptied, F.lit("")).otherwise(kept)
        return F.struct(new.alias("text"), lines.alias("_lines"), dropped.alias("_dropped"), emptied.alias("_emptied"))

    #: one pass over the text for all four
    once = let(_parts(F.coalesce(F.col(text), F.lit(""))), lambda parts: let(_filled(parts), lambda filled: done(parts, filled)))
    joined = joined.withColumn(own["done"], once)
    return joined.select(
        *(F.col(own["done"])["text"].alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns),
        *(F.col(own["done"])[x].alias(own[x]) for x in ("_lines", "_dropped", "_emptied")),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of docs after dedup_lines(): rows that lost all their lines are gone, and n_chars, if docs has it, is
    the new length where lines were deleted. Nulls, repeats, empty tables and extra columns are as there: rows without an
    id or a text stay as they are."""
    d = dedup_lines(docs, doc_id, text, min_words)
    dropped, emptied = (F.col(f"`{c}`") for c in d.columns[-2:])
    length = F.when(dropped > 0, F.length(text)).otherwise(F.col(n_chars)) if n_chars in docs.columns else None
    return d.where(~emptied).select(*(length.cast(docs.schema[c].dataType).alias(c) if c == n_chars else F.col(f"`{c}`") for c in docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    r = dedup_lines(table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_dropped").cast("long").alias("n_dropped"), F.sha2("text", 256).alias("text_sha256"))


#: Brute force: every shortest run of every document with its text; lines of those that an earlier document has go.
SQL = r"""
WITH p AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, i, trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM p)),
f AS (SELECT doc_id, i, x, row_number() OVER w AS o, sum(len(string_split_regex(x, '[ 	

]+'))) OVER w AS upto, len(string_split_regex(x, '[ 	

]+')) AS n
  FROM l WHERE x <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
w AS (SELECT a.doc_id, a.o AS s, min(b.o) AS e FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.o >= a.o AND b.upto - a.upto + a.n >= 25 GROUP BY ALL
  UNION SELECT b.doc_id, max(a.o), b.o FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.o >= a.o AND b.upto - a.upto + a.n >= 25 GROUP BY ALL),
r AS (SELECT w.doc_id, s, e, string_agg(x, chr(10) ORDER BY o) AS run FROM w JOIN f ON f.doc_id = w.doc_id AND o BETWEEN s AND e GROUP BY ALL),
g AS (SELECT DISTINCT f.doc_id, f.i FROM (SELECT *, min(doc_id) OVER (PARTITION BY run) AS first FROM r) r JOIN f ON f.doc_id = r.doc_id AND f.o BETWEEN s AND e WHERE first < r.doc_id),
n AS (SELECT doc_id, (SELECT count(*) FROM f WHERE f.doc_id = p.doc_id) AS n_lines, (SELECT count(*) FROM g WHERE g.doc_id = p.doc_id) AS n_dropped, text, parts FROM p),
k AS (SELECT doc_id, string_agg(y, chr(10) ORDER BY i) AS kept FROM (SELECT doc_id, i, parts[i] AS y FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM p))
  ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, n_lines, n_dropped, sha256(CASE WHEN n_dropped = 0 THEN text WHEN n_dropped >= n_lines THEN '' ELSE coalesce(kept, '') END) AS text_sha256
FROM n LEFT JOIN k USING (doc_id)
"""
