"""Lexical top-k by an inverted index of character trigrams.

A score counts substrings, and a text can only hold a substring if it holds its trigrams. Each item of a query (a term, a
bigram of terms, the whole query) goes by the rarest of its trigrams, so the postings of these give an upper bound of a
chunk's score. A few promising chunks of each query are scored first; their k-th score is a threshold. Items too light to
reach it together needn't be looked up, and only chunks whose bound reaches it are scored.

Postings come in blocks of chunks: a gram has one row in a block, with the places of the chunks that hold it, so bounds are
sums over arrays. A text is scored for all queries by one pass of an automaton of their items.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import normalize_for_match, strip
from ..sources.storage import written

#: Characters of an indexed gram; shorter whole queries go by grams of their own length.
GRAM = 3
#: For each query and result wanted, chunks that are scored for a threshold; lead items are the rarest ones up to so many
#: postings for each result wanted.
SEEDS, LEADS = 4, 200


def _codes(points: np.ndarray, n: int) -> np.ndarray:
    """A number for the n characters from each place on, different for all grams of up to three characters."""
    out = np.zeros(max(len(points) - n + 1, 0), np.int64)
    for k in range(n):
        out = (out << 21) + (points[k : len(points) - n + 1 + k].astype(np.int64) + 1)
    return out


def grams_of(text: str, sizes: tuple[int, ...] = (GRAM,)) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.unique(np.concatenate([_codes(points, n) for n in sizes]))


#: Chunks of a block of postings, and texts that are scored together.
CHUNKS, TEXTS = 4096, 256


def _listed(sizes: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                found = [grams_of(t or "", sizes) for t in part.column(part.num_columns - 1).to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*part.schema.names[:-1], "grams"])

    return run


def with_grams(rows: DataFrame, text: str, sizes: tuple[int, ...] = (GRAM,)) -> DataFrame:
    """rows with the distinct grams of `text` (array<long>) in place of it, as the last column."""
    others = [c for c in rows.columns if c != text]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.select(*others, text).mapInArrow(_listed(sizes), f"{schema}, grams array<long>")


def joined_text(title: Column | None, body: Column) -> Column:
    """What a chunk's items are sought in: its normalised title and body with a blank between."""
    return strip(F.concat(normalize_for_match(title), F.lit(" "), normalize_for_match(body))) if title is not None else normalize_for_match(body)


def _inverted(sizes: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNKS):
                part = batch.slice(a, CHUNKS)
                found = [grams_of(t or "", sizes) for t in part.column(1).to_pylist()]
                gram, at = np.concatenate(found), np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])
                order = np.argsort(gram, kind="stable")
                gram, starts = np.unique(gram[order], return_index=True)
                ends = np.concatenate([[0, 0], starts[1:], [len(at)]] if len(gram) else [[0, 0]]).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[order]))
                ids = pa.ListArray.from_arrays(pa.array([0, *[part.num_rows] * (len(gram) + 1)], pa.int32()), part.column(0))
                first = pa.array(np.full(len(gram) + 1, uuid.uuid4().int >> 65))
                yield pa.RecordBatch.from_arrays([first, pa.array(np.concatenate([[IDS], gram]).astype(np.int64)), held, ids], ["block", "gram", "at", "ids"])

    return run


#: Stands for a gram in the row of a block that has the ids of its chunks.
IDS = -1


def index(chunks: DataFrame, chunk_id: str, title: str | None, body: str, sizes: tuple[int, ...] = (GRAM,)) -> DataFrame:
    """Postings (block, gram, at, ids): for each gram of a block the places of its chunks, and one row with the ids of all.
    A table to be written once and asked often; null texts have none, and chunks that share an id have a place each."""
    rows = chunks.select(F.col(chunk_id).alias("chunk"), joined_text(F.col(title) if title else None, F.col(body)).alias("t"))
    return rows.mapInArrow(_inverted(sizes), f"block long, gram long, at array<int>, ids array<{dict(rows.dtypes)['chunk']}>")


def items(asked: DataFrame, title: bool, sizes: tuple[int, ...]) -> DataFrame:
    """(q, item, weight, gram): what can add to a query's score and by how much at most, with each of its grams. asked:
    q, text, terms, bigrams."""
    weighed = lambda texts, w: F.transform(texts, lambda x: F.struct(x.alias("item"), F.lit(w).alias("weight")))
    every = F.concat(weighed(F.col("terms"), 5 if title else 1), weighed(F.col("bigrams"), 8), weighed(F.filter(F.array("text"), lambda x: x != ""), 50))
    rows = asked.select("q", F.posexplode(every).alias("no", "i")).select("q", "no", "i.item", "i.weight")
    rows = rows.groupBy("q", "item").agg(F.sum("weight").alias("weight"))
    return with_grams(rows.withColumn("t", F.col("item")), "t", sizes).withColumn("gram", F.explode("grams")).drop("grams")


@dataclass
class Candidates:
    """The chunks that may be among a query's k best: a row for each chunk, with the numbers of the queries."""

    lists: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.lists.select("chunk", F.explode("qs").alias("q"))


def _bounded(grams: np.ndarray, numbers: np.ndarray, weights: np.ndarray, least: np.ndarray, most: int | None):
    """Of a block's postings (chunk, qs): the queries whose bound in the chunk (the weights of the grams that it has)
    reaches `least`; with `most` only the chunks of the greatest bounds of each query, ties by place."""
    order = np.argsort(grams, kind="stable")
    grams, numbers, weights = grams[order], numbers[order], weights[order]

    def run(block: pa.Table) -> pa.Table:
        gram = block.column("gram").to_numpy()
        own = int(np.flatnonzero(gram == IDS)[0]) if (gram == IDS).any() else None
        ids = block.column("ids").combine_chunks()
        if own is None:
            return pa.table({"chunk": ids.values[:0], "qs": pa.array([], pa.list_(pa.int32()))})
        ids, held = ids[own].values, block.column("at").combine_chunks()
        bound = np.zeros((len(least), len(ids)), np.int32)
        low, high = np.searchsorted(grams, gram), np.searchsorted(grams, gram, side="right")
        for i in np.flatnonzero(high > low):
            at = held[int(i)].values.to_numpy()
            for j in range(low[i], high[i]):
                bound[numbers[j], at] += weights[j]
        hit = (bound > 0) & (bound >= least[:, None])
        if most is not None and len(ids) > most:
            kept = np.argsort(-bound, axis=1, kind="stable")[:, :most]
            some = np.zeros_like(hit)
            np.put_along_axis(some, kept, True, axis=1)
            hit &= some
        of, q = np.nonzero(hit.T)
        chunk, starts = np.unique(of, return_index=True)
        ends = pa.array(np.concatenate([starts, [len(of)]]).astype(np.int32))
        values = {"chunk": ids.take(pa.array(chunk)), "qs": pa.ListArray.from_arrays(ends, pa.array(q.astype(np.int32)))}
        return pa.table(values | ({"bounds": pa.ListArray.from_arrays(ends, pa.array(bound[q, of]))} if most is not None else {}))

    return run


def candidates(postings: DataFrame, asked: DataFrame, title: bool, k: int, score, sizes: tuple[int, ...]) -> Candidates:
    """score: gives (q, chunk, score) of rows (chunk, qs). asked has one block of queries, whose q are their numbers."""
    wanted = items(asked, title, sizes)
    touched = wanted.select("gram").distinct().unionByName(asked.sparkSession.createDataFrame([(IDS,)], "gram long"))
    met = written(postings.join(touched, "gram", "left_semi"))  # the part of the index that the queries touch
    held = met.where(F.col("gram") != IDS).groupBy("gram").agg(F.sum(F.size("at")).alias("df"))
    #: an item that has a gram of no chunk is in none
    of_item = wanted.join(held, "gram", "left").groupBy("q", "item", "weight").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("rare"))
    of_item = of_item.where("rare.df > 0").select("q", "weight", F.col("rare.df").alias("df"), F.col("rare.gram").alias("gram"))
    of_item = written(of_item.groupBy("q", "gram").agg(F.sum("weight").alias("weight"), F.first("df").alias("df")))
    rarest = W.partitionBy("q").orderBy("df", "gram").rowsBetween(W.unboundedPreceding, 0)
    lead = of_item.withColumn("upto", F.sum("df").over(rarest)).where(F.col("upto") - F.col("df") < LEADS * k)
    kind, n = dict(postings.dtypes)["ids"].removeprefix("array<")[:-1], asked.count()

    def bounded(some: DataFrame, least: np.ndarray, most: int | None) -> DataFrame:
        t = some.select("gram", "q", "weight").toArrow()  # the items of one block of queries
        grams, numbers, weights = (t.column(c).to_numpy() for c in ("gram", "q", "weight"))
        here = met.join(some.select("gram").distinct().unionByName(asked.sparkSession.createDataFrame([(IDS,)], "gram long")), "gram", "left_semi")
        return here.groupBy("block").applyInArrow(_bounded(grams, numbers, weights, least, most), f"chunk {kind}, qs array<int>" + (", bounds array<int>" if most is not None else ""))

    first = bounded(lead, np.ones(n, np.int32), SEEDS * k).select("chunk", F.explode(F.arrays_zip("qs", "bounds")).alias("b")).select("chunk", F.col("b.qs").alias("q"), F.col("b.bounds").alias("bound"))
    best = W.partitionBy("q").orderBy(F.desc("bound"), "chunk")
    seeds = first.withColumn("r", F.row_number().over(best)).where(F.col("r") <= SEEDS * k)
    kth = score(seeds.groupBy("chunk").agg(F.collect_list("q").alias("qs"))).withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))).where(F.col("r") == k)
    least = written(kth.select("q", F.greatest(F.col("score"), F.lit(1)).alias("least")))
    #: the most frequent items that together stay below the threshold are left to the bound
    commonest = W.partitionBy("q").orderBy(F.desc("df"), "gram").rowsBetween(W.unboundedPreceding, 0)
    split = written(of_item.join(least, "q", "left").fillna(1, ["least"]).withColumn("upto", F.sum("weight").over(commonest)))
    slack = split.groupBy("q", "least").agg(F.sum(F.when(F.col("upto") < F.col("least"), F.col("weight")).otherwise(0)).alias("slack"))
    enough = np.ones(n, np.int32)
    for r in slack.collect():  # one for each query of the block
        enough[r["q"]] = r["least"] - r["slack"]
    return Candidates(bounded(split.where(F.col("upto") >= F.col("least")), enough, None))


def scorer(asked: pa.Table, k: int):
    """From batches (chunk, title, body[, qs]), normalised, rows (q, chunk, score) of the block of queries `asked` (q, text,
    terms, bigrams; q are its row numbers): those of a score above 0 that is at least the k-th best of its query so far in
    this task. With qs only these queries of a chunk count. Points as in retrieval.lexical_score(): an automaton finds
    every item in one pass, and a bigram, or the whole query, that is found has its terms there too."""
    items: dict[str, int] = {}
    points: list[tuple[int, int, int, int]] = []  # item, query, place (0 title, 1 body, 2 both together), points
    for q, (text, terms, bigrams) in enumerate(zip(*(asked.column(c).to_pylist() for c in ("text", "terms", "bigrams")))):
        given = [(t, 0, 4) for t in terms] + [(t, 1, 1) for t in terms] + [(b, 2, 8) for b in bigrams] + ([(text, 2, 50)] if text else [])
        points += [(items.setdefault(x, len(items)), q, place, w) for x, place, w in given]
    table = np.array(points, np.int64).reshape(-1, 4)
    n = asked.num_rows

    def of_place(place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = table[table[:, 2] == place]
        own = own[np.argsort(own[:, 0], kind="stable")]
        return np.searchsorted(own[:, 0], np.arange(len(items) + 1)), own[:, 1], own[:, 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for x, i in items.items():
            found.add_word(x, i)
        if items:
            found.make_automaton()
        by_place = [of_place(p) for p in range(3)]
        best = np.zeros((0, n), np.int64)

        def add(scores: np.ndarray, doc: int, text: str, *places: int) -> None:
            hit = np.fromiter({i for _, i in found.iter(text)}, np.int64) if items and text else np.zeros(0, np.int64)
            for starts, of, weight in (by_place[p] for p in places):
                counts = starts[hit + 1] - starts[hit]
                flat = np.arange(counts.sum()) + np.repeat(starts[hit] - np.cumsum(counts) + counts, counts)
                scores[doc] += np.bincount(of[flat], weight[flat], n).astype(np.int64)

        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                part = batch.slice(a, TEXTS)
                scores = np.zeros((part.num_rows, n), np.int64)
                for doc, (title, body) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    if title:
                        add(scores, doc, title, 0)
                        add(scores, doc, body, 1)
                        add(scores, doc, f"{title} {body}".strip(), 2)
                    else:
                        add(scores, doc, body, 1, 2)
                if part.num_columns > 3:
                    asks = np.zeros(scores.shape, bool)
                    for doc, qs in enumerate(part.column(3).to_pylist()):
                        asks[doc, qs] = True
                    scores[~asks] = 0
                best = np.sort(np.concatenate([best, scores]), axis=0)[-k:]
                kth = best[0] if len(best) == k else np.zeros(n, np.int64)
                at, q = np.nonzero((scores > 0) & (scores >= kth))
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), part.column(0).take(pa.array(at)), pa.array(scores[at, q], pa.int32())], ["q", "chunk", "score"])

    return run
