"""Lexical and vector retrieval, and the rows of a vector collection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import bound, normalize_for_match, strip, text_of
from ..sources.storage import written
from . import lexical, neighbours
from .corpus import last_wins


def query_terms(query: Column) -> tuple[Column, Column, Column]:
    """Normalised query, its terms of three characters or more, and bigrams of neighbouring such terms."""
    q = normalize_for_match(query)
    terms = F.filter(F.split(q, " "), lambda t: F.length(t) >= 3)
    pairs = F.zip_with(terms, F.slice(terms, F.lit(2), F.greatest(F.size(terms) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return q, terms, F.filter(pairs, lambda p: p.isNotNull())


def _points(found: Column) -> Column:
    return F.aggregate(found, F.lit(0), lambda s, p: s + p)


def lexical_score(title: Column, body: Column, query: Column, terms: Column, bigrams: Column) -> Column:
    """50 for the whole query, 8 for each bigram in title and body, 4 for each term in the title, 1 for each in the body;
    all by substrings of normalised texts, repeated terms counted again.

    Texts are searched for terms first: a bigram can only be where both of its terms are, the query where all are.
    """
    seen = F.transform(terms, lambda t: F.struct(F.contains(title, t).alias("t"), F.contains(body, t).alias("b")))

    def scored(f: Column) -> Column:
        there = lambda i: F.coalesce(F.get(f, i)["t"] | F.get(f, i)["b"], F.lit(False))
        by_term = _points(F.transform(f, lambda x: 4 * x["t"].cast("int") + x["b"].cast("int")))

        def by_whole(text: Column) -> Column:
            pairs = _points(F.transform(bigrams, lambda p, i: F.when(there(i) & there(i + 1), F.when(F.contains(text, p), 8).otherwise(0)).otherwise(0)))
            every = F.forall(f, lambda x: x["t"] | x["b"])
            return pairs + F.when((query != "") & every, F.when(F.contains(text, query), 50).otherwise(0)).otherwise(0)

        return by_term + bound(strip(F.concat(title, F.lit(" "), body)), by_whole)

    return bound(seen, scored)


def best(rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, ranked from 1; Spark keeps k rows of a group in each task before the shuffle."""
    return rows.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


#: Queries that are broadcast at once.
BLOCK = 1000


def blocks(queries: DataFrame, rows: int = BLOCK) -> list[DataFrame]:
    """The queries in parts of about `rows` rows, by a hash of the whole row; each part is scored in its own pass."""
    n = max(1, -(-queries.count() // rows))
    number = F.pmod(F.xxhash64(*queries.columns), F.lit(n))
    return [queries.where(number == i) for i in range(n)] if n > 1 else [queries]


def _numbered(asked: DataFrame):
    """A block of queries in the driver, as an Arrow table, and (number, q) rows of them."""
    table = asked.toArrow()
    numbered = table.select(["id"]).append_column("number", pa.array(range(table.num_rows), pa.int32()))
    return table, asked.sparkSession.createDataFrame(numbered, f"id {dict(asked.dtypes)['id']}, number int")


def _asked(queries: DataFrame, query_id: str, query: str) -> DataFrame:
    q, terms, bigrams = query_terms(F.col(query))
    return written(queries.select(F.col(query_id).alias("id"), q.alias("text"), terms.alias("terms"), bigrams.alias("bigrams")))


def _texts(chunks: DataFrame, chunk_id: str, title: str | None, body: str) -> DataFrame:
    """(chunk, title, body), normalised once for each chunk."""
    return chunks.select(F.col(chunk_id).alias("chunk"), (normalize_for_match(F.col(title)) if title else F.lit("")).alias("title"), normalize_for_match(F.col(body)).alias("body"))


def _scored(rows: DataFrame, table: pa.Table, k: int) -> DataFrame:
    return rows.mapInArrow(lexical.scorer(table, k), f"q int, chunk {dict(rows.dtypes)['chunk']}, score int")


def lexical_topk(chunks: DataFrame, queries: DataFrame, chunk_id: str, title: str | None, body: str, query_id: str, query: str, k: int = 5, postings: DataFrame | None = None) -> DataFrame:
    """query_id, rank, chunk_id, score of the k best chunks of each query, ties by chunk_id; scores of 0 don't count.

    postings: lexical.index() of the chunks, written before. With it only chunks that can reach the k-th score are scored
    (see `lexical`), which pays from some tens of queries on; without it a pass over the chunks scores a block of queries.
    The result is the same. Chunks that share an id are ranked each; queries that share one are one by their best chunks.
    """
    parts = blocks(_asked(queries, query_id, query))
    if postings is not None and len(parts) > 1:
        postings = written(postings)
    scored = []
    for asked in parts:
        table, ids = _numbered(asked)
        if postings is None:
            pairs = _scored(_texts(chunks, chunk_id, title, body), table, k)
        else:
            found, score = _pairs(chunks, table, chunk_id, title, body, k, postings)
            pairs = score(found.lists)
        top = best(pairs, ["q"], [F.desc("score"), F.asc("chunk")], k)
        scored.append(top.join(F.broadcast(ids), F.col("q") == F.col("number")).select("id", "chunk", "score"))  # a block of queries
    top = best(reduce(DataFrame.unionByName, scored), ["id"], [F.desc("score"), F.asc("chunk")], k)
    return top.select(F.col("id").alias(query_id), "rank", F.col("chunk").alias(chunk_id), "score")


def lexical_pairs(chunks: DataFrame, queries: DataFrame, chunk_id: str, title: str | None, body: str, query_id: str, query: str, k: int, postings: DataFrame):
    """What lexical_topk() scores of one block of queries (lexical.Candidates), and what scores it."""
    return _pairs(chunks, _asked(queries, query_id, query).toArrow(), chunk_id, title, body, k, postings)


def _pairs(chunks: DataFrame, table: pa.Table, chunk_id: str, title: str | None, body: str, k: int, postings: DataFrame):
    lengths = min((len(t) for t in table.column("text").to_pylist() if t), default=lexical.GRAM)
    sizes = tuple(range(min(lengths, lexical.GRAM), lexical.GRAM + 1))  # shorter queries have no trigram
    if len(sizes) > 1:
        postings = lexical.index(chunks, chunk_id, title, body, sizes)
    numbered = table.select(["text", "terms", "bigrams"]).append_column("q", pa.array(range(table.num_rows), pa.int32()))
    asked = chunks.sparkSession.createDataFrame(numbered, "text string, terms array<string>, bigrams array<string>, q int")

    def score(lists: DataFrame) -> DataFrame:
        wanted = lists.groupBy(F.col("chunk").alias("wanted")).agg(F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs"))
        rows = chunks.join(wanted, F.col(chunk_id).eqNullSafe(F.col("wanted")))
        rows = rows.select(F.col(chunk_id).alias("chunk"), (normalize_for_match(F.col(title)) if title else F.lit("")).alias("title"), normalize_for_match(F.col(body)).alias("body"), "qs")
        return _scored(rows, table, k)

    return lexical.candidates(postings, asked, title is not None, k, score, sizes), score


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def vector_topk(vectors: DataFrame, queries: DataFrame, vec_id: str, embedding: str, query_id: str, query: str, k: int = 10, pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score (cosine of unit vectors, to six places) and distance of the k nearest vectors,
    exactly, ties by vec_id. With `pivots` whole groups of vectors that lie in clusters are never compared (see
    `neighbours`); without, the queries are scored in blocks against all, which vectors without clusters ask for."""
    args = (vectors, queries, vec_id, embedding, query_id, query, k)
    pairs = neighbours.nearest(*args) if pivots is None else neighbours.neighbours(*args, pivots=pivots)[0]
    top = best(pairs, ["q"], [F.desc("score"), F.asc("v")], k)
    return top.select(F.col("q").alias(query_id), "rank", F.col("v").alias(vec_id), "score", F.round(1 - F.col("score"), 6).alias("distance"))


def embedding_text(title: Column, text: Column, head: int = 300) -> Column:
    """What is embedded of a chunk: its text, below the title unless its beginning has it."""
    t = strip(text_of(title))
    led = (t != "") & ~F.contains(F.substring(text_of(text), 1, head), t)
    return F.concat(F.lit("passage: "), F.when(led, F.concat(t, F.lit("\n"))).otherwise(""), text_of(text))


def flat_column(name: str, kind: str) -> Column:
    """A column as a scalar: null strings as "", arrays, maps and structs as JSON, arrays of strings with a space after
    each comma."""
    c = F.col(name)
    if kind == "array<string>":
        quoted = F.transform(c, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1))
        return F.coalesce(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")), F.lit(""))
    if kind.startswith(("array<", "map<", "struct<")):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(c, F.lit("")) if kind == "string" else c


def flat_metadata(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*(flat_column(c, kinds[c]).alias(c) for c in columns))


def upserted(collection: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """The collection after the batch: of each key the row of the greatest version. To be written to a new path."""
    return last_wins(collection.unionByName(batch), [key], [version])


def citation(article: Column, clause: Column, point: Column, words: tuple[str, str, str] = ("Điều", "Khoản", "Điểm"), unknown: str = "unknown") -> Column:
    part = lambda c, w: F.when(strip(text_of(c)) != "", F.concat(F.lit(f"{w} "), c))
    joined = F.concat_ws(", ", *(part(c, w) for c, w in zip((article, clause, point), words)))
    return F.when(joined == "", unknown).otherwise(joined)


#: Fields of a chunk that a result shows besides its text. Fixed values.
RESULT_FIELDS = ("canonical_doc_id", "title", "document_number", "issued_date", "status", "topic_labels", "retrieval_scope", "article_number", "clause_number", "point_key", "source_url")


def result_rows(top: DataFrame, chunks: DataFrame, chunk_id: str, text: str = "text", fields: Sequence[str] = RESULT_FIELDS) -> DataFrame:
    """The rows of a top-k (its columns) with what a reader needs to cite them: the fields, as scalars, "" where a chunk or
    all chunks lack one, the citation by article, clause and point, and the text. Fields that top has already stay its
    own. A chunk that is gone has blank fields; of several chunks of an id each gives a row."""
    kinds = dict(chunks.dtypes)
    shown = [f for f in fields if f not in top.columns]
    own = [(flat_column(f, kinds[f]) if f in kinds else F.lit("")).alias(f) for f in shown]
    c = chunks.select(F.col(chunk_id).alias(chunk_id), *own, text_of(F.col(text)).alias("text"))
    r = top.join(c, chunk_id, "left").withColumns({f: F.coalesce(F.col(f).cast("string"), F.lit("")) for f in (*shown, "text")})
    place = [F.col(f) if f in r.columns else F.lit("") for f in ("article_number", "clause_number", "point_key")]
    return r.select(*top.columns, *shown, citation(*place).alias("citation"), "text")


def preview(text: Column, most: int = 700) -> Column:
    return F.substring(F.regexp_replace(text_of(text), "\n", " "), 1, most)
