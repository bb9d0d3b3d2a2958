"""Source divergence audit: how far the word frequencies of the sources of a language are from each other.

Terms are counted per language and source. Kept terms are dealt to vocabulary chunks of bounded size, and the counts of a
source in a chunk are packed into one vector. The sources of a language form blocks; each pair of blocks is a tile, to which
the vectors of both are replicated, and its task goes through the chunks one after another and adds to the tile's pair
submatrix, so that it holds two blocks of one chunk however large the vocabulary is. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Documents of its language that a kept term stands in.
MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
#: Kept terms in a vocabulary chunk, about; sources in a block are a sixteenth of the language's, within these.
CHUNK, LEAST_BLOCK, MOST_BLOCK, BLOCKS = 4096, 4, 128, 16
#: Distinct (language, source, term) that a counting task holds before it hands them on.
HELD = 200_000

#: Every byte that is no part of a term is a blank, A-Z are lower-cased; parts of longer characters stay.
_FOLD = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term binary, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (text, lang, source): each term's number and documents, so far as the task holds them together; with a null
    term the documents themselves."""
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in seen.items():
            for a in range(0, len(n), 50_000):
                keys = list(n)[a : a + 50_000]
                of = [pa.array([x] * len(keys), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*of, pa.array(keys, pa.binary()), pa.array([n[k] for k in keys], pa.int64()), pa.array([docs[k] for k in keys], pa.int64())], [x.split()[0] for x in _COUNTS.split(", ")])
        seen.clear()

    held = 0
    for batch in batches:
        for text, lang, source in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            n, docs = seen[lang, source]
            before = len(n)
            terms = text.as_buffer().to_pybytes().translate(_FOLD).split()
            n.update(terms)
            docs.update(set(terms))
            n[None] += 1
            docs[None] += 1
            held += len(n) - before
            if held > HELD:
                yield from handed()
                held = 0
    yield from handed()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): how often each term comes in the group, and in how many of its documents. The row
    of the null term has the documents of the group, so that groups without terms have a row too."""
    d = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((text, "t"), (lang, "lang"), (source, "source"))))
    counts = d.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts.withColumn("term", F.col("term").cast("string"))


def whole(a: Column, b: Column) -> Column:
    """a / b without the fraction, in whole numbers."""
    return F.call_function("div", a, b)


def scaled(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), three digits at a time, so that nothing overflows."""
    by, rest, out = total + 2 * terms, count + 2, F.lit(0).cast("long")
    for factor in (1, 1000, 1000, 1000):
        out, rest = out * 1000 + whole(rest * factor, by), (rest * factor) % by
    return out + 1


def _p(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """scaled() of counts (groups by terms) with the totals of their groups."""
    by = (total + 2 * terms)[:, None]
    out, rest = np.divmod(count + 2, by)
    for _ in range(3):
        q, rest = np.divmod(rest * 1000, by)
        out = out * 1000 + q
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Tile:
    """The pair submatrix of two blocks of sources."""

    def __init__(self, key: tuple, terms: int):
        self.key, self.terms = key, terms
        self.members: tuple[list, list] = ([], [])  # of both sides: (place of the source, total)
        self.seen = 0

    def begin(self) -> None:
        self.totals = [np.array([x[1] for x in side], np.int64) for side in self.members]
        self.row = [{x[0]: k for k, x in enumerate(side)} for side in self.members]
        self.sums = np.zeros([len(side) for side in self.members], np.int64)

    def add(self, vectors: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        """A chunk's vectors: (side, place of the source, places of terms, counts)."""
        used = np.unique(np.concatenate([v[2] for v in vectors]))
        count = [np.zeros((len(side), len(used)), np.int64) for side in self.members]
        for side, source, at, n in vectors:
            count[side][self.row[side][source], np.searchsorted(used, at)] = n
        p, q = (_p(c, t, self.terms) for c, t in zip(count, self.totals))
        for k in range(len(p)):
            self.sums[k] += _apart(p[k], q).sum(axis=1)
        self.seen += len(used)

    def rows(self) -> Iterator[tuple]:
        """(lang, place, place, value) of each pair, the terms that neither block has included."""
        if self.terms:
            p, q = (_p(np.zeros((len(t), 1), np.int64), t, self.terms)[:, 0] for t in self.totals)
            self.sums += (self.terms - self.seen) * _apart(p[:, None], q[None, :])
        for i, (a, _) in enumerate(self.members[0]):
            for j, (b, _) in enumerate(self.members[1]):
                if a < b:
                    yield self.key[0], a, b, int(self.sums[i, j])


_PAIRS = "lang string, a long, b long, value long"


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (lang, left, right, chunk): members of a tile (chunk -1), then its vectors chunk by chunk."""
    out: list[tuple] = []
    tile: _Tile | None = None
    chunk, vectors = -1, []

    def packed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "a", "b", "value"), r)) for r in out], pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())]))
        out.clear()
        return batch

    def end_chunk() -> None:
        if chunk == -1 and tile:
            tile.begin()
        elif vectors:
            tile.add(vectors)
        vectors.clear()

    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            r = {n: batch.column(k)[i] for k, n in enumerate(names)}
            key = tuple(r[n].as_py() for n in ("lang", "left", "right"))
            at = r["chunk"].as_py()
            if tile is None or key != tile.key:
                if tile:
                    end_chunk()
                    out.extend(tile.rows())
                    if len(out) > 10_000:
                        yield packed()
                tile, chunk = _Tile(key, r["terms"].as_py()), -1
            elif at != chunk:
                end_chunk()
                chunk = at
            side, source = r["side"].as_py(), r["place"].as_py()
            if at == -1:
                tile.members[side].append((source, r["total"].as_py()))
            else:
                vectors.append((side, source, np.frombuffer(r["at"].as_buffer(), "<i4"), np.frombuffer(r["n"].as_buffer(), "<i8")))
    if tile:
        end_chunk()
        out.extend(tile.rows())
    yield packed()


_VECTORS = "lang string, source string, chunk int, at binary, n binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of (place, count) as bytes."""
    for batch in batches:
        lists = batch.column(3)
        at, n = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
        ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        cut_ = lambda x, kind: pa.array([x[a:b].astype(kind).tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], cut_(at, "<i4"), cut_(n, "<i8")], [x.split()[0] for x in _VECTORS.split(", ")])


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, chunk: int = CHUNK) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: the other sources of the language by their divergence, the
    furthest first. Part `term`: the `top` terms that are more frequent in the source than in its language, by how much.
    Values are as the module's contract has them (`scaled` frequencies p and q, (p - q)**2 // (p + q), summed).

    Null texts, languages and sources are empty ones. A document is a row, so repeated rows count as often; whole texts are
    counted; ties go by the item's UTF-8 bytes. Groups without kept terms have pairs, and no terms; the only source of a
    language has no pairs. Other columns are ignored, so their names can't clash; an empty table gives none.

    Tasks count before they shuffle, so what is shuffled is vocabulary, not text. No side is broadcast by hint.
    """
    counts = cut(term_counts(docs, text, lang, source))
    of_group = counts.groupBy("lang", "source").agg(F.lit(0).alias("none")).drop("none")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= min_docs)
    kept = cut(kept.select("lang", "term", "all"))
    langs = cut(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total")))
    own = cut(counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    size = F.count("*").over(Window.partitionBy("lang"))
    groups = of_group.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "terms", "lang_total"])
    groups = cut(groups.withColumns({"place": nth.cast("long"), "sources": size}))
    block = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.col("sources") / BLOCKS))).cast("long")
    groups = groups.withColumns({"block": F.floor(F.col("place") / block), "blocks": F.ceil(F.col("sources") / block)})

    part = F.pmod(F.xxhash64("term"), F.greatest(F.ceil(F.col("terms") / chunk), F.lit(1))).cast("int")
    #: dealt anew, else the terms of a language would be numbered in one task
    placed = kept.join(langs.select("lang", "terms"), "lang").withColumn("chunk", part).repartition("lang", "chunk")
    placed = placed.select("lang", "term", "chunk", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")).alias("at"))
    lists = own.join(placed, ["lang", "term"]).groupBy("lang", "source", "chunk").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("v"))
    vectors = lists.mapInArrow(_packed, _VECTORS).join(groups.drop("lang_total"), ["lang", "source"])
    heads = groups.select("lang", "place", "block", "blocks", "terms", "total", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("at"), F.lit(None).cast("binary").alias("n"))
    rows = heads.unionByName(vectors.select(*heads.columns)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sides = F.when(F.col("block") == F.col("other"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.when(F.col("block") < F.col("other"), 0).otherwise(1)))
    tiles = rows.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other"), "side": F.explode(sides)}).drop("block", "blocks", "other")
    sums = tiles.repartition("lang", "left", "right").sortWithinPartitions("lang", "left", "right", "chunk").mapInArrow(_tiled, _PAIRS)
    both = F.explode(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("with")), F.struct(F.col("b").alias("place"), F.col("a").alias("with"))))
    name = lambda place, as_: groups.select("lang", F.col("place").alias(place), F.col("source").alias(as_))
    pairs = sums.select("lang", "value", both.alias("p")).select("lang", "value", "p.place", "p.with")
    pairs = pairs.join(name("place", "source"), ["lang", "place"]).join(name("with", "item"), ["lang", "with"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p, q = scaled(F.col("n"), F.col("total"), F.col("terms")), scaled(F.col("all"), F.col("lang_total"), F.col("terms"))
    terms = own.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    apart, sum_ = (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q")
    terms = terms.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", whole(apart, sum_).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))


def query(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def _f(p: str, q: str) -> str:
    return f"CAST((({p}) - ({q})) * (({p}) - ({q})) // (({p}) + ({q})) AS BIGINT)"


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, kept.term, count(t.k) AS n, any_value(kept.n) AS all_n FROM g JOIN kept USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = kept.term GROUP BY ALL),
p AS (SELECT *, 1 + ({SCALE} * CAST(n + 2 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p,
  1 + ({SCALE} * (all_n + 2)) // (sum(all_n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS q FROM c),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum({_f('x.p', 'y.p')}), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND x.term = y.term GROUP BY ALL),
term AS (SELECT lang, source, 'term' AS part, term AS item, {_f('p', 'q')} AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
