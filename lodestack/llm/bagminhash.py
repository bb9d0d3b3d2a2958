"""Near-duplicates by BagMinHash: weighted minwise signatures of five-word shingles, banded, verified on the texts.

The weight of a shingle is its count. Weights are cut into the intervals (0,1], (1,2], (2,4], (4,8] ...; each (shingle,
interval) has its own Poisson process, whose points carry a signature component and a place in the interval and come in
ascending order. A component's value is the first point below the shingle's weight, over all shingles, so two texts
agree in a component with the probability of their multiset Jaccard similarity. Points above the largest value so far
are never made; all texts of a batch are worked on together.

Texts of equal words are one node. Nodes that share a band are compared with the centre of their bucket, on the texts.
Members that this leaves in several components meet where their deviations from the centre share one of their rarest
shingles, which all similar ones do (see `_apart`), so no group is ever turned into all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table, unused
from .components import components

WORDS, SIMILARITY = 5, 0.8
#: A pair of the least similarity shares no band with probability (1 - 0.8**4)**24, 3 in a million.
BANDS, ROWS = 24, 4
#: Bytes of text that are worked on together.
BATCH_BYTES = 3 << 20
#: Classes that sizes of deviations are told apart by, for each size of the centre; a finer scale offers more and meets less.
STEPS = 24

_WORD = re.compile(r"\w+")
_PAD, _MUL, _GOLDEN = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return h


_hashes = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: every bit of x touches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    found = _WORD.findall((text or "").lower())
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def shingles(words: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and their counts; a text of fewer words, but not none, is one shingle."""
    if not len(words):
        return words, np.zeros(0, np.int64)
    if len(words) < n:
        words = np.concatenate([words, np.full(n - len(words), _PAD)])
    acc = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        acc = _mixed(acc) * _MUL + words[i : len(words) - n + 1 + i]
    return np.unique(_mixed(acc), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Multiset Jaccard; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = BANDS * ROWS) -> np.ndarray:
    """One row of m values for each bag; infinite for empty bags."""
    h = np.full((len(bags), m), np.inf)
    if not bags:
        return h
    doc = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    item, count = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
    parts = [(doc, item, count, np.zeros(len(doc), np.int64))]
    level = 1
    while len(more := np.flatnonzero(count > 1 << (level - 1))):  # interval (2**(level-1), 2**level]
        parts.append((doc[more], item[more], count[more], np.full(len(more), level)))
        level += 1
    doc, item, count, level = (np.concatenate(x) for x in zip(*parts))
    low, width = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0), np.where(level > 0, 1 << np.maximum(level - 1, 0), 1)
    state = _mixed(item + level.astype(np.uint64) * _MUL)
    time, flat = np.zeros(len(doc)), h.reshape(-1)
    while len(doc):
        state = state + _GOLDEN
        first, second = _mixed(state), _mixed(state ^ _MUL)
        time = time - np.log1p(-((first >> np.uint64(11)).astype(np.float64) / (1 << 53))) / (m * width)
        label = ((second >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        place = low + ((second & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        inside = place < count
        np.minimum.at(flat, doc[inside] * m + label[inside], time[inside])
        open_docs = np.unique(doc)
        largest = np.zeros(len(bags))
        largest[open_docs] = h[open_docs].max(axis=1)
        go = time < largest[doc]
        doc, count, low, width, state, time = doc[go], count[go], low[go], width[go], state[go], time[go]
    return h


def bands(h: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row, different between bands."""
    bits = h.view(np.uint64).reshape(len(h), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN, (len(h), BANDS))
    for r in range(ROWS):
        key = _mixed(key * _MUL ^ bits[:, :, r])
    return key.view(np.int64)


def _parts(batch: pa.RecordBatch, texts: int = 1) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most BATCH_BYTES of text, or of one row."""
    start = size = 0
    for i, t in enumerate(batch.column(texts)):
        n = t.as_buffer().size if t.is_valid else 0
        if i > start and size + n > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(batch):
        yield batch.slice(start)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _parts(batch):
            words = [word_hashes(t.as_py()) for t in part.column(1)]
            keys = [xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None for w in words]
            found = bands(signatures([shingles(w) for w in words]))
            lists = pa.array([f if k else None for f, k in zip(found, keys)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), lists, part.column(2)], ["id", "key", "bands", "th"])
    _hashes.clear()  # the worker goes on to other stages


def _deviating(least: float):
    """From (a, b, ta, tb) rows (id, centre, similar, n, nc, d): whether text a is similar to its centre b, their numbers
    of shingles, and d, the shingles that only one of the two has, those of the centre marked."""

    def tokens(text: str) -> np.ndarray:
        item, count = shingles(word_hashes(text))
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)  # the second of two equal ones is another
        return np.sort(_mixed(np.repeat(item, count) + nth.astype(np.uint64) * _GOLDEN))

    def rows(part: pa.RecordBatch, seen: list) -> pa.RecordBatch:
        similar, n, nc, found = [], [], [], []
        for ta, tb in zip(part.column(2), part.column(3)):
            tb = tb.as_py()
            if not seen or seen[0] != tb:
                seen[:] = tb, tokens(tb)
            own, centre = tokens(ta.as_py()), seen[1]
            more, less = np.setdiff1d(own, centre, True), np.setdiff1d(centre, own, True)
            common = len(own) - len(more)
            similar.append(common >= least * (len(own) + len(centre) - common))
            n.append(len(own))
            nc.append(len(centre))
            found.append(np.concatenate([more, ~less]).view(np.int64))
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        d = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(similar), pa.array(n, pa.int64()), pa.array(nc, pa.int64()), d], ["id", "centre", "similar", "n", "nc", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list = []
        for batch in batches:
            for part in _parts(batch, 2):
                yield rows(part, seen)
        _hashes.clear()

    return run


def _stars(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(id, centre, similar, n, nc, d) for each member of a bucket and its centre. The centres' texts come last, so that
    equal ones follow each other."""
    pairs = members.where("id <> centre").select("id", "centre").distinct()
    with_own = pairs.join(texts, "id").select("id", "centre", F.col("t").alias("ta"))
    both = with_own.join(texts.select(F.col("id").alias("centre"), F.col("t").alias("tb")), "centre").select("id", "centre", "ta", "tb")
    return both.mapInArrow(_deviating(least), "id long, centre long, similar boolean, n long, nc long, d array<long>")


def _apart(star: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between members of one centre that `found` (id, component), the links to centres, leaves apart.

    Two members x and y differ by exactly the shingles in which their deviations d from the centre differ. They are
    similar if these are at most q * (|x| + |y|), q = (1 - least) / (1 + least). Of two components one isn't the
    centre's; its x isn't similar to the centre, so d of x and y then have a shingle in common. At most
    (q * (|x| + |y|) + |d(x)| - |d(y)|) / 2 of d(x) are missing in d(y), so the rarest so many and one of d(x) hold one
    of the shingles in common, the rarest of all, and those of d(y) too. A member goes by its class, the size of d in
    `STEPS` to the size of the centre, and offers for each class of partners its rarest shingles, by the pairs they would
    make. Those that no other component has, or nobody near that class, can't be in common: they count, but aren't
    offered. What meets is compared by the deviations, without texts.
    """
    q = (1 - least) / (1 + least)
    most = q * (1 + 1 / least)  # at most most * |x| shingles differ
    label = lambda name, new: found.select(F.col("id").alias(name), F.col("component").alias(new))
    c = star.join(label("id", "component"), "id", "left").join(label("centre", "main"), "centre", "left")
    c = c.select("centre", "id", F.coalesce("component", "id").alias("component"), F.coalesce("main", "centre").alias("main"), "n", "nc", F.size("d").alias("m"), "d")
    c = cut(c.join(c.where("component <> main").select("centre").distinct(), "centre", "left_semi"))
    apart = F.col("component") != F.col("main")
    step, far = F.lit(float(STEPS)) / F.col("nc"), F.lit(most) * F.col("n") + 1e-6
    c = c.withColumn("own", F.floor(F.col("m") * step))
    each = c.select("centre", "id", "component", "main", "own", F.explode("d").alias("s"))
    again = each.groupBy("centre", "s").agg((F.count_if(apart) * F.count("*")).alias("pairs"), F.min("own").alias("low"), F.max("own").alias("high"), F.min("component").alias("least"), F.max("component").alias("last"))
    rare = each.select("centre", "id", "s").join(again.where("least <> last"), ["centre", "s"]).groupBy("centre", "id").agg(F.array_sort(F.collect_list(F.struct("pairs", "s", "low", "high"))).alias("rare"))
    of = lambda which: F.struct(F.min(which).alias("low"), F.max(which).alias("high"))
    there = c.groupBy("centre").agg(of(F.col("own")).alias("every"), of(F.when(apart, F.col("own"))).alias("others"))
    partners = lambda side: F.when(apart, F.col(f"every.{side}")).otherwise(F.col(f"others.{side}"))
    first, last = F.greatest(partners("low"), F.floor(F.greatest(F.col("m") - far, F.lit(0.0)) * step)), F.least(partners("high"), F.floor((F.col("m") + far) * step))
    offers = c.drop("d").join(rare, ["centre", "id"]).join(there, "centre").withColumn("other", F.explode(F.when(first <= last, F.sequence(first, last))))
    offers = offers.withColumn("rare", F.filter("rare", lambda r: F.col("other").between(r["low"], r["high"])))
    missing = F.least(far, (far + F.col("m") - F.col("other") / step) / 2)
    take = F.floor(missing + 1e-6).cast("int") + 1 - (F.col("m") - F.size("rare"))
    offers = offers.withColumn("rare", F.transform(F.slice("rare", F.lit(1), F.greatest(F.when(missing >= 0, take), F.lit(0))), lambda r: r["s"]))
    offers = cut(offers.select("centre", "id", "component", "main", "n", "own", "other", "rare"))
    reach = _near(c, offers, q)
    left = offers.where("component <> main").select("centre", "rare", "own", "other", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"))
    left = left.join(reach.where("of = 'a'").select("centre", F.col("id").alias("a"), F.col("own").alias("ca"), F.col("other").alias("cb")), ["centre", "a", "ca"]).withColumn("s", F.explode("rare")).drop("rare")
    right = offers.select("centre", "rare", F.col("other").alias("own"), F.col("own").alias("other"), F.col("id").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"))
    right = right.join(reach.where("of = 'b'").select("centre", F.col("id").alias("b")), ["centre", "b"], "left_semi").withColumn("s", F.explode("rare")).drop("rare")
    met = left.join(right, ["centre", "s", "own", "other", "cb"])
    met = met.join(reach.where("of = 'b'").select("centre", F.col("id").alias("b"), F.col("own").alias("cb"), F.col("other").alias("ca")), ["centre", "b", "cb", "ca"], "left_semi")
    met = met.where((F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-6)).select("centre", "a", "b", "na", "nb").distinct()
    both = met.join(c.select("centre", F.col("id").alias("a"), F.col("d").alias("da")), ["centre", "a"]).join(c.select("centre", F.col("id").alias("b"), F.col("d").alias("db")), ["centre", "b"])
    differ = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    both = both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), ((F.col("na") + F.col("nb") - differ) / 2).alias("common"))
    return both.where(F.col("common") >= least * (F.col("n") - F.col("common"))).select("a", "b")


def _differ(a: str, b: str) -> Column:
    """In how many shingles two members differ, from their deviations from one centre."""
    return F.size(a) + F.size(b) - 2 * F.size(F.array_intersect(a, b))


def _near(c: DataFrame, offers: DataFrame, q: float) -> DataFrame:
    """Members (of: a or b; id, own and other component) that may be similar to one of another component of their centre.

    The number of shingles that differ is a metric. Each component is a ball around a member (the one closest to the
    centre; for the centre's own component the centre). Components that offer a shingle in common are compared by these
    first, a row for each pair of components however many members offer it: if the balls lie further apart than the
    largest members of both may differ, no member of one is similar to one of the other. Of the balls left only members
    that lie close enough to the other ball go on.
    """
    none = F.array().cast("array<long>")
    around = c.where("component <> main").groupBy("centre", "component").agg(F.min_by("d", F.struct("m", "id")).alias("around"))
    with_ball = c.join(around, ["centre", "component"], "left").withColumn("around", F.coalesce("around", none))
    with_ball = cut(with_ball.withColumn("off", _differ("d", "around")))
    balls = cut(with_ball.groupBy("centre", "component").agg(F.max("off").alias("radius"), F.max("n").alias("large"), F.first("around").alias("around")))
    each = cut(offers.select("centre", "component", "main", "own", "other", F.explode("rare").alias("s")).distinct())
    left = each.where("component <> main").select("centre", "s", "own", "other", F.col("component").alias("ca"))
    right = each.select("centre", "s", F.col("other").alias("own"), F.col("own").alias("other"), F.col("component").alias("cb"), "main")
    pairs = left.join(right, ["centre", "s", "own", "other"]).where((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("ca") < F.col("cb")))).select("centre", "ca", "cb").distinct()
    ball = lambda x: balls.select("centre", F.col("component").alias(f"c{x}"), F.col("radius").alias(f"r{x}"), F.col("large").alias(f"l{x}"), F.col("around").alias(f"o{x}"))
    near = pairs.join(ball("a"), ["centre", "ca"]).join(ball("b"), ["centre", "cb"])
    near = cut(near.where(_differ("oa", "ob") - F.col("ra") - F.col("rb") <= q * (F.col("la") + F.col("lb")) + 1e-6))
    reach = []
    for x, y in ("ab", "ba"):
        to = near.select("centre", F.col(f"c{x}").alias("component"), F.col(f"c{y}").alias("other"), F.col(f"r{y}").alias("radius"), F.col(f"l{y}").alias("large"), F.col(f"o{y}").alias("to"))
        close = c.join(to, ["centre", "component"]).where(_differ("d", "to") - F.col("radius") <= q * (F.col("n") + F.col("large")) + 1e-6)
        reach.append(close.select(F.lit(x).alias("of"), "centre", "id", F.col("component").alias("own"), "other"))
    return cut(reach[0].unionByName(reach[1]))


def _joined(found: DataFrame, edges: DataFrame) -> DataFrame:
    """Components (id, component) after edges (a, b) besides those that gave `found`: only components are linked anew."""
    of = lambda end: found.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    between = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    above = components(between)
    alone = above.join(found, "id", "left_anti").select("id", F.col("id").alias("component"))
    to = above.select(F.col("id").alias("component"), F.col("component").alias("above"))
    return found.unionByName(alone).join(to, "component", "left").select("id", F.coalesce("above", "component").alias("component"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """A row for each row of docs: its id, class_id (least id of its class) and duplicate (it isn't the class's least).

    Two texts are linked if the multisets of their five-word shingles have a Jaccard similarity of at least `least` (more
    than 0); classes are what links connect. Words are runs of letters, digits and underscores, in lower case; a text of
    fewer than five words is one shingle; texts without words, null and empty ones too, are linked to nothing. Rows that
    share an id are one document, linked as such; rows without an id (or with one that isn't a number) have no class.
    Whole texts are read, however long. Other columns are ignored, so their names can't clash; an empty table gives none.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("th"))
    signed = cut(d.mapInArrow(_signed, "id long, key binary, bands array<long>, th long").where("id IS NOT NULL"))
    #: a node for each sequence of words, numbered once, in what is written
    nodes = signed.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("id", "th")).alias("of"), F.first("bands").alias("bands"))
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "key", F.col("of.id").alias("id"), F.col("of.th").alias("th"), "bands"))
    each = nodes.select(F.col("node").alias("id"), F.explode(F.array_distinct("bands")).alias("k"))
    buckets = each.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(each.join(buckets, "k"))
    #: the centre of a bucket is the member with the most company in all its buckets: a group's original, not an outlier
    company = shared.groupBy("id").agg(F.sum("n").alias("company"))
    centres = shared.join(company, "id").groupBy("k").agg(F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("m")).select("k", (-F.col("m.minus")).alias("centre"))
    members = cut(shared.select("k", "id").join(centres, "k"))
    needed = nodes.select("node", "id", "th").join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    texts = cut(d.join(needed, ["id", "th"]).groupBy("node").agg(F.first("t").alias("t")).withColumnRenamed("node", "id"))
    star = cut(_stars(members, texts, least))
    links = star.where("similar").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    found = components(links)
    more = cut(_apart(star, found, least))
    node_of = signed.where("key IS NOT NULL").select("id", "key").distinct().join(nodes.select("key", "node"), "key").select("id", "node")
    #: several sequences of words under one id
    same = node_of.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("m")).where("a <> m").select("id", "a")
    same = node_of.join(same, "id").select("a", F.col("node").alias("b"))
    every = _joined(found, more.unionByName(same))
    classes = cut(every.withColumnRenamed("id", "node").join(nodes.select("node", "id"), "node").select("node", "id", "component"))
    least_id = classes.groupBy("component").agg(F.min("id").alias("class_id"))
    of_node = nodes.select("key", "node", "id").join(classes.join(least_id, "component").select("node", "class_id"), "node", "left").select("key", F.coalesce("class_id", "id").alias("class_id"))
    of_id = signed.join(of_node, "key", "left").groupBy("id").agg(F.min(F.coalesce("class_id", "id")).alias("class_id"))
    out = docs.select(F.col(doc_id).alias("doc"), F.col(doc_id).cast("long").alias("id")).join(of_id, "id", "left")
    return out.select(F.col("doc").alias(doc_id), "class_id", (F.col("id") != F.col("class_id")).alias("duplicate"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of docs, with all their columns, but those of documents that aren't the least of their class.

    Rows without an id, and texts without words, null and empty ones too, stay; rows that repeat an id stay or go
    together; an empty table stays empty. Columns of any name are kept.
    """
    later = unused(docs, "later")
    gone = near_duplicates(docs, doc_id, text, least).where("duplicate").select(F.col(doc_id).alias(later)).distinct()
    return docs.join(gone, F.col(doc_id) == F.col(later), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
s AS (SELECT doc_id, g, count(*) AS c FROM (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)) GROUP BY ALL),
n AS (SELECT doc_id, sum(c) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM o JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE o >= 0.8 * (nx.n + ny.n - o)),
r AS (SELECT doc_id AS id, doc_id AS reached FROM d UNION SELECT id, y FROM r JOIN e ON reached = x)
SELECT doc_id, class_id, doc_id <> class_id AS duplicate FROM d JOIN (SELECT id, min(reached) AS class_id FROM r GROUP BY id) ON id = doc_id
"""
