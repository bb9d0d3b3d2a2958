"""Benchmark decontamination by winnowing, in DataFrame functions alone.

A text's words are hashed in k-grams; of every run of `reach` consecutive k-grams the least hash (the leftmost among
equals) is kept with its position. Two texts that share `window` = k + reach - 1 words therefore share a kept hash at
the same place of the shared span. Kept hashes of documents are looked up among those of the benchmark, and each hit is
extended word by word to both sides, so that hash collisions cost time but never change a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, table, unused

#: Everything that separates words: the ASCII characters but digits and (lower-case) letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, K = 13, 5
#: Low bits of a packed fingerprint that hold its position; no text can have more words.
POSITION = (1 << 30) - 1
#: Bytes of benchmark fingerprints that are broadcast at most; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Up to so many benchmark fingerprints stand in the plan as a set, before documents' fingerprints become rows.
SET_MAX = 50_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _grams(hashes: Column, n: int) -> Column:
    """Of each place the hash of the n words from there, its low bits replaced by the place; null where fewer follow."""
    last = F.size(hashes) - n
    packed = lambda x, i: F.xxhash64(F.lit(n), x, *(F.get(hashes, i + j) for j in range(1, n))).bitwiseAND(F.lit(~POSITION)).bitwiseOR(i)
    return F.transform(hashes, lambda x, i: F.when(i <= last, packed(x, i)))


def winnow(hashes: Column, window: int = WINDOW, k: int = K) -> Column:
    """Packed fingerprints of every k-gram that is the least of some `window - k + 1` consecutive ones (at the end of
    the text of some fewer, which adds fingerprints and takes none away).

    Neighbours are fetched one by one: slices would be copied element by element, at several times the cost.
    """
    least = lambda g: F.array_distinct(F.transform(g, lambda x, i: F.least(x, *(F.get(g, i + j) for j in range(1, window - k + 1)))))
    return F.when(F.size(hashes) >= window, F.array_compact(let(_grams(hashes, k), least))).otherwise(F.array().cast("array<bigint>"))


def benchmark_fingerprints(items: DataFrame, item_id: str, item_text: str, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row for each distinct (fingerprint, surroundings): fp, need (words that must match), before (words of the
    surroundings that precede the k-gram), around (the surroundings), items (their ids as strings).

    Surroundings reach as far as any window that holds the k-gram. An item of fewer than `window` words is one window
    and has one fingerprint, the hash of all its words.
    """
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    n = F.size("w")
    packed = let(
        F.transform("w", lambda x: F.xxhash64(x)),
        lambda h: F.when(F.size(h) >= window, winnow(h, window, k)).otherwise(F.array(F.xxhash64(F.size(h), h).bitwiseAND(F.lit(~POSITION)))),
    )
    pos = F.col("p").bitwiseAND(F.lit(POSITION)).cast("int")
    start = F.when(n < window, F.lit(0)).otherwise(F.greatest(pos - (window - k), F.lit(0)))
    end = F.when(n < window, n).otherwise(F.least(pos + window, n))
    return (
        w.select("item", "w", F.explode(packed).alias("p"))
        .select(
            "item",
            F.col("p").bitwiseAND(F.lit(~POSITION)).alias("fp"),
            F.least(n, F.lit(window)).alias("need"),
            (pos - start).alias("before"),
            F.slice("w", start + 1, end - start).alias("around"),
        )
        .groupBy("fp", "need", "before", "around")
        .agg(F.collect_set("item").alias("items"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """A row for each row of docs: its id, n_words, n_hit, items (ids of items with a window in the text, as sorted
    strings), spans (struct<s,e>, word positions of verified matches, ends included).

    Null and empty texts have no words; long ones are read whole. Items without words match nothing; items without an id
    mark words but are not listed. Repeated document rows give a row each, rows without an id or with the same one go by
    their texts; repeated items count once. Other columns are ignored, so their names can't clash. An empty benchmark
    hits nothing, an empty table gives no rows.

    The benchmark is the query set: up to BROADCAST_BYTES its fingerprints are broadcast, so no document text is
    shuffled, only one small row for each document and each hit. Beyond that both sides are shuffled by fingerprint,
    those of the documents once, with the words around. Rows are told apart by id and text, not by a running number, so
    that a task that runs again deals them alike.
    """
    bench = benchmark_fingerprints(items, item_id, item_text, window, k)
    size = bench.agg(
        F.sum(F.lit(64) + F.octet_length(F.array_join("around", " ")) + 24 * F.size("around") + F.octet_length(F.array_join("items", " ")) + 24 * F.size("items")).alias("b"),
        F.collect_set(F.when(F.col("need") < window, F.col("need"))).alias("short"),
    ).first()
    small, short = (size["b"] or 0) <= BROADCAST_BYTES, sorted(size["short"])
    w = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("th"), words(F.col(text)).alias("w"))
    packed = let(F.transform("w", lambda x: F.xxhash64(x)), lambda h: F.concat(winnow(h, window, k), *(F.array_compact(_grams(h, n)) for n in short)))
    known = [r[0] for r in bench.select("fp").distinct().limit(SET_MAX + 1).collect()]
    if len(known) <= SET_MAX:
        packed = F.filter(packed, lambda p: p.bitwiseAND(F.lit(~POSITION)).isin(known))

    def narrow(p: Column) -> Column:
        """What is needed of the words to extend a hit: those as far around as any window that holds the k-gram."""
        at = p.bitwiseAND(F.lit(POSITION)).cast("int")
        start = F.greatest(at - (window - k), F.lit(0))
        return F.struct(p.bitwiseAND(F.lit(~POSITION)).alias("fp"), at.alias("at"), start.alias("start"), F.slice("w", start + 1, at - start + window).alias("near"))

    #: a first element without fingerprint stands for the document itself
    itself = F.struct(F.lit(None).cast("bigint").alias("fp"), *(F.lit(None).cast("int").alias(x) for x in ("at", "start")), F.lit(None).cast("array<string>").alias("near"))
    each = w.select("id", "th", F.size("w").alias("n"), F.explode(F.concat(F.array(itself), F.transform(packed, narrow))).alias("p")).select("id", "th", "n", "p.*")
    if small:
        hits = each.join(F.broadcast(bench), "fp", "left").where(F.col("around").isNotNull() | F.col("fp").isNull())
    else:
        hits = each.join(bench, "fp").unionByName(each.where("fp IS NULL"), allowMissingColumns=True)
    origin = F.col("at") - F.col("before")
    differ = F.filter(F.sequence(F.lit(0), F.size("around") - 1), lambda j: ~F.coalesce(F.get(F.col("near"), origin - F.col("start") + j) == F.get(F.col("around"), j), F.lit(False)))
    run = let(
        differ,
        lambda d: F.struct(
            (F.coalesce(F.array_max(F.filter(d, lambda j: j < F.col("before"))), F.lit(-1)) + 1).alias("lo"),
            (F.coalesce(F.array_min(F.filter(d, lambda j: j >= F.col("before"))), F.size("around")) - 1).alias("hi"),
        ),
    )
    hits = hits.select("id", "th", "n", "need", "items", origin.alias("o"), F.when(F.col("around").isNotNull(), run).alias("r")).where(
        F.col("r").isNull() | (F.col("r.hi") - F.col("r.lo") + 1 >= F.col("need"))
    )
    span = F.when(F.col("r").isNotNull(), F.struct((F.col("o") + F.col("r.lo")).alias("s"), (F.col("o") + F.col("r.hi")).alias("e")))
    per_doc = hits.groupBy("id", "th").agg(
        F.first("n").alias("n"),
        F.count(F.when(F.col("r").isNull(), 1)).alias("copies"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(-1).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, s: F.struct(F.greatest(a["last"], s["e"]).alias("last"), (a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(s["s"] - 1, a["last"]))).alias("n")),
        lambda a: a["n"],
    )
    each = per_doc.select("id", F.col("n").cast("long").alias("n_words"), covered.alias("n_hit"), "items", "spans", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return each.select(F.col("id").alias(doc_id), "n_words", "n_hit", "items", "spans")


def contaminated() -> Column:
    """At least a twentieth of the words, and one, stand in windows of the benchmark."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns, whatever their names. Each row goes by its own
    text: rows without an id and rows that share or repeat one are judged like others. Null and empty texts stay; an
    empty benchmark takes nothing, an empty table stays empty."""
    own = lambda t: F.xxhash64(F.coalesce(t, F.lit("")))
    judged = decontaminate(docs.select(F.struct(F.col(doc_id).alias("i"), own(F.col(text)).alias("h")).alias("row"), F.col(text).alias("text")), items, "row", "text")
    i, h = unused(docs, "bad"), unused(docs, "hash")
    bad = judged.where(contaminated()).select(F.col("row.i").alias(i), F.col("row.h").alias(h)).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(bad[i]) & (own(docs[text]) == bad[h]), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    r = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return r.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated")
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM iw
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id
), it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
