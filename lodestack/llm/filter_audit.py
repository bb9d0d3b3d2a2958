"""Filter interaction audit: what each of five filters removes in every order they could be applied in.

Each document becomes a five-bit mask of the filters that it fails, by native expressions; the fifth, a copy of a smaller
document, takes the least id of each text's group. Masks are counted per part: at most 32 cells, from which all orders are
reckoned, so texts are read once however many orders there are.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2
WHITE, SYMBOLS = r"[\x20\x09-\x0D]+", "[#$%&*|]"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Orders in which a filter comes first of the n that a document fails: 120 / n.
FIRST = {n: len(ORDERS) // n for n in range(1, len(FILTERS) + 1)}
#: (order, step, bits of the steps before, bit of the step)
STEPS = [(o, k + 1, sum(BIT[x] for x in o[:k]), BIT[o[k]]) for o in ORDERS for k in range(len(FILTERS))]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_mask(text: Column) -> Column:
    """The bits of the filters that look at the text alone."""
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    counted = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")

    def bits(c: Column) -> Column:
        fails = {
            "A": c["n"] < MIN_WORDS,
            "B": 100 * c["distinct"].cast("long") < MIN_DISTINCT_PERCENT * c["n"].cast("long"),
            "C": 100 * upper > MAX_UPPER_PERCENT * F.length(text).cast("long"),
            "D": text.rlike(SYMBOLS),
        }
        return sum((F.when(f, BIT[k]).otherwise(0) for k, f in fails.items()), F.lit(0))

    return F.get(F.transform(counted, bits), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail just the filters of `mask`, and how many of them
    are labelled of quality 1, and toxic.

    Null texts and parts are empty ones; a document without an id is no copy and has no copies; rows that repeat an id
    and a text aren't copies of each other, and count one by one; several labels of one document count as one that is good
    (toxic) if any is. Whole texts are read; other columns are ignored, so their names can't clash; an empty table gives none.

    Texts go by their SHA-256. Rows are counted before every shuffle but that of the labels, so thousands of copies of a
    text reach its task as one row for each part, mask and label.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.unhex(F.sha2(t, 256)).alias("same"), own_mask(t).alias("mask"))
    d = d.withColumn("same", F.when(F.col("id").isNotNull(), F.col("same")))
    marks = labels.select(F.col(doc_id).alias("id"), F.col("quality").eqNullSafe(1).alias("good"), F.col("toxic").eqNullSafe(1).alias("toxic"))
    marks = marks.where("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    d = d.join(marks, "id", "left").fillna(False, ["good", "toxic"])
    kinds = ["part", "mask", "good", "toxic"]
    rows = d.groupBy("id", "same", *kinds).agg(F.count("*").alias("n"))
    #: of each kind of a text's rows: all, and those of its least id
    kept = rows.groupBy("same", *kinds).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    least = F.min("first.id").over(Window.partitionBy("same"))  # a row for each part, mask and label of a text
    originals = F.when(F.col("same").isNull(), F.col("n")).when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    kept = kept.withColumn("least", least)
    both = F.array(F.struct("mask", originals.alias("n")), F.struct((F.col("mask") + BIT["E"]).alias("mask"), (F.col("n") - originals).alias("n")))
    split = kept.select("part", "good", "toxic", F.explode(both).alias("c")).select("part", "good", "toxic", "c.mask", "c.n").where("n > 0")
    of = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias(flag)
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def orders(counted: DataFrame) -> DataFrame:
    """A row per part, order and step, from its cells (part, mask, n, good, toxic): filter_order, step and COUNTS. Without
    cells there are no rows."""
    per_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 32
    each = per_part.select("part", "cells", F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order"))
    each = each.select("part", "cells", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit_of = lambda k: F.call_function("shiftleft", F.lit(1), F.call_function("instr", F.lit(FILTERS), F.substring("filter_order", k, F.lit(1))) - 1)
    each = each.withColumns({"bit": bit_of(F.col("step")), "before": F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), F.lit(0), lambda a, k: a + F.when(k < F.col("step"), bit_of(k)).otherwise(0))})
    before, bit = F.col("before"), F.col("bit")
    fails, earlier = (lambda c: c["mask"].bitwiseAND(bit) > 0), (lambda c: c["mask"].bitwiseAND(before) > 0)
    share = F.create_map(*(F.lit(x).cast("long") for pair in FIRST.items() for x in pair))

    def total(test, value=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("cells", test), F.lit(0).cast("long"), lambda a, c: a + value(c))

    first = lambda c: fails(c) & ~earlier(c)
    counts = {
        "kept": total(lambda c: ~fails(c) & ~earlier(c)),
        "removed": total(first),
        "redundant": total(lambda c: fails(c) & earlier(c)),
        "unique_fails": total(lambda c: c["mask"] == bit),
        "good_lost": total(first, lambda c: c["good"]),
        "toxic_lost": total(first, lambda c: c["toxic"]),
        "shapley": total(fails, lambda c: c["n"] * F.element_at(share, F.bit_count(c["mask"]).cast("long"))),
    }
    return each.select("part", "filter_order", "step", *(counts[c].alias(c) for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """orders() of cells(); nulls, ties, repeated rows, long texts, empty tables and clashing names are as said there."""
    return orders(cells(docs, labels, doc_id, text, part))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Every document is put through every order by itself.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
m AS (SELECT part,
  CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '{SYMBOLS}') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask,
  EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND quality = 1) AS good,
  EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND toxic = 1) AS toxic FROM w),
s(filter_order, step, before, bit) AS (VALUES {', '.join(map(str, STEPS))}),
r AS (SELECT part, filter_order, step, bit, mask & before > 0 AS earlier, mask & bit > 0 AS fails, mask, good, toxic FROM m CROSS JOIN s),
c AS (SELECT part, filter_order, CAST(step AS INT) AS step, any_value(bit) AS bit,
  count(*) FILTER (NOT earlier AND NOT fails) AS kept, count(*) FILTER (fails AND NOT earlier) AS removed, count(*) FILTER (fails AND earlier) AS redundant,
  count(*) FILTER (mask = bit) AS unique_fails, count(*) FILTER (fails AND NOT earlier AND good) AS good_lost, count(*) FILTER (fails AND NOT earlier AND toxic) AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM (SELECT part, filter_order, step, bit, kept, removed, redundant, unique_fails, good_lost, toxic_lost FROM c)
"""
