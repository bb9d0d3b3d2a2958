from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestack.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            n = min(len(iw), window)
            grams = {tuple(iw[j : j + n]) for j in range(len(iw) - n + 1)} if n else set()
            for j in range(len(w) - n + 1 if n else 0):
                if tuple(w[j : j + n]) in grams:
                    hit |= {*range(j, j + n)}
                    found |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def got(spark, docs, items, **more):
    r = d.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **more)
    return sorted(((x.doc_id, x.n_words, x.n_hit, tuple(x["items"])) for x in r.collect()), key=repr)


def made(seed):
    rng = random.Random(seed)
    say = lambda n, size=40: " ".join(rng.choice(["w", "é", "Ü", "X9"]) + str(rng.randrange(size)) for _ in range(n))
    items = [(k, say(rng.choice([1, 3, 12, 13, 14, 30, 60]), rng.choice([3, 40, 500]))) for k in range(12)] + [(12, None), (13, ""), (None, say(20)), (3, say(25))]
    docs = []
    for k in range(40):
        parts = [say(rng.randrange(30), 500)]
        for _ in range(rng.randrange(4)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(w) + 1)
            parts += [" ".join(w[a : a + rng.choice([5, 12, 13, 25, 60])]), rng.choice(["", say(3)]), "\n, "]
        docs.append((k, " ".join(parts)))
    return [*docs, (50, None), (51, ""), (52, "..."), (0, docs[0][1]), (0, docs[1][1]), (None, docs[2][1])], items


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    docs, items = made(seed)
    assert got(spark, docs, items) == brute(docs, items)


def test_large_benchmarks_are_joined_by_a_shuffle(spark, monkeypatch):
    docs, items = made(9)
    monkeypatch.setattr(d, "BROADCAST_BYTES", 2000)
    monkeypatch.setattr(d, "SET_MAX", 3)
    assert got(spark, docs, items) == brute(docs, items)


def test_repeated_words_and_ties(spark):
    items = [(1, "a " * 30), (2, "a b " * 20)]
    docs = [(1, "a " * 13), (2, "a " * 12), (3, "b a " * 40), (4, "c " + "a " * 300 + "c")]
    assert got(spark, docs, items) == brute(docs, items)


def test_repeated_rows_and_ids(spark):
    docs, items = [(1, "a b " * 20), (1, "a b " * 20), (1, "c " * 14), (None, "a b " * 20), (None, None), (None, None), (2, "")], [(1, "a b " * 20), (2, None), (None, "c " * 14)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    r = d.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((repr(x.doc_id), x.n_words, x.n_hit, tuple(x["items"])) for x in r) == sorted(
        [("1", 40, 40, ("1",))] * 2 + [("1", 14, 14, ()), ("None", 40, 40, ("1",))] + [("None", 0, 0, ())] * 2 + [("2", 0, 0, ())]
    )


def test_empty_tables(spark):
    assert got(spark, [], [(1, "x " * 20)]) == []
    assert got(spark, [(1, "x " * 20)], []) == [(1, 20, 0, ())]


def test_every_window_keeps_a_fingerprint_of_its_own(spark):
    rng = random.Random(3)
    w = [f"w{rng.randrange(50)}" for _ in range(400)]
    frame = spark.createDataFrame([(" ".join(w),), (" ".join(w[100:150]),)], "t string")
    long, short = (
        {(x >> 30, x & d.POSITION) for x in r[0]} for r in frame.select(d.let(F.transform(d.words(F.col("t")), lambda x: F.xxhash64(x)), lambda h: d.winnow(h))).collect()
    )
    kept = {(h, p - 100) for h, p in long}
    for start in range(50 - 12):
        assert any(start <= p <= start + 8 for h, p in kept & short), start


def test_extra_columns_clash(spark):
    docs = spark.createDataFrame([(1, "x " * 20, 5, "k")], "doc_id long, text string, bad int, hash string")
    items = spark.createDataFrame([(1, "x " * 20, 7)], "item_id long, text string, fp int")
    assert d.decontaminate(docs, items).first().n_hit == 20
    assert d.drop_contaminated(docs, items).count() == 0
    assert d.drop_contaminated(docs, items.limit(0)).collect() == docs.collect()


def test_each_row_goes_by_its_own_text(spark):
    bad, clean = " ".join(f"w{k}" for k in range(20)), " ".join(f"c{k}" for k in range(20))
    rows = [(None, bad), (None, clean), (None, None), (1, clean), (1, bad), (2, bad), (2, bad), (3, clean), (3, clean)]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, bad)], "item_id long, text string")
    kept = d.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if r.text != bad)


def test_no_python_in_the_plan(spark):
    docs, items = spark.createDataFrame([(1, "x " * 20)], "doc_id long, text string"), spark.createDataFrame([(1, "x " * 20)], "item_id long, text string")
    plan = d.decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
