from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from lodestack.llm import divergence as dv
from lodestack.llm import filter_audit as fa


def by_hand(rows, labels):
    """The audit, order by order, document by document."""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in range(2))
    fails = []
    for i, text, part in rows:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        f["E"] = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        fails.append((part or "", i, {k for k, v in f.items() if v}))
    out, shapley = [], Counter()
    for part in {p for p, *_ in fails}:
        docs = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                removed = [x for x in left if name in x[2]]
                left = [x for x in left if name not in x[2]]
                shapley[part, name] += len(removed)
                redundant = sum(name in x[2] and bool(x[2] & set(order[: step - 1])) for x in docs)
                out.append((part, "".join(order), step, len(left), len(removed), redundant, sum(x[2] == {name} for x in docs), sum(x[1] in good for x in removed), sum(x[1] in toxic for x in removed)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_of_odd_rows(spark):
    rng = random.Random(1)
    pool = [" ".join(rng.choice(["a", "b", "Cc", "D#", "e\x0bf"]) + str(rng.randrange(90)) for _ in range(n)) for n in (0, 1, 5, 199, 200, 201, 400)] + [None, "", "x" * 60_000, " \t", "ABC " * 300]
    rows = [(rng.choice([None, *range(40)]), rng.choice(pool), rng.choice([None, "", "s", "t"])) for _ in range(120)]
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 40, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None)]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, mask int")
    lb = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in fa.audit(d, lb).select("part", "filter_order", "step", *fa.COUNTS).collect())
    assert got == by_hand(rows, labels)
    assert fa.audit(d.limit(0), lb).count() == 0
    assert fa.audit(d, lb.limit(0)).agg({"good_lost": "max"}).first()[0] == 0


def divergence_by_hand(rows, min_docs):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = lambda t: re.findall(b"[a-z\x80-\xff]+", t.encode().lower())
    docs, count, langs = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        w = words(text)
        docs.update({(lang, x) for x in w})
        count[lang, source].update(w)
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        terms = sorted(t for (x, t), n in docs.items() if x == lang and n >= min_docs)
        v = len(terms)
        total = Counter()
        for s in sources:
            total.update({t: count[lang, s][t] for t in terms})

        def ps(c):
            n = sum(c[t] for t in terms)
            return [1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * v) for t in terms]

        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = ps(total)
        for s in sources:
            p = ps(count[lang, s])
            pairs = [(sum(map(f, p, ps(count[lang, o]))), o) for o in sources - {s}]
            own = [(f(a, b), t.decode()) for a, b, t in zip(p, q, terms) if count[lang, s][t] and a > b]
            for part, items, top in (("pair", pairs, None), ("term", own, 10)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:top], 1)]
    return sorted(out)


def test_divergence_against_whole_numbers(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = ["a", "B", "cc", "Éa", "éa", "日本", "x1y", "d'e", *(f"{chr(97 + k)}{chr(97 + k // 3)}w" for k in range(20))]
    rows = [(rng.choice([None, "", *(" ".join(rng.choices(vocabulary[: rng.randrange(1, 28)], k=rng.randrange(30))) for _ in range(6))]), rng.choice(["en", "en", "de", None]), rng.choice([None, *(f"s{k}" for k in range(23))])) for _ in range(400)]
    rows += [("only one word", "xx", "a"), (None, "xx", "b"), ("alone", "yy", "a"), ("long " * 50_000, "en", "s1")] + [("same same", "en", "s2")] * 15
    d = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, place int")
    monkeypatch.setattr(dv, "HELD", 20)
    for chunk in (3, 4096):
        got = dv.divergence(d, min_docs=10, chunk=chunk).select("lang", "source", "part", "item", "value", "rank")
        assert sorted(tuple(r) for r in got.collect()) == divergence_by_hand(rows, 10)
    assert dv.divergence(d.limit(0)).count() == 0


def test_large_counts_do_not_overflow(spark):
    n, total, terms = 9_876_543_210_987, 98_765_432_109_876, 12_345_678
    want = 1 + 1_000_000_000 * (n + 2) // (total + 2 * terms)
    assert dv._p(np.array([[n]]), np.array([total]), terms)[0, 0] == want
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(n, total, terms)], "n long, t long, v long").select(dv.scaled(F.col("n"), F.col("t"), F.col("v"))).first()[0] == want


def test_tiles_see_a_chunk_at_a_time(spark, monkeypatch):
    """Vectors of a tile arrive chunk by chunk."""
    seen = []
    real = dv._Tile.add
    monkeypatch.setattr(dv._Tile, "add", lambda self, v: seen.append(len(v)) or real(self, v))
    import pyarrow as pa

    head = [("en", 0, 0, -1, side, k, 2, 5, None, None) for side in (0, 1) for k in range(2)]
    body = [("en", 0, 0, c, side, k, 2, 5, np.array([1], "<i4").tobytes(), np.array([2 + k], "<i8").tobytes()) for c in range(3) for side in (0, 1) for k in range(2)]
    names = ("lang", "left", "right", "chunk", "side", "place", "terms", "total", "at", "n")
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in head + body])
    assert len([r for b in dv._tiled(iter([batch])) for r in b.to_pylist()]) == 1 and seen == [4, 4, 4]
