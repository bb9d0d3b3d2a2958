from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from lodestack.llm import bagminhash as b
from lodestack.llm.components import components


def bag(text):
    import re

    w = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(x, y):
    return sum((x & y).values()) / sum((x | y).values()) if x and y else 0.0


def classes(rows, least=0.8):
    """Least reachable id of each document, by comparing all pairs."""
    bags = [(i, bag(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in bags}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for n, (i, x) in enumerate(bags):
        for j, y in bags[:n]:
            if jaccard(x, y) >= least:
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in parent}


def got(spark, rows):
    r = b.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(r) == len(rows)
    return {x.doc_id: x.class_id for x in r if x.doc_id is not None}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        if not words:
            break
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [f"n{rng.randrange(10**6)}"], [words[k], f"i{rng.randrange(10**6)}"]])
    return " ".join(words)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(2)
    for high in (1, 3, 40):
        items = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
        x = rng.integers(0, high + 1, len(items))
        y = np.where(rng.random(len(items)) < 0.7, x, rng.integers(0, high + 1, len(items)))
        one, two = (items[x > 0], x[x > 0]), (items[y > 0], y[y > 0])
        h = b.signatures([one, two], 4096)
        assert abs((h[0] == h[1]).mean() - b.similarity(one, two)) < 0.035


def test_signatures_do_not_depend_on_company():
    bags = [b.shingles(b.word_hashes(" ".join(f"w{k % m}" for k in range(60)))) for m in (1, 7, 60)]
    together = b.signatures(bags)
    for k, x in enumerate(bags):
        assert (b.signatures([x]) == together[k]).all()
    assert np.isinf(b.signatures([b.shingles(b.word_hashes(""))])).all() and b.signatures([]).shape == (0, 96)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(80)}" for _ in range(rng.choice([3, 30, 120, 300]))]
        rows += [(len(rows) + k, edited(rng, base, rng.choice([0, 0, 1, 2, 3, 5]))) for k in range(rng.choice([1, 3, 8]))]
    shared = " ".join(f"shared{k}" for k in range(20))
    rows += [(1000 + k, f"{shared} " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(rng.choice([2, 6, 20])))) for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, "!!"), (2003, "!!"), (None, rows[0][1]), (2004, "one two"), (2005, "One, two."), (2006, "a a a a a a a"), (2007, "a a a a a a a a")]
    rng.shuffle(rows)
    assert got(spark, rows) == classes(rows)


def test_a_large_group_whose_members_differ(spark):
    """Copies of one text with many edits each: most pairs lie under the threshold, some links are only between copies."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(150)]
    rows = [(k, edited(rng, base, rng.randrange(1, 6))) for k in range(150)]
    rows += [(500 + k, edited(rng, rows[k][1].split(), 1)) for k in range(0, 150, 10)]
    assert got(spark, rows) == classes(rows)


def test_rows_that_share_an_id_are_one_document(spark):
    one, two = (" ".join(f"{p}{k}" for k in range(40)) for p in "ab")
    assert got(spark, [(5, one), (5, two), (7, one), (9, two), (5, one)]) == {5: 5, 7: 5, 9: 5}


def test_first_of_each_class_stays_with_its_columns(spark):
    t = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, t, 7, "k"), (2, t + " more", 8, None), (None, t, 9, "n"), (3, None, 1, "x")], "doc_id long, text string, id int, key string")
    assert sorted(map(repr, b.keep_first(docs).collect())) == sorted(map(repr, docs.where("doc_id IS NULL OR doc_id <> 2").collect()))
    assert b.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[k] for k in range(41)} == {0} and {found[k] for k in range(100, 140)} == {100} and {found[k] for k in (200, 201, 202)} == {200}
    assert len(found) == 84
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_two_versions_of_a_text_are_dropped_by_one_comparison(spark, monkeypatch):
    """Variants of a text, and as many of a second version that lies under the threshold: members of one aren't compared
    with those of the other, one by one."""
    rng = random.Random(9)
    first = [f"b{k}" for k in range(400)]
    second = [w if k % 30 else f"z{k}" for k, w in enumerate(first)]  # five shingles for each of 14 words
    small = lambda words: edited(rng, words, 1)
    counts = {}
    for n in (20, 40):
        rows = [(0, " ".join(first)), *((1 + k, small(first)) for k in range(n)), (1000, " ".join(second)), *((1001 + k, small(second)) for k in range(n))]
        seen = []

        def near(c, offers, q, real=b._near, seen=seen):
            reach = real(c, offers, q)
            seen.append((offers.count(), reach.count()))
            return reach

        monkeypatch.setattr(b, "_near", near)
        assert got(spark, rows) == classes(rows)
        monkeypatch.undo()
        counts[n] = seen[0]
    assert counts[40][0] > 0 and all(reach <= 4 for _, reach in counts.values())


def test_what_only_one_component_has_is_not_offered(spark, monkeypatch):
    """Variants that share their edits with each other, and one text apart that shares none: nothing can meet."""
    base = [f"b{k}" for k in range(400)]
    rows = [(0, " ".join(base)), (900, " ".join(f"z{k}" if k % 30 == 7 else w for k, w in enumerate(base)))]
    rows += [(1 + k, " ".join(f"v{k % 4}" if j == 14 + 60 * (k % 4) else w for j, w in enumerate(base)) + f" e{k}") for k in range(40)]
    seen = []

    def near(c, offers, q, real=b._near):
        shown = offers if "s" in offers.columns else offers.selectExpr("explode(rare)")
        seen.append((c.count(), shown.count()))
        return real(c, offers, q)

    monkeypatch.setattr(b, "_near", near)
    assert got(spark, rows) == classes(rows)
    assert seen[0][0] >= 40 and seen[0][1] == 0


def test_components_are_joined_by_later_edges(spark):
    edges = [(1, 2), (2, 3), (10, 11), (20, 21), (30, 31)]
    later = [(3, 11), (21, 40), (40, 41), (50, 51), (2, 1)]
    made = lambda e: spark.createDataFrame(e, "a long, b long")
    for new in (later, []):
        whole = {r.id: r.component for r in components(made(edges + new)).collect()}
        assert {r.id: r.component for r in b._joined(components(made(edges)), made(new)).collect()} == whole
