"""Held-out accuracy and exact parts of the trained operators."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from lodestack.llm import line_crf, ordinal, url_filter


def written(rng, kind):
    words = [f"{rng.choice('bcdfg')}{rng.choice(['an', 'er', 'iti', 'olo'])}{rng.randrange(60)}" for _ in range(rng.randrange(25, 90))]
    lines = [" ".join(words[k : k + 9]).capitalize() + "." for k in range(0, len(words), 9)]
    if kind == 0:
        lines[1:] = [x.upper().replace(" ", "!! ") for x in lines[1:]]
    elif kind == 1:
        lines[0] += " " + " ".join(rng.choice(["awful", "wretch", "vile"]) for _ in range(4))
    return "\n".join(lines)


def labelled(spark, seed, n=600):
    rng = random.Random(seed)
    rows = [(k, g, written(rng, g)) for k in range(n) for g in [rng.choice([0, 1, 2, 2, 2])]]
    docs = spark.createDataFrame([(k, t, "extra") for k, _, t in rows], "doc_id long, text string, selected string")
    ratings = spark.createDataFrame([(k, int(g > 0), int(g == 1)) for k, g, _ in rows], "doc_id long, quality int, toxic int")
    return docs, ratings, {k: g for k, g, _ in rows}


def test_ordinal_held_out(spark):
    docs, ratings, _ = labelled(spark, 1, 2000)
    model = ordinal.train(docs, ratings)
    assert model.thresholds[0] <= model.thresholds[1]
    others, _, grades = labelled(spark, 2, 300)
    got = {r.doc_id: r for r in ordinal.score(others, model).collect()}
    assert sum(got[k].selected == (g == 2) for k, g in grades.items()) >= 290
    mean = [np.mean([got[k].expected_grade for k, g in grades.items() if g == x]) for x in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert all(0 <= r.tail_probability <= r.expected_grade <= 2 for r in got.values())
    kept = ordinal.keep_selected(others, model)
    assert kept.dtypes == others.dtypes and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.selected}


def test_ordinal_is_reproducible_and_bounded(spark):
    docs, ratings, _ = labelled(spark, 3, 120)
    one, two = ordinal.train(docs, ratings), ordinal.train(docs.repartition(7), ratings.repartition(3))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()
    few = ordinal.train(docs, ratings, sample=50)
    assert not (few.weights == one.weights).all()


def test_ordinal_vectors_come_to_the_driver_in_parts(spark, monkeypatch):
    docs, ratings, _ = labelled(spark, 4, 200)
    docs = docs.repartition(9)
    whole = ordinal.train(docs, ratings)

    def refused(self):
        raise AssertionError("the whole sample comes to the driver at once")

    monkeypatch.setattr(type(docs), "toArrow", refused)
    monkeypatch.setattr(ordinal, "PARTS", 3)
    monkeypatch.setattr(ordinal, "ROWS", 7)
    parts = ordinal.train(docs, ratings)
    assert (parts.weights == whole.weights).all() and (parts.thresholds == whole.thresholds).all()


def test_ordinal_likelihood_gradient():
    """The fitted model beats its start on the likelihood that it is fitted on."""
    rows = [(np.array([k % 5, 5 + k % 3], np.int32), np.ones(2, np.float32)) for k in range(300)]
    grades = np.array([min(2, (k % 5) // 2) for k in range(300)])
    model = ordinal.fit(rows, grades, min_docs=1)
    tails = np.array([[1.0, *(1 - ordinal._logistic(model.thresholds - model.weights[n].sum())), 0.0] for n, _ in rows])
    p = (tails[:, :-1] - tails[:, 1:])[np.arange(300), grades]
    assert -np.log(p).mean() < 0.3


def test_ordinal_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "w " * 100_000), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = ordinal.train(docs, none)
    assert [r.selected for r in ordinal.score(docs, model).collect()] == [True] * 4
    nulls = spark.createDataFrame([(1, None, 0), (2, 1, None), (None, 0, 0), (3, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert ordinal.score(docs.limit(0), ordinal.train(docs, nulls)).count() == 0


def test_viterbi_against_all_labellings():
    rng = random.Random(1)
    for _ in range(200):
        field = line_crf.Field(moves=[[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)])
        scores = [rng.gauss(0, 2) for _ in range(rng.randrange(1, 8))]
        total = lambda y: sum(s for s, v in zip(scores, y) if v) + sum(field.moves[a][b] for a, b in zip(y, y[1:]))
        ways = list(itertools.product((0, 1), repeat=len(scores)))
        assert abs(total(field.viterbi(scores)) - max(map(total, ways))) < 1e-9
        weights = [math.exp(total(y)) for y in ways]
        probs, moves = field.expectations(scores)
        for i, p in enumerate(probs):
            assert abs(p - sum(w for w, y in zip(weights, ways) if y[i]) / sum(weights)) < 1e-9
        for a, b in itertools.product((0, 1), repeat=2):
            want = sum(w * sum((s, t) == (a, b) for s, t in zip(y, y[1:])) for w, y in zip(weights, ways)) / sum(weights)
            assert abs(moves[a][b] - want) < 1e-9
    assert line_crf.Field().viterbi([]) == []


def test_repeated_words_against_windows():
    rng = random.Random(2)
    for _ in range(400):
        w = [rng.choice("abc") for _ in range(rng.randrange(50))] if rng.random() < 0.5 else [str(rng.randrange(30)) for _ in range(15)] * rng.randrange(1, 4)
        at = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i : i + 8]), []).append(i)
        assert line_crf.repeated_words(w) == len({p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)})


def test_base_statistics(spark):
    t = "ab  c#\n\nab  c#\n \x0b\x0c\r\nd e<|>$&%*\nab  c#"
    got = line_crf.judge(t, line_crf.Field({"bias": 1.0}))
    assert got[:6] == (8, 21, 10, 2, 0, True)
    assert line_crf.judge(None, line_crf.Field())[:8] == (0, 0, 0, 0, 0, True, 0.0, False)
    d = spark.createDataFrame([(1, None, "a"), (1, "x " * 50_000, "b"), (None, "", "c")], "doc_id long, text string, kept string")
    r = line_crf.assess(d, line_crf.Field({"bias": 1.0}))
    assert r.count() == 3 and r.where("kept").count() == 0 and line_crf.assess(d.limit(0), line_crf.Field()).count() == 0


def test_crf_held_out(spark):
    docs, ratings, _ = labelled(spark, 5)
    model = line_crf.train(docs, ratings)
    others, _, grades = labelled(spark, 6, 300)
    got = {r.doc_id: r for r in line_crf.assess(others, model).collect()}
    assert sum(got[k].kept == (g > 0) for k, g in grades.items()) >= 290
    assert line_crf.train(docs, ratings.where("quality = 1")).weights == {"bias": 1.0}


def test_crf_marks_lines_within_documents(spark):
    """Navigation and licence lines that documents share, between lines of their own: labels change within a document."""
    rng = random.Random(11)
    shared = [f"Home | About | Contact {k} | Help" for k in range(8)] + [f"(c) 20{k} ALL RIGHTS RESERVED ***" for k in range(10, 16)]

    def made(n):
        return [(k, "\n".join(x for line in written(rng, 2).split("\n") for x in ([line, rng.choice(shared)] if rng.random() < 0.4 else [line]))) for k in range(n)]

    of = lambda rows: line_crf.evidence(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, 1) for k, _ in rows], "doc_id long, quality int"))
    train, held = of(made(300)), of(made(200))
    assert 0.1 < np.mean([y == 0 for _, labels in held for y in labels]) < 0.5
    assert line_crf.line_accuracy(line_crf.fit(train), held) >= 0.97


def test_evidence_is_bounded_by_lines(spark):
    """Documents of a thousand one-letter lines: so many as their lines allow, though their characters would allow all."""
    rows = [(k, "\n".join("ab"[j % 2] for j in range(1000))) for k in range(20)]
    ratings = spark.createDataFrame([(k, 1) for k, _ in rows], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = [len(line_crf.evidence(docs, ratings, chars=c)) for c in (10, 5 * (1000 * line_crf.LINE_CHARS + 2000), 10**8)]
    assert counts == [1, 5, 20]


def test_copies_are_no_evidence_of_boilerplate():
    copy = [(h, ["bias"]) for h in (1, 2, 3)]
    assert all(labels == [1, 1, 1] for _, labels in line_crf.labelled([(1, copy)] * 9))
    others = [(1, [(10 + k, ["bias"]), (2, ["bias"])]) for k in range(3)]
    assert [labels for _, labels in line_crf.labelled([(1, copy), *others, (0, [(99, ["bias"])]), (1, [])])] == [[1, 0, 1], *[[1, 0]] * 3, [0]]


def test_crf_gradient_against_differences():
    rng = random.Random(4)
    lines, labels = [[rng.choice("ab"), rng.choice("cd")] for _ in range(6)], [rng.randrange(2) for _ in range(6)]
    field = line_crf.Field({f: rng.gauss(0, 1) for f in "abcd"}, [[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)])

    def likelihood():
        scores = field.emissions(lines)
        total = lambda y: sum(s for s, v in zip(scores, y) if v) + sum(field.moves[a][b] for a, b in zip(y, y[1:]))
        return total(labels) - math.log(sum(math.exp(total(y)) for y in itertools.product((0, 1), repeat=6)))

    by_feature, by_move = line_crf.slopes(field, lines, labels)
    for at, key, got in [(field.weights, f, by_feature.get(f, 0.0)) for f in "abcd"] + [(field.moves[i], j, by_move[i][j]) for i in (0, 1) for j in (0, 1)]:
        at[key] += 1e-5
        up = likelihood()
        at[key] -= 2e-5
        assert abs((up - likelihood()) / 2e-5 - got) < 1e-6
        at[key] += 1e-5


def test_ordinal_gradient_against_differences():
    rng = np.random.default_rng(5)
    score, y, t = rng.normal(0, 2, 40), rng.integers(0, 3, 40), np.array([-0.7, 1.1])
    loss, by_score, by_threshold = ordinal.slopes(score, y, t)
    p = np.diff(np.concatenate([np.zeros((40, 1)), 1 / (1 + np.exp(score[:, None] - t)), np.ones((40, 1))], 1), axis=1)[np.arange(40), y]
    assert np.abs(loss + np.log(p)).max() < 1e-9
    assert np.abs((ordinal.slopes(score + 1e-6, y, t)[0] - ordinal.slopes(score - 1e-6, y, t)[0]) / 2e-6 - by_score).max() < 1e-6
    for k in range(2):
        e = np.eye(2)[k] * 1e-6
        assert abs((ordinal.slopes(score, y, t + e)[0].sum() - ordinal.slopes(score, y, t - e)[0].sum()) / 2e-6 - by_threshold[k]) < 1e-5


def test_samples_are_bounded_by_characters(spark):
    from lodestack.llm.common import within

    rows = spark.createDataFrame([(k, "x" * 100) for k in range(50)] + [(99, None)], "id long, t string")
    assert within(rows, 10**9).count() == 51 and within(rows, 0).count() >= 1
    some = within(rows, 1000).collect()
    assert sum(len(r.t or "") for r in some) == 1000
    hashes = {r.id: r.h for r in rows.select("id", F.xxhash64("id").alias("h")).collect()}
    assert max(hashes[r.id] for r in some) < min(h for i, h in hashes.items() if i not in {r.id for r in some})


def urls(seed, n=800):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        bad = rng.random() < 0.3
        host = f"{rng.choice(['www.', '', 'm.'])}{rng.choice(['cheap', 'best', 'free'])}-{rng.choice(['xx', 'yy', 'deal'])}{rng.randrange(99)}.example" if bad else f"{rng.choice(['www.', 'blog.', ''])}{rng.choice(['thing', 'other', 'some'])}{rng.choice('abcdef')}.example"
        out.append((f"http://{host}.{rng.choice(['com', 'edu'])}/{rng.choice(['en', 'de'])}/{rng.randrange(1000)}", int(bad)))
    return out


def test_trees_held_out_and_expression_agrees(spark):
    model = url_filter.train(spark.createDataFrame(urls(1), "url string, label int"))
    rows = [(k, u) for k, (u, _) in enumerate(urls(2))]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), model, rules={}).collect()}
    assert sum((got[k].verdict == "block") == bool(y) for k, (_, y) in enumerate(urls(2))) >= 0.97 * 800
    feats = spark.createDataFrame(rows, "page_id long, url string").withColumns(url_filter.parts(F.col("url")))
    feats = feats.withColumns(url_filter.features(F.col("url")) | {"suffix_rate": model.suffix_rate(F.col("host"))}).orderBy("page_id").toPandas()
    p = 1 / (1 + np.exp(-model.margins(feats[[*url_filter.FEATURES, "suffix_rate"]].to_numpy(float))))
    assert np.abs(p - [got[k].probability for k in range(800)]).max() < 1e-5


def test_trees_on_hosts_that_they_have_not_seen(spark):
    """Trained on some hosts, judged on others: what counts is the look of a host, not its name."""
    host = lambda u: u.split("/")[2]
    every = urls(3, 3000)
    seen = {h for k, h in enumerate(sorted({host(u) for u, _ in every})) if k % 2}
    model = url_filter.train(spark.createDataFrame([x for x in every if host(x[0]) in seen], "url string, label int"))
    others = [x for x in every if host(x[0]) not in seen]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame([(k, u) for k, (u, _) in enumerate(others)], "page_id long, url string"), model, rules={}).collect()}
    assert len(others) > 500 and sum((got[k] == "block") == bool(y) for k, (_, y) in enumerate(others)) >= 0.97 * len(others)


def test_rates_of_all_suffixes_are_kept(spark):
    rows = [(f"http://a.s{k}/{j}", k % 2) for k in range(300) for j in range(2 + k % 3)] + [("http://a.\"é\\/", 1)]
    model = url_filter.train(spark.createDataFrame(rows, "url string, label int"))
    assert len(model.suffixes) == 301
    hosts = spark.createDataFrame([(f"b.{s}",) for s in [*model.suffixes, "new"]], "host string")
    got = {r.host[2:]: r.v for r in hosts.select("host", model.suffix_rate(F.col("host")).alias("v")).collect()}
    assert got == model.suffixes | {"new": model.other} and len(set(got.values())) > 2
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    assert url_filter.judge(pages, model, rules={}).count() == len(rows)


def test_entropy_feature(spark):
    from collections import Counter

    hosts = ["aab.example", "", "x" * 50, "abcdefgh", "éé🙂a"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(hosts)), "i int, h string").orderBy("i").select(url_filter._entropy(F.col("h"))).collect()]
    for h, g in zip(hosts, got):
        want = -sum(c / len(h) * math.log2(c / len(h)) for c in Counter(h).values()) if h else 0.0
        assert abs(g - want) < 1e-5


def test_rules(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"),
        "HTTP://EXAMPLE.NET/en/1?q#f": ("example.net", "/en/1", "example.net/en/", "allow"),
        "https://m.example.net/EN/": ("m.example.net", "/EN/", "net/", "block"),
        "https://b.example.com/de/": ("b.example.com", "/de/", "example.com/de/", "block"),
        "x://badexample.com/de/": ("badexample.com", "/de/", None, None),
        "x://q.org/fr/a://b": ("q.org", "/fr/a://b", "org/fr/", "allow"),
        "x://net": ("net", "", None, None),
        "x://É.NET#/": ("É.net", "", None, None),
        "no scheme.net/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "://h.net/p\nq?r": ("h.net", "/p\nq", "net/", "block"),
    }
    d = spark.createDataFrame([(k, u, "extra") for k, u in enumerate(cases)], "page_id long, url string, host string")
    model = url_filter.train(spark.createDataFrame([], "url string, label int"))
    for r in url_filter.judge(d, model).collect():
        host, path, rule, verdict = list(cases.values())[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and verdict in (None, r.verdict) and r.verdict in ("allow", "block")
    assert url_filter.judge(d.limit(0), model).count() == 0
