"""Inverted index, pivots, keywords in one pass, forgotten lines: against plain forms of the same rules."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from lodestack.functions import text
from lodestack.operators import corpus, lexical, neighbours, retrieval, topics


def test_index_gives_what_a_scan_gives_and_scores_few(spark):
    rng = random.Random(1)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiouáđ" for c in ("n", "rt", "st", "x")]
    rows = [(k, rng.choice([None, "", rng.choice(vocabulary)]), " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for k in range(300)]
    asked = [(k, " ".join((rows[k * 7][2]).split()[3:15])) for k in range(20)] + [(50, "a"), (51, "ba"), (52, ""), (53, "zzz qqq"), (54, rows[3][2][:9]), (55, None)]
    # copies of a passage, so that its k-th score is high
    rows += [(1000 + k, "", f"{asked[2][1]} {asked[5][1]} own {k}") for k in range(6)] + [(None, "t", asked[5][1]), (7, "again", rows[7][2])]
    chunks = spark.createDataFrame(rows, "c long, title string, body string")
    queries = spark.createDataFrame(asked, "q long, text string")
    for title in ("title", None):
        args = (chunks, queries, "c", title, "body", "q", "text")
        plain = sorted(retrieval.lexical_topk(*args, k=3).collect(), key=repr)
        postings = lexical.index(chunks, "c", title, "body")
        assert sorted(retrieval.lexical_topk(*args, k=3, postings=postings).collect(), key=repr) == plain
    one = queries.where("q IN (2, 5)")
    pairs, _ = retrieval.lexical_pairs(chunks, one, "c", None, "body", "q", "text", 3, lexical.index(chunks, "c", None, "body"))
    assert 4 * pairs.rows.count() < 2 * len(rows)
    plan = retrieval.lexical_topk(chunks, one, "c", None, "body", "q", "text", 3, lexical.index(chunks, "c", None, "body"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert retrieval.lexical_topk(chunks.limit(0), queries, "c", None, "body", "q", "text", postings=lexical.index(chunks.limit(0), "c", None, "body")).count() == 0


def test_grams_are_told_apart():
    sizes = (1, 2, 3)
    texts = ["", "a", "ab", "abc", "abcd", "\x00\x00", "\U0010ffff" * 4, "aaaa"]
    for t in texts:
        want = {t[i : i + n] for n in sizes for i in range(len(t) - n + 1)}
        assert len(lexical.grams_of(t, sizes)) == len(want)


def test_pivots_give_what_a_scan_gives_and_compare_few(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], 30, axis=0) + rng.normal(scale=0.02, size=(600, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(k, v.astype("float32").astype(float).tolist()) for k, v in enumerate(x)] + [(1000, x[5].tolist()), (1001, [0.0] * 16), (1002, [2.0] + [0.0] * 15)]
    v = spark.createDataFrame(rows, "id long, e array<double>")
    asked = v.where("id % 25 = 0").select(F.col("id").alias("q"), F.col("e").alias("x"))
    plain = sorted(retrieval.vector_topk(v, asked, "id", "e", "q", "x", 7).collect())
    assert sorted(retrieval.vector_topk(v, asked, "id", "e", "q", "x", 7, pivots=24).collect()) == plain
    score = F.round(retrieval.dot(F.col("x"), F.col("e")), 6)
    unit = v.where("id < 1000")
    pairs, _ = neighbours.neighbours(unit, asked.where("q < 1000"), "id", "e", "q", "x", 7, score, 24)
    assert pairs.count() < 0.15 * 24 * 600
    few = sorted(retrieval.vector_topk(v.limit(3), asked, "id", "e", "q", "x", 7, pivots=2).collect())
    assert few == sorted(retrieval.vector_topk(v.limit(3), asked, "id", "e", "q", "x", 7).collect())
    assert retrieval.vector_topk(v.limit(0), asked, "id", "e", "q", "x", 7, pivots=2).count() == 0


def test_vectors_are_compared_in_blocks(spark):
    """As by the products added up in order; null, short and long vectors too."""
    rng = np.random.default_rng(6)
    rows = [(k, x.tolist()) for k, x in enumerate(rng.normal(size=(900, 8)))] + [(2000, None), (2001, []), (2002, [1.0]), (2003, [1.0] * 12), (2004, [3.0, None, 1.0]), (2005, [0.5] * 8), (2006, [0.5] * 8)]
    v = spark.createDataFrame(rows, "id long, e array<double>").repartition(5)
    asked = v.where("id % 90 = 0 or id >= 2000").select(F.col("id").alias("q"), F.col("e").alias("x"))
    score = F.round(retrieval.dot(F.col("e"), F.col("x")), 6)
    plain = retrieval.best(v.crossJoin(asked).select("q", "id", score.alias("score")), ["q"], [F.desc("score"), F.asc("id")], 7).select("q", "rank", "id", "score")
    assert sorted(map(tuple, retrieval.vector_topk(v, asked, "id", "e", "q", "x", 7).drop("distance").collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    pairs = neighbours.nearest(v, asked, "id", "e", "q", "x", 7).where("q < 900")
    assert pairs.count() < 0.5 * 10 * len(rows)  # a scan made a row of each pair


def test_keywords_in_one_pass(spark):
    rng = random.Random(3)
    keywords = ["ab", "abc", "bcd e", "hợp đồng", "VAT", "vat", "thu", "long word", "b", "é", "a.b", "🙂x", "_x"]
    letters = ["a", "b", "c", "d", " ", " ", "e", "VAT", "hop dong", "thu", "long word", ".", "_", "7", "é", "🙂", "x", "̃", "़"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(400)] + ["", "abc", "VAT,"]
    found = topics.Automaton(keywords)
    import regex

    for t in map(topics.normalized, texts):
        want = []
        for i, k in enumerate(map(topics.normalized, keywords)):
            w = topics._WORD
            if regex.search(rf"(?<!{w}){regex.escape(k)}(?!{w})" if topics.is_code(k) else regex.escape(k), t):
                want.append(i)
        assert found(t) == want
    d = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "id int, body string, held int")
    m = topics.match_topics(d, ["body"], [topics.Topic("all", "All", tuple(keywords))])
    assert m.columns[:3] == ["id", "body", "held"] and m.where("size(topic_labels) > 0").count() == sum(bool(found(topics.normalized(t))) for t in texts)
    assert topics.match_topics(d, ["body"], []).where("size(matched_keywords) > 0").count() == 0


def test_whole_words_as_the_engine_has_them(spark):
    """\\w of the regular expressions that the automaton stands for."""
    points = [*range(0x20, 0x3000), *range(0xA000, 0xAC10), *range(0xFE00, 0x10300)]
    d = spark.createDataFrame([(chr(c),) for c in points if not 0xD800 <= c < 0xE000], "c string")
    import regex

    word = regex.compile(topics._WORD)
    differ = [r.c for r in d.select("c", F.col("c").rlike(r"(?U)^\w$").alias("w")).collect() if r.w != bool(word.match(r.c))]
    assert len(differ) < 0.01 * len(points)  # the two know different versions of Unicode


def test_lines_forgotten(spark):
    rng = random.Random(4)

    def plain(lines, most):
        seen, out = set(), []
        for x in lines:
            if x not in seen:
                out.append(x)
                seen.add(x)
                if len(seen) > most:
                    seen.clear()
        return out

    for most in (1, 3, 10):
        given = [[rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(90))] for _ in range(60)]
        d = spark.createDataFrame([(x,) for x in given], "l array<string>")
        assert [r[0] for r in d.select(text.unrepeated(F.col("l"), most)).collect()] == [plain(x, most) for x in given]
    long = [f"l{k % 2500}" for k in range(9000)]
    d = spark.createDataFrame([("\n".join(long),)], "t string")
    assert d.select(text.clean_document(F.col("t"))).first()[0].split("\n") == plain(long, 2000)


def test_known_rows_of_any_name(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "known int, k string")
    assert [tuple(r) for r in corpus.without_known(rows, spark.createDataFrame([("a",)], "k string"), [("k", "k")]).collect()] == [(2, "b")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_date_is_read_once_for_a_row(spark):
    from lodestack.streaming import incremental

    d = spark.createDataFrame([("1/2/2024",), ("2024-01-31",), ("",), ("31/2/2024",)], "t string")
    recent = incremental.since(d.select(F.reverse("t").alias("day")), F.lit("2024-02-01"), ["day"])
    assert _plan(recent).count("reverse(t") <= 2  # in the test, and in the row that is kept
    assert sorted(r[0] for r in incremental.since(d.withColumnRenamed("t", "day"), F.lit("2024-02-01"), ["day"]).collect()) == ["", "1/2/2024", "31/2/2024"]


def test_lines_are_collapsed_in_one_pass_over_the_text(spark):
    d = spark.createDataFrame([("a   b\r\n\tc\x85\x0bd \r\r e  \n a b",)], "t string")
    cleaned = d.select(text.clean_document(F.col("t")).alias("x"))
    assert "lambdafunction(trim(regexp_replace" not in _plan(cleaned) and cleaned.first()[0] == "a b\nc d\ne"


def test_few_texts_are_tried_for_wide_characters(spark):
    d = spark.createDataFrame([("Đé 한 ẹ́ ೋ",)], "t string").select(text.normalize_for_match(F.col("t")).alias("x"))
    assert _plan(d).count("-\\x{10FFFF}]") == 1 and d.first()[0] == topics.normalized("Đé 한 ẹ́ ೋ")


def test_a_text_is_read_once_for_all_queries_and_a_gram_has_one_row_in_a_block(spark):
    chunks = spark.createDataFrame([(k, "one two three") for k in range(50)], "c long, body string").coalesce(1)
    queries = spark.createDataFrame([(1, "two three"), (2, "one")], "q long, text string")
    assert lexical.index(chunks, "c", None, "body").count() == 1 + len("one two three") - 2
    found = retrieval.lexical_topk(chunks, queries, "c", None, "body", "q", "text", 2)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted(map(tuple, found.collect())) == [(1, 1, 0, 60), (1, 2, 1, 60), (2, 1, 0, 51), (2, 2, 1, 51)]
