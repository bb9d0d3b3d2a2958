from __future__ import annotations

import math
import random
import re
import string
from collections import Counter

from pyspark.sql import functions as F

from lodestack.llm import secrets as s


def brute(text):
    text = text or ""
    base = [(m.start(), k, m.end()) for k, name in enumerate(s.BASE) for p, g, n in [s.BASE[name]] for m in re.finditer(p, text) if len(m[g]) >= n]
    high = set()
    masked = text
    for p, n in s.ALLOWED_WORDS:
        masked = re.sub(p, " " * n, masked)
    for m in re.finditer(s.CANDIDATE, masked):
        v = m[0]
        if not re.search("[0-9]", v) or not re.search("[A-Za-z]", v) or any(re.search(p, v) for p in s.ALLOW):
            continue
        for i in range(len(v) - s.WINDOW + 1):
            w = v[i : i + s.WINDOW]
            bits = s._plogp(s.WINDOW) - sum(s._plogp(c) for c in Counter(w).values())
            least = s.HEX_BITS if re.fullmatch("[0-9a-fA-F]+", w) else s.WIDE_BITS
            if re.search("[0-9]", w) and re.search("[A-Za-z]", w) and bits >= round(least * s.WINDOW * 1e6):
                high.update(range(m.start() + i, m.start() + i + s.WINDOW))
    for a, _, b in base:
        high -= set(range(a, b))
    parts = [p for p in high if p - 1 not in high]
    ends = [p + 1 for p in high if p + 1 not in high]
    return sorted(base), sorted(base + [(a, 3, b) for a, b in zip(sorted(parts), sorted(ends)) if b - a >= (s.PART if base else 1)])


def got(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [([tuple(x) for x in r.base], [tuple(x) for x in r.spans]) for r in s.scan(d).orderBy("doc_id").collect()]


def test_planted(spark):
    texts = [
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
        "éé🙂 PASSWORD:abcdefgh x",
        "secret: short",
        "AKIAABCDEFGHIJKL and AKIAABC",
        "f" * 31 + " " + "0" * 32,
        "ſecret=abcdefgh toKen=abcdefgh api_key='abcd.efg-h' apikey=abcdefgh",
        "key Zx9+Qw3rT7uP1aSd5fGh8jKl2ZxC4vBn6M end",
        "id 123e4567-e89b-12d3-a456-426614174000",
        "https://example.org/2024/some-path/of-words/and-more",
        "tokens token token=token=token=aaaaaaaa",
        None,
        "",
    ]
    assert got(spark, texts) == [brute(t) for t in texts]
    assert got(spark, texts)[6][1] and not got(spark, texts)[7][1] and not got(spark, texts)[8][1]


def test_random_texts_against_brute_force(spark):
    rng = random.Random(5)
    pieces = [*"ab \n=:\"'é🙂", "token", "api_key", "Secret", "AKIA", "passwd", "0f", "deadbeef", "X9-/+_="]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(120))) for _ in range(150)]
    texts += ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(rng.randrange(20, 300))) for _ in range(30)]
    texts += ["".join(rng.choice("0123456789abcdef" * 3 + "a" * k + " ") for _ in range(300)) for k in range(0, 60, 10)]
    assert got(spark, texts) == [brute(t) for t in texts]


def test_parts_outside_of_base_spans_and_allowed_words(spark):
    key, hexes = "Zx9+Qw3rT7uP1aSd5fGh8jKl2ZxC4vBn6M", "0a1b2c3d4e5f67788990aabbccddeeff"
    texts = [f"AKIAABCDEFGHIJKL/{key}", f"{key}_{hexes}_{key}", f"/example-app/{key}", f"{key}abcdefghijklm0123456789{key}"]
    found = got(spark, texts)
    assert found == [brute(t) for t in texts]
    assert [len([x for x in spans if x[1] == 3]) for _, spans in found] == [1, 2, 1, 2]


def test_time_in_proportion_to_length(spark):
    """Many matches, and a candidate of many windows with gaps, in one text: twice as long, not four times the time."""
    import time

    def took(n):
        rng = random.Random(1)
        runs = " ".join("0123456789abcdef"[k % 16] * 32 for k in range(n)) + " secret=" + "abc12345 " * n
        wide = "".join("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(30)) + "a" * 40 for _ in range(n // 10))
        d = spark.createDataFrame([(1, runs + wide)], "doc_id long, text string")
        s.scan(d).collect()
        began = time.time()
        s.scan(d).collect()
        return time.time() - began

    took(100)
    assert took(32_000) < 3 * took(16_000) + 1


def test_entropy_by_increments(spark):
    v = "aB3" * 8 + "Zx9+Qw3rT7uP1aSd5fGh8jKl"
    spans = spark.createDataFrame([(v,)], "v string").select(s._windows(F.col("v"))).first()[0]
    entropy = lambda w: -sum(c / len(w) * math.log2(c / len(w)) for c in Counter(w).values())
    good = [i for i in range(len(v) - s.WINDOW + 1) if entropy(v[i : i + s.WINDOW]) >= s.WIDE_BITS]
    assert [tuple(x) for x in spans] == [(good[0], good[-1] + s.WINDOW)]


def test_long_text_and_clashing_columns(spark):
    d = spark.createDataFrame([(1, "x y " * 100_000 + "AKIA" + "A" * 12, 1, 2)], "doc_id long, text string, base int, high int")
    r = s.scan(d).first()
    assert [tuple(x) for x in r.spans] == [(400_000, 1, 400_016)]
    assert s.scan(d.limit(0)).count() == 0


def test_plain_parts_are_the_allowed_shape(spark):
    rng = random.Random(8)
    values = ["".join(rng.choice("aZ09/_-+") for _ in range(rng.randrange(12))) for _ in range(3000)] + ["", "/", "a/b", "/a1/2345/", "a/b//", "//a/b", "a-12345", "1/a"]
    d = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in d.select(s.plain_parts(F.col("v"))).collect()] == [bool(re.search(s.ALLOW[1], v)) for v in values]


def test_a_path_of_a_million_segments(spark):
    """A repeated group of a pattern would take a stack frame for each segment."""
    texts = ["k1/" * 1_000_000 + "k", "x-1_" * 250_000 + "=", "k1/" * 100_000 + "Zx9+Qw3rT7uP1aSd5fGh8jKl2ZxC4vBn6M"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = [r.spans for r in s.scan(d).orderBy("doc_id").collect()]
    assert spans[0] == [] and [x["k"] for x in spans[2]] == [3] and spans[2][0]["e"] == len(texts[2])
