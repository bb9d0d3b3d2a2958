from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodestack.llm import suffix_dedup as s


def covered(data, count, m):
    gone = set()
    for i in range(len(data) - m + 1):
        if count[data[i : i + m]] > 1:
            gone.update(range(i, i + m))
    return gone


def brute(texts, m):
    datas = [(t or "").encode() for t in texts]
    count = Counter(x[i : i + m] for x in datas for i in range(len(x) - m + 1))
    out = []
    for x in datas:
        gone = covered(x, count, m)
        starts = [i for i in gone if i - 1 not in gone]
        out.append((len(x), len(gone), len(starts), bytes(b for i, b in enumerate(x) if i not in gone)))
    return out


def got(spark, texts, **more):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = s.repeats_removed(d, **more).collect()
    return [(r.n_bytes, sum(x["e"] - x["s"] for x in r.spans), len(r.spans), bytes(r.kept)) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_two_stages_sort_like_one():
    rng = random.Random(1)
    for _ in range(400):
        letters = rng.choice([b"a", b"ab", b"abc", bytes(range(250, 255)), bytes([0, 254])])
        text = bytes(rng.choice(letters) for _ in range(rng.randrange(60))) + b"\xff"
        order = s.two_stage(text, np.ones(len(text), bool), 100)
        assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))
        wanted = np.array([rng.random() < 0.5 for _ in text])
        order = [i for i in s.two_stage(text, wanted, 100) if wanted[i]]
        assert [text[i:] for i in order] == sorted(text[i:] for i in np.flatnonzero(wanted))


def test_only_smaller_suffixes_are_sorted_directly(monkeypatch):
    text, seen = b"mississippi" * 20 + b"\xff", []
    monkeypatch.setattr(s, "sorted", lambda x, **k: seen.extend(x) or sorted(x, **k), raising=False)
    s.two_stage(text, np.ones(len(text), bool), 300)
    assert all(text[i:] < text[i + 1 :] or i == len(text) - 1 for i in seen) and 0 < len(seen) < len(text)


def test_segments_hold_every_string_once():
    rng = random.Random(2)
    for _ in range(200):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(40))) for _ in range(6)]
        bounds = np.cumsum([0, *map(len, texts)])
        found = s.segments(np.frombuffer(b"".join(texts), np.uint8), bounds, 8, 4)
        places = [(t, i - bounds[t]) for t, a, b, *_ in zip(*found) for i in range(a, b)]
        assert sorted(places) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - 7)]
        keys = {}
        for t, a, b, key, _ in zip(*found):
            for i in range(a, b):
                assert keys.setdefault(texts[t][i - bounds[t] : i - bounds[t] + 8], key) == key


@pytest.mark.parametrize("key_bytes", [1 << 20, 0])
def test_against_brute_force(spark, key_bytes):
    rng = random.Random(3)
    base = ["".join(rng.choice("abé🙂 ") for _ in range(rng.randrange(5, 80))) for _ in range(8)]
    texts = []
    for _ in range(80):
        t = "".join(rng.choice(base)[rng.randrange(4) :][: rng.randrange(60)] for _ in range(rng.randrange(4)))
        texts.append(rng.choice([t, t, t[: len(t) // 2] + "#" + t[len(t) // 2 :], "a" * rng.randrange(60), "xyz" * rng.randrange(20), None, ""]))
    assert got(spark, texts, repeat=12, gram=5, key_bytes=key_bytes) == brute(texts, 12)


def test_one_text_that_repeats_itself(spark):
    texts = ["a" * 30, "".join(f"{k:03}" for k in range(40)), "ab" * 9 + "c"]
    assert got(spark, texts, repeat=12, gram=5) == brute(texts, 12)


def test_a_group_of_copies_and_odd_rows(spark):
    rng = random.Random(5)
    text, near = ("".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(2))
    rows = [(k, text, "x") for k in range(200)] + [(1000 + k, near[:400] + f"<{k:04}>" + near[400:], "x") for k in range(100)]
    rows += [(None, text, "y"), (None, None, "y"), (7, "", "z"), (7, "", "z"), (5000, "own " * 3, "z")]
    d = spark.createDataFrame(rows, "doc_id long, text string, key string")
    r = s.repeats_removed(d).collect()
    assert len(r) == len(rows)
    kept = Counter((x.doc_id, bytes(x.kept)) for x in r)
    assert all(kept[k, b""] == 1 for k in range(200) if k != 7) and kept[None, b""] == 2 and kept[7, b""] == 3
    assert all(len(x.kept) <= 6 for x in r if (x.doc_id or 0) in range(1000, 1100)) and kept[5000, b"own own own "] == 1
    assert s.repeats_removed(d.limit(0)).count() == 0


def test_digest_columns(spark, tmp_path):
    rng = random.Random(6)
    t = "".join(rng.choice("abc") for _ in range(300))
    spark.createDataFrame([(1, t), (2, "x" + t[:250])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in s.query(spark, str(tmp_path)).collect()}
    assert (rows[1].n_bytes, rows[1].n_removed, rows[1].n_spans) == (300, 250, 1)
    assert rows[2].kept_sha256 == hashlib.sha256(b"x").hexdigest()
