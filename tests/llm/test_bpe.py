from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestack.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def both():
    path, pattern = bpe.default_vocabulary()
    content = open(path, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return bpe.codec(content, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def made():
    rng = random.Random(7)
    signs = [*"abcé1²Ⅷ٣漢🙂'.,-=_ \n\t\r", "\x1c", "\x85", " ", " ", "　", "'s", "the", "  ", "<|endoftext|>", "\x00", "́", "�"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    return [*texts, *(c * n for c in ("a", "-", " ", "\n", "é", "🙂", "ab") for n in (1, 7, 64, 65, 1000, 20_000))]


def test_ids_are_those_of_the_rank_file(both):
    codec, reference = both
    for t in made():
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(t), t[:80]
        assert codec.decode_bytes(ids) == t.encode()


def test_offsets_and_split_characters(both):
    codec, reference = both
    for t in made()[:500] + ["漢字🙂é", ""]:
        ids = codec.encode(t)
        starts, ends = codec.offsets(t, ids)
        if not len(starts):
            assert not t
            continue
        assert starts[0] == 0 and ends[-1] == len(t) and (starts < ends).all() and (np.diff(starts) >= 0).all()
        for token, a, b in zip(np.frombuffer(ids, "<u4").tolist(), starts, ends):
            assert reference.decode_single_token_bytes(token) in t[a:b].encode()
        assert "".join(codec.texts(ids)) == t


def test_columns(spark, both):
    codec, reference = both
    rows = [(1, "héllo 🙂"), (2, None), (3, ""), (1, "héllo 🙂"), (None, "x" * 100_000)]
    d = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, ids int")
    encoded = bpe.encode(d)
    got = sorted(((r.doc_id, tuple(r["ids"])) for r in encoded.collect()), key=repr)
    assert got == sorted(((i, tuple(reference.encode_ordinary(t or ""))) for i, t in rows), key=repr)
    back = bpe.decode(encoded)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, spark.createDataFrame([(i, t or "") for i, t in rows], back.schema).collect()))
    for r in bpe.digests(d).collect():
        t = dict(rows)[r.doc_id] or ""
        ids = reference.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert bpe.digests(d.limit(0)).count() == 0


def test_unknown_ids_and_broken_bytes_decode_to_replacements(spark, both):
    codec, _ = both
    half = np.frombuffer(codec.encode("🙂"), "<u4")[:1].tolist()
    d = spark.createDataFrame([(1, half), (2, [10**6]), (3, None), (4, [None])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(d).orderBy("doc_id").collect()] == ["�", "�", "", "�"]


def test_memory_of_pieces_is_bounded(both, monkeypatch):
    codec, reference = both
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    for n in range(50):
        t = " ".join(f"q{n}x{k}" for k in range(8))
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == reference.encode_ordinary(t)
    assert len(codec.known) < 40


def test_other_rank_files(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    reference = tiktoken.Encoding("multi", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    d = spark.createDataFrame([(1, "Größe und façade 漢字")], "doc_id long, text string")
    assert bpe.encode(d, path=path, pattern=P.PATTERN).select(F.col("ids")).first()[0] == reference.encode_ordinary("Größe und façade 漢字")


def test_digests_with_ids(spark):
    rows = [(1, "one two three"), (2, None), (None, "é🙂 " * 9), (3, "x"), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.doc_id, tuple(r.ids)) for r in bpe.encode(docs).collect()}
    got = bpe.digests(docs, with_ids=True).collect()
    assert len(got) == 5 and {(r.doc_id, tuple(r.ids)) for r in got} == want and all(len(r.ids) == r.n_tokens for r in got)
    assert sorted(map(repr, bpe.digests(docs).collect())) == sorted(repr(r) for r in bpe.digests(docs, with_ids=True).drop("ids").collect())
    assert bpe.digests(docs.limit(0), with_ids=True).count() == 0
