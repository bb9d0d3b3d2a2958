from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json

from pyspark.sql import functions as F

from lodestack.llm import warc as w


def b32(x):
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


def expected(rows):
    best = {}
    for p, _, h in rows:
        if p is not None:
            best[h or ""] = max(best.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        raw, first = (h or "").encode(), best.get(h or "")
        revisit = first is not None and p != first and sum((x or "") == (h or "") for _, _, x in rows) > 1
        out.append((p, len(raw), b32(raw), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def got(spark, rows, **more):
    archives, folder = w.archive(spark.createDataFrame(rows, "page_id long, url string, html string"), **more)
    r = w.read_archives(archives, folder)
    return sorted(((x.page, x.size, x.digest, x.kind, x.refers_to) for x in r.collect()), key=repr)


ROWS = [
    (1, "http://a/\r\nX: y é", "<p>é🙂</p>"),
    (5, None, "<p>é🙂</p>"),
    (3, "http://b", "<p>é🙂</p>"),
    (2, "u", None),
    (4, "u", ""),
    (6, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 3),
    (7, "u", "x" * 300_000),
    (None, "u", "<p>é🙂</p>"),
    (None, "u", "alone"),
    (8, "u", "same"),
    (8, "v", "same"),
    (9, "u", "\x00\r\n"),
]


def test_round_trip(spark):
    assert got(spark, ROWS) == expected(ROWS)
    assert got(spark, []) == []


def test_shuffled_join_and_many_archives(spark, monkeypatch):
    monkeypatch.setattr(w, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(w, "ARCHIVE_BYTES", 2000)
    rows = [(k, "u", "same" if k % 3 else f"own {k}") for k in range(90)]
    assert got(spark, rows) == expected(rows)


def test_smaller_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough")]
    kinds = {x[0]: x[3] for x in got(spark, rows, least_bytes=3)}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_normaliser_on_monolithic_and_mixed_streams():
    made = [w.record(k, "u", f"body {k}".encode() * k) for k in range(20)]
    for stream in (gzip.compress(b"".join(made)), b"".join(map(gzip.compress, made)), gzip.compress(b"".join(made[:7])) + gzip.compress(b"".join(made[7:]))):
        out = io.BytesIO()
        index = w.normalise(io.BytesIO(stream).read, out.write)
        assert [i for _, _, i in index] == [f"<urn:page:{k}>" for k in range(20)]
        for (at, n, _), raw in zip(index, made):
            assert gzip.decompress(out.getvalue()[at : at + n]) == raw
        assert gzip.decompress(out.getvalue()) == b"".join(made)
    cut = io.BytesIO()
    assert len(w.normalise(io.BytesIO(gzip.compress(b"".join(made)[:-10])).read, cut.write)) == 19
    assert w.normalise(io.BytesIO(b"").read, cut.write) == []


def test_sidecars_point_at_records(spark):
    archives, folder = w.archive(spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("sha", F.lit(1)))
    n = 0
    for a in archives.collect():
        data = open(a["path"], "rb").read()
        for line in open(a["index"]):
            e = json.loads(line)
            assert w.fields(gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]).partition(w.END)[0])["warc-record-id"] == e["id"]
            n += 1
    assert n == len(ROWS)


def test_damaged_streams():
    made = [w.record(k, "u", f"body {k}".encode()) for k in range(6)]
    packed = gzip.compress(b"".join(made))
    no_length = made[2].replace(b"Content-Length: " + str(len(made[2].partition(w.END)[2]) - 4).encode(), b"Content-Length: x1")
    assert no_length != made[2]
    cases = [
        (packed, 6, []),
        (packed + b"\0" * 100, 6, []),
        (packed + b"not gzip at all", 6, ["not gzip"]),
        (packed[:-20], 5, ["cut off", "unfinished"]),
        (b"plain text", 0, ["not gzip"]),
        (gzip.compress(b"".join([*made[:2], no_length, *made[3:]])), 5, ["no length"]),
        (gzip.compress(b"no record"), 0, ["unfinished"]),
    ]
    for stream, n, said in cases:
        damage: list[str] = []
        found = w.normalise(io.BytesIO(stream).read, io.BytesIO().write, damage=damage)
        assert (len(found) >= n - (stream == packed[:-20]), damage) == (True, said), said
    assert w.parsed(w.record(1, "u", b"x", 2).replace(b"Content-Length: 1\r\n", b"Content-Length: ?\r\n"))["size"] is None


def read_back(stream, damage):
    return [w.fields(r.partition(w.END)[0])["warc-record-id"] for r in w.records(iter([stream[k : k + 1000] for k in range(0, len(stream), 1000)]), damage)]


def test_wrong_lengths_cost_no_other_record(monkeypatch):
    made = [w.record(k, "u", f"body {k} ".encode() * 400) for k in range(5)]
    true = len(made[1].partition(w.END)[2]) - 4
    others = [f"<urn:page:{k}>" for k in (0, 2, 3, 4)]
    body = made[1].partition(w.END)[2]
    for wrong in (999_999_999, true + 1, true - 1, 10, 0, true + len(made[2]), body.find(w.END)):
        stream = b"".join([made[0], made[1].replace(f"\r\nContent-Length: {true}".encode(), f"\r\nContent-Length: {wrong}".encode()), *made[2:]])
        for hold in (1 << 20, 5000):
            monkeypatch.setattr(w, "HOLD_BYTES", hold)
            damage: list[str] = []
            found = read_back(stream, damage)
            if wrong == true + len(made[2]):  # ends where a record ends, and nothing but its length speaks against it
                assert found in ([others[0], "<urn:page:1>", *others[2:]], others)
            else:
                assert (found, damage) == (others, ["wrong length"]), wrong


def test_long_records_and_records_inside(monkeypatch):
    monkeypatch.setattr(w, "HOLD_BYTES", 2000)
    inner = w.record(7, "u", b"inside")
    bodies = [b"x" * 50_000, b"\nWARC/1.1\r\n\r\n" * 500, b"", b"a" * 100 + w.END + b"WARC/1.1\r\nno length\r\n\r\n" + b"b" * 9000]
    made = [w.record(k, "u", b) for k, b in enumerate(bodies)]
    damage: list[str] = []
    assert read_back(b"\r\n\r\n".join(made), damage) == [f"<urn:page:{k}>" for k in range(4)] and damage == []
    monkeypatch.setattr(w, "HOLD_BYTES", 1 << 20)
    assert read_back(w.record(1, "u", inner * 3) + inner, damage) == ["<urn:page:1>", "<urn:page:7>"] and damage == []


def test_not_all_is_held_for_a_wrong_length(monkeypatch):
    monkeypatch.setattr(w, "HOLD_BYTES", 100_000)
    taken = 0

    def pieces():
        nonlocal taken
        yield w.record(0, "u", b"x").replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9999999")
        for k in range(1, 3000):
            taken += 1
            yield w.record(k, "u", b"y" * 1000)

    damage: list[str] = []
    r = w.records(pieces(), damage)
    next(r)
    assert taken < 150 and sum(1 for _ in r) == 2998 and damage == ["wrong length"]
    damage = []
    assert read_back(b"WARC/1.1\r\n" + b"x: y\r\n" * 400_000 + w.record(1, "u", b""), damage) == ["<urn:page:1>"] and damage == ["no header"]
