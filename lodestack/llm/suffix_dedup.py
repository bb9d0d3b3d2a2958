"""Exact substring deduplication: bytes that stand in a repeated string of REPEAT bytes, by sorted suffixes.

A string of REPEAT bytes is filed under the least hash of its GRAM-byte parts, so equal strings are filed alike wherever
they stand. Neighbouring strings mostly have the same least part: a segment is a run of such places with the text that
their strings cover. Segments whose key comes once in the corpus are done with; equal ones count as one with a weight. The
texts of the others meet by key, in blocks of bounded size. The suffixes of a block are sorted in two stages: those smaller
than their successors directly, the rest by a scan over buckets of first bytes, each suffix putting its larger predecessor
at the front of that one's bucket. Adjacent suffixes with a common prefix of REPEAT bytes are repeats.

A key with more segments than fit a block is taken apart string by string (`_single`): an exact way for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table

REPEAT, GRAM = 200, 100
#: Bytes of text that are hashed, and sorted, together; a longer text, or all segments of one key, make a larger block.
HASHED, SORTED = 1 << 16, 1 << 16
#: Bytes of the segments of one key from which it is taken apart.
KEY_BYTES = 32 << 20

_MUL = 6364136223846793005
_INVERSE = pow(_MUL, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes from each place on."""
    n = len(data)
    if len(_powers[0]) < n:
        for k, base in enumerate((_MUL, _INVERSE)):
            _powers[k] = np.multiply.accumulate(np.full(n, base, np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=sums[1:])
    h = (sums[gram:] - sums[: n + 1 - gram]) * _powers[1][: n + 1 - gram]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of the `width` values from each place on."""
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if width > done else h


def segments(data: np.ndarray, bounds: np.ndarray, repeat: int = REPEAT, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first, stop, key, twice) of the runs of places of equal key in texts that lie in `data` between `bounds`;
    twice: the run's least part comes more than once in it, so that it may repeat itself."""
    if len(data) < repeat:
        return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64), np.zeros(0, bool))
    width = repeat - gram + 1
    h = _grams(data, gram)
    low = _least(h, width)
    edge = np.ones(len(low) + 1, bool)
    edge[1:-1] = low[1:] != low[:-1]
    for places in (bounds[:-1], bounds[1:] - repeat + 1):
        edge[places[(places >= 0) & (places <= len(low))]] = True
    at = np.flatnonzero(edge)
    first, stop = at[:-1], at[1:]
    text = np.searchsorted(bounds, first, "right") - 1
    ok = first <= bounds[text + 1] - repeat
    text, first, stop = text[ok], first[ok], stop[ok]
    windows = sliding_window_view(h, width)
    twice = first + windows[first].argmin(axis=1) != stop - 1 + (width - 1 - windows[stop - 1][:, ::-1].argmin(axis=1))
    return text, first, stop, low[first], twice


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch (key, t) in parts of about HASHED bytes, with their bytes and bounds."""
    bounds = np.frombuffer(batch.column(1).buffers()[1], np.int32)[batch.column(1).offset :][: batch.num_rows + 1].astype(np.int64)
    data, a = batch.column(1).buffers()[2], 0
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    while a < batch.num_rows:
        b = min(batch.num_rows, max(a + 1, int(np.searchsorted(bounds, bounds[a] + HASHED, "right")) - 1))
        yield batch.slice(a, b - a), data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        a = b


def _keys(repeat: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, bounds in _blocks(batch):
                *_, key, twice = segments(data, bounds, repeat, gram)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(twice.astype(np.int64) + 1)], ["key", "n"])

    return run


def _packed(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    return first << 32 | length


def _digest(data: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64))


_FOUND = "key long, same long, doc long, span long"


def _found(repeat: int, gram: int):
    """From (doc, t) each segment: its key, a hash of its text (same), and its place and length in bytes (span)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in _blocks(batch):
                text, first, stop, key, _ = segments(data, bounds, repeat, gram)
                end, raw = stop - 1 + repeat, memoryview(data)
                same = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), end.tolist())), np.uint64, len(first))
                doc = part.column(0).to_numpy()[text]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key.view(np.int64), same.view(np.int64), doc, _packed(first - bounds[text], end - first))], [x.split()[0] for x in _FOUND.split(", ")])

    return run


def _single(repeat: int):
    """From (doc, t, spans) each string of `repeat` bytes in the spans, as a segment of one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                at = [i for x in spans for i in range(x >> 32, (x >> 32) + (x & 0xFFFFFFFF) - repeat + 1)]
                for a in range(0, len(at), 10_000):
                    texts = [data[i : i + repeat] for i in at[a : a + 10_000]]
                    cols = [np.array([f(t) for t in texts], np.uint64).view(np.int64) for f in (xxhash.xxh64_intdigest, xxhash.xxh3_64_intdigest)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array([doc] * len(texts), pa.int64()), pa.array([i << 32 | repeat for i in at[a : a + 10_000]], pa.int64())], [x.split()[0] for x in _FOUND.split(", ")])

    return run


_TEXTS = "key long, same long, n long, text binary"


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts (second column) compressed, so that shuffles of whole texts take less of the disk."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(t.as_buffer()) for t in batch.column(1)], pa.binary()), *batch.columns[2:]], batch.schema.names)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc, t, wanted with key, same, n, span) the segments' texts; one that isn't the segment's is passed over."""
    last, unpack = None, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            if doc == last:  # a repeated row
                continue
            last, data, rows = doc, unpack(text.as_buffer()), []
            for w in wanted:
                a = w["span"] >> 32
                t = data[a : a + (w["span"] & 0xFFFFFFFF)]
                if _digest(t) == w["same"]:
                    rows.append((w["key"], w["same"], w["n"], t))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], [x.split()[0] for x in _TEXTS.split(", ")])


def two_stage(text: bytes, wanted: np.ndarray, depth: int) -> list[int]:
    """The places where `wanted` (a boolean for each byte of text), and some after them, in the order of the suffixes that
    begin there, by `depth` bytes at least. `text` is to end with a byte that is larger than all others.

    A suffix is larger than its successor if the first byte that differs from the one after it is. Those that aren't are
    sorted directly. A larger one comes behind all of its first byte whose successors come before its own, so one scan in
    order places them all. A run of wanted places is carried on to the next place that is sorted directly.
    """
    a = np.frombuffer(text, np.uint8)
    n = len(a)
    differs = np.append(a[1:] != a[:-1], True)
    nxt = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]  # last place of the run of equal bytes
    after = np.append(a, a[-1])[nxt + 1]
    larger = a[nxt] > after
    direct = np.minimum.accumulate(np.where(~larger, np.arange(n), n - 1)[::-1])[::-1]
    ends = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    reach = np.zeros(n + 1, np.int64)
    np.add.at(reach, ends, 1)
    np.add.at(reach, direct[ends] + 1, -1)
    active = wanted | (np.cumsum(reach[:-1]) > 0)
    backs: list[list[int]] = [[] for _ in range(256)]
    fronts: list[list[int]] = [[] for _ in range(256)]
    for i in sorted(np.flatnonzero(active & ~larger).tolist(), key=lambda i: text[i : i + depth]):
        backs[text[i]].append(i)
    induced = bytes(np.append(active & larger, False))  # at -1 there is nothing
    out: list[int] = []
    for front, back in zip(fronts, backs):
        for bucket in (front, back):
            for i in bucket:  # the front may grow meanwhile
                if induced[i - 1]:
                    fronts[text[i - 1]].append(i - 1)
        out += front
        out += back
    return out


def repeated(parts: list[tuple[bytes, int]], repeat: int) -> list[list[tuple[int, int]]]:
    """For each segment (text, weight) the (start, end) of its bytes in strings of `repeat` bytes that come elsewhere, in
    these segments or in itself; all of one whose weight is over 1."""
    text = b"".join(t for t, _ in parts) + b"\xff"
    bounds = np.cumsum([0, *(len(t) for t, _ in parts)])
    wanted = np.zeros(len(text), bool)
    for a, b in zip(bounds, bounds[1:]):
        wanted[a : max(a, b - repeat + 1)] = True
    order = np.array(two_stage(text, wanted, repeat))
    order = order[wanted[order]].tolist()
    prefix = [text[i : i + repeat] for i in order]
    hit = np.zeros(len(text), bool)
    equal = np.array([x == y for x, y in zip(prefix, prefix[1:])], bool)
    places = np.array(order, np.int64)
    hit[places[:-1][equal]] = True
    hit[places[1:][equal]] = True
    out = []
    for k, (t, weight) in enumerate(parts):
        at = np.flatnonzero(hit[bounds[k] : bounds[k + 1]]) if weight < 2 else np.arange(len(t) - repeat + 1)
        out.append(_covered(at, repeat))
    return out


def _covered(at: np.ndarray, repeat: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that strings of `repeat` bytes from the places `at`, ascending, cover."""
    if not len(at):
        return []
    gaps = np.flatnonzero(np.diff(at) > repeat)
    return list(zip(at[np.append(0, gaps + 1)].tolist(), (at[np.append(gaps, len(at) - 1)] + repeat).tolist()))


_RUNS = "key long, same long, runs array<int>"


def _sorted(repeat: int):
    """From (key, same, n, text) sorted by key and same: the repeated bytes of each segment, by blocks of whole keys."""

    def judged(block: list[tuple]) -> pa.RecordBatch:
        found = repeated([(t, n) for _, _, n, t in block], repeat)
        rows = [(k, s, [x for run in runs for x in run]) for (k, s, _, _), runs in zip(block, found) if runs]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))], [x.split()[0] for x in _RUNS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if block and row[0] != block[-1][0] and size > SORTED:
                    yield judged(block)
                    block, size = [], 0
                if not block or row[:2] != block[-1][:2]:
                    block.append(row)
                    size += len(row[3])
        if block:
            yield judged(block)

    return run


_KEPT = "n_bytes long, spans array<struct<s:int,e:int>>, kept binary"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, t, runs with span, same, runs) the id, and what is left of the text. Runs count if the segment is there."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
            data = unpack(text.as_buffer())
            runs = []
            for f in found or []:
                a = f["span"] >> 32
                if _digest(data[a : a + (f["span"] & 0xFFFFFFFF)]) == f["same"]:
                    runs += [(a + x, a + y) for x, y in zip(f["runs"][::2], f["runs"][1::2])]
            spans: list[list[int]] = []
            for a, b in sorted(runs):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            edges = [0, *(x for span in spans for x in span), len(data)]
            out.append((len(data), [{"s": a, "e": b} for a, b in spans], b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))))
        kinds = (pa.int64(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])), pa.large_binary())
        cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols[:2], cols[2].cast(pa.binary())], ["id", "n_bytes", "spans", "kept"])


def repeats_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repeat: int = REPEAT, gram: int | None = None, key_bytes: int = KEY_BYTES) -> DataFrame:
    """A row for each row of docs: its id, n_bytes, spans (maximal removed runs of its UTF-8 bytes, array<struct<s,e>>,
    end exclusive) and kept (the other bytes, which may break characters).

    A byte is removed if it is covered by a string of `repeat` bytes that also starts at any other place, in another row or
    in the same one, where matches overlap too. Strings are judged on the input. Null texts are empty ones; texts of fewer
    bytes keep all; repeated rows are copies like any others, and none of a group of copies is kept. Rows without an id, and
    rows that share one, are treated like others. Whole texts are read, whatever their length. Other columns are ignored,
    so their names can't clash; an empty table gives none.

    A segment is brought together with others by its key and its text's hash, and every removal is checked against the
    text it is applied to, so a collision of hashes at most leaves something in.
    """
    gram = gram or max(1, repeat // 2)
    d = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    doc = F.xxhash64("id", "t")
    d2 = d.select(doc.alias("doc"), "t")
    long = d2.where(F.octet_length("t") >= repeat)
    shared = cut(long.mapInArrow(_keys(repeat, gram), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))
    found = cut(long.mapInArrow(_found(repeat, gram), _FOUND).join(shared, "key"))
    groups = cut(found.groupBy("key", "same").agg(F.count("*").alias("n"), F.min(F.struct("doc", "span")).alias("of")))
    length = F.col("of.span").bitwiseAND(F.lit(0xFFFFFFFF))
    large = groups.groupBy("key").agg(F.sum(length).alias("bytes")).where(F.col("bytes") > key_bytes).select("key")
    wanted = groups.join(large, "key", "left_anti").groupBy(F.col("of.doc").alias("doc")).agg(F.collect_list(F.struct("key", "same", "n", F.col("of.span").alias("span"))).alias("wanted"))
    texts = long.mapInArrow(_zipped, "doc long, t binary").join(wanted, "doc").select("doc", "t", "wanted").mapInArrow(_texts, _TEXTS)
    runs = texts.repartition("key").sortWithinPartitions("key", "same").mapInArrow(_sorted(repeat), _RUNS)
    hits = found.join(cut(runs), ["key", "same"]).select("doc", "same", "span", "runs")
    if not large.isEmpty():
        apart = found.join(large, "key").groupBy("doc").agg(F.collect_set("span").alias("spans"))
        each = cut(long.join(apart, "doc").select("doc", "t", "spans").mapInArrow(_single(repeat), _FOUND))
        again = cut(each.groupBy("key", "same").agg(F.count("*").alias("n")).where("n > 1").select("key", "same"))
        hits = hits.unionByName(each.join(again, ["key", "same"]).select("doc", "same", "span", F.array(F.lit(0), F.lit(repeat)).alias("runs")))
    per_doc = hits.groupBy("doc").agg(F.collect_set(F.struct("span", "same", "runs")).alias("found"))
    kind = docs.schema[doc_id].dataType.simpleString()
    out = d.select("id", "t", doc.alias("doc")).mapInArrow(_zipped, f"id {kind}, t binary, doc long").join(per_doc, "doc", "left").select("id", "t", "found").mapInArrow(_kept, f"id {kind}, {_KEPT}")
    return out.withColumnRenamed("id", doc_id)


def query(spark, sf_dir: str) -> DataFrame:
    r = repeats_removed(table(spark, sf_dir, "documents"))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return r.select("doc_id", "n_bytes", n_removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Brute force: every string of REPEAT bytes, counted.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT k, i, md5(b[i:i + {REPEAT - 1}]) AS h FROM (SELECT k, b, unnest(range(1, octet_length(b) - {REPEAT - 2})) AS i FROM d)),
r AS (SELECT k, i FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
g AS (SELECT k, i, sum(fresh) OVER (PARTITION BY k ORDER BY i) AS g FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= {REPEAT} THEN 0 ELSE 1 END AS fresh FROM r)),
s AS (SELECT k, min(i) AS a, max(i) + {REPEAT} AS e FROM g GROUP BY k, g),
u AS (SELECT k, coalesce(lag(e) OVER (PARTITION BY k ORDER BY a), 1) AS x, a AS y, e - a AS n FROM s
  UNION ALL SELECT d.k, coalesce(max(e), 1), octet_length(any_value(b)) + 1, 0 FROM d LEFT JOIN s ON s.k = d.k GROUP BY d.k),
p AS (SELECT u.k, string_agg(CASE WHEN y > x THEN hex(b[x:y - 1]) ELSE '' END, '' ORDER BY x, y) AS hexed, sum(n) AS removed, count(*) - 1 AS spans FROM u JOIN d ON u.k = d.k GROUP BY u.k)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, spans AS n_spans, sha256(unhex(hexed)) AS kept_sha256 FROM d JOIN p USING (k)
"""
