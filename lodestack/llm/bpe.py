"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A text is split by a pattern; the UTF-8 bytes of each match are written as the characters of a byte table and merged by
rank. The rank file lists tokens, not merges: every split of a token into two tokens is a merge of that token's rank,
and a match that is itself a token stays whole. Decoding puts the tokens' bytes together before it reads characters, so
a character split over tokens comes out whole.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Distinct matches whose ids a worker remembers, and their greatest length; beyond, it forgets all and starts anew.
REMEMBERED, LONGEST = 200_000, 64
#: Tokens of a batch of arrays that go back to Spark at once.
TOKENS_PER_BATCH = 1_000_000
REPLACEMENT = "�".encode()


@functools.cache
def byte_table() -> list[str]:
    """Byte -> character: printable Latin-1 stands for itself, the other bytes for characters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def ascii_pattern(pattern: str) -> str | None:
    """pattern for texts of ASCII characters only, in the faster engine; None if it has other properties than letters and numbers."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    return None if r"\p" in plain else plain


class Codec:
    """Encoder and decoder of one rank file, given as its content."""

    def __init__(self, content: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}
        self.chars = byte_table()
        self.map = {b: c for b, c in enumerate(self.chars)}
        written = {token: self._written(token) for token in ranks}
        merges = [
            (written[token[:i]], written[token[i:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.model = Tokenizer(models.BPE(vocab={written[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.bytes_of = {r: bytes(self._read(w)) for w, r in ((written[t], r) for t, r in ranks.items())}
        self.split = regex.compile(pattern).findall
        plain = ascii_pattern(pattern)
        self.split_ascii = re.compile(plain, re.ASCII).findall if plain else self.split
        self.known: dict[str, bytes] = {}

    def _written(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.map)

    def _read(self, written: str) -> list[int]:
        back = self.__dict__.setdefault("back", {c: b for b, c in enumerate(self.chars)})
        return [back[c] for c in written]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = (self.split_ascii if text.isascii() else self.split)(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, longer = self.known, {}
        if new := list({*pieces}.difference(known)):
            for piece, found in zip(new, self.model.encode_batch([self._written(p.encode("utf-8", "replace")) for p in new], add_special_tokens=False), strict=True):
                (known if len(piece) <= LONGEST else longer)[piece] = np.array(found.ids, "<u4").tobytes()
        if longer:
            return b"".join([known[p] if p in known else longer[p] for p in pieces])
        return b"".join(map(known.__getitem__, pieces))

    def decode_bytes(self, ids: bytes) -> bytes:
        """The tokens' bytes; an id of no token gives the replacement character."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        try:
            return b"".join(map(self.bytes_of.__getitem__, numbers))
        except KeyError:
            return b"".join([self.bytes_of.get(i, REPLACEMENT) for i in numbers])

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Code points that each token covers, ends exclusive; tokens that share a character both cover it."""
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80)  # of each byte, 1-based
        ends = np.cumsum([len(self.bytes_of[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        return (char[starts] - 1 if len(ends) else starts), (char[ends - 1] if len(ends) else ends)

    def texts(self, ids: bytes) -> list[str]:
        """Each token's own text; a character split over tokens comes with the last of them."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        return [reader.decode(self.bytes_of.get(i, REPLACEMENT)) for i in np.frombuffer(ids, "<u4").tolist()]


@functools.lru_cache(maxsize=2)
def codec(content: bytes, pattern: str) -> Codec:
    return Codec(content, pattern)


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of the public rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _shared(df: DataFrame, path: str | None, pattern: str | None):
    """The rank file, read once on the driver (its size doesn't depend on the data), for all workers."""
    here, its = default_vocabulary() if path is None or pattern is None else (path, pattern)
    with open(path or here, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read()), pattern or its


def _ints(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4").astype(np.int32)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """A row for each row of docs: its id, ids array<int>, starts and ends array<int> (code points, ends exclusive).

    Null texts count as empty and have no ids. Texts are encoded whole; repeated rows give a row each; other columns
    are ignored.
    """
    content, by = _shared(docs, path, pattern)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(content.value, by)
        for batch in batches:
            rows, size = [], 0
            names = ["id", "ids", "starts", "ends"]
            types = [batch.schema.field(0).type, *[pa.list_(pa.int32())] * 3]
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                s = t.as_py() or ""
                ids = c.encode(s)
                a, b = c.offsets(s, ids)
                rows.append((i.as_py(), _ints(ids), a.astype(np.int32), b.astype(np.int32)))
                size += len(ids) // 4
                if size >= TOKENS_PER_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), types)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), types)], names)

    return d.mapInArrow(run, f"id {d.dtypes[0][1]}, ids array<int>, starts array<int>, ends array<int>").withColumnRenamed("id", doc_id)


def decode(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """A row for each row: its id, text. Null ids give an empty text; bytes that are no UTF-8, and ids of no token, give U+FFFD."""
    content, by = _shared(encoded, path, pattern)
    d = encoded.select(F.col(doc_id).alias("id"), F.col(ids).cast("array<int>").alias("i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(content.value, by)
        for batch in batches:
            out = [c.decode_bytes(np.array([-1 if y is None else y for y in x.as_py() or []], np.int32).astype("<u4").tobytes()).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["id", "text"])

    return d.mapInArrow(run, f"id {d.dtypes[0][1]}, text string").withColumnRenamed("id", doc_id)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each row of docs: its id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (of the bytes that the ids decode to), and the ids (array<int>) themselves if asked for. Nulls,
    repeats, empty tables and other columns as for encode()."""
    content, by = _shared(docs, path, pattern)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(content.value, by)
        for batch in batches:
            rows, start, size = [], 0, 0
            for at, t in enumerate(batch.column(1), 1):
                ids = c.encode(t.as_py() or "")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode_bytes(ids)).hexdigest(), *([_ints(ids)] if with_ids else [])))
                size += len(ids) // 4
                if at == len(batch) or size >= TOKENS_PER_BATCH and with_ids:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, at - start), *(pa.array(x, k) for x, k in zip(zip(*rows), kinds.values()))], ["id", *kinds])
                    rows, start, size = [], at, 0
        c.known.clear()  # the worker goes on to other stages

    also = ", ids array<int>" if with_ids else ""
    return d.mapInArrow(run, f"id {d.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string{also}").withColumnRenamed("id", doc_id)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
