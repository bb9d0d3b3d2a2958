"""Cutting texts into chunks: overlapping windows as one expression, and a greedy packer in Arrow batches."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, strip, text_of, token_estimate
from .structure import Headings, chunk_structs

MAX_CHARS, WINDOW_OVERLAP = 1400, 220


def windows(text: Column, size: int = MAX_CHARS, overlap: int = WINDOW_OVERLAP) -> Column:
    """Overlapping windows of the text with runs of blanks collapsed; the last one ends with the text. Trimmed, and
    none are blank."""
    step = max(size - overlap, 200)

    def cut(t: Column) -> Column:
        last = F.greatest(F.ceil((F.length(t) - size) / step), F.lit(0)).cast("int") * step
        return F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda s: strip(F.substring(t, s + 1, F.lit(size))))

    return F.filter(bound(strip(F.regexp_replace(text_of(text), "[ \t]+", " ")), cut), lambda x: x != "")


def fixed_windows(docs: DataFrame, doc_id: str, text: str, size: int = MAX_CHARS, overlap: int = WINDOW_OVERLAP) -> DataFrame:
    """doc_id, chunk_no from 1, chunk, char_count, token_estimate; no rows for blank texts. Map-only."""
    out = docs.select(doc_id, F.posexplode(windows(F.col(text), size, overlap)).alias("n", "chunk"))
    return out.select(doc_id, (F.col("n") + 1).alias("chunk_no"), "chunk", F.length("chunk").alias("char_count"), token_estimate(F.col("chunk")).alias("token_estimate"))


@dataclass(frozen=True)
class Packing:
    """Sizes in code points."""

    most: int = 1400
    overlap: int = 180
    least: int = 40

    @property
    def step(self) -> int:
        return max(self.most - self.overlap, self.most // 2)


#: Where texts are divided: blank lines, else blanks after the end of a sentence. Fixed values.
PARAGRAPH, SENTENCE = r"\n\s*\n", r"(?<=[.!?。;:])\s+"


def tidy(text: str | None) -> str:
    """Runs of blanks as one, no zero characters, at most one blank line between others."""
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", (text or "").replace("\x00", " "))).strip()


def _windows(text: str, p: Packing) -> list[str]:
    """The text, if it isn't too long, else overlapping windows up to its end, the last of which may hold nothing new."""
    starts = range(0, len(text), p.step) if len(text) > p.most else [0]
    return [x for x in (text[s : s + p.most].strip() for s in starts) if x]


def settled(chunks: list[str], p: Packing = Packing()) -> list[str]:
    """Chunks within the limits: each window of enough characters, with the shorter ones that follow it as far as there
    is room. Others, and short ones before the first, go."""
    pieces = [tidy(x) for c in chunks for x in _windows(tidy(c), p)]
    firsts = [k for k, x in enumerate(pieces) if len(x) >= p.least]
    out = []
    for k, end in zip(firsts, [*firsts[1:], len(pieces)]):
        room = p.most - len(pieces[k])
        joined = [pieces[k]]
        for x in pieces[k + 1 : end]:
            if x and len(x) < room:
                joined.append(x)
                room -= len(x) + 1
        out.append("\n".join(joined))
    return out


def _parts(text: str, p: Packing) -> list[str]:
    """Paragraphs; of a text of one paragraph the sentences; of one sentence slices."""
    by_paragraph, by_sentence = ([x for x in map(str.strip, re.split(by, text)) if x] for by in (PARAGRAPH, SENTENCE))
    slices = [text[s : s + p.most] for s in range(0, len(text), p.most)]
    return next((parts for parts in (by_paragraph, by_sentence) if len(parts) > 1), slices)


def packed(text: str | None, p: Packing = Packing()) -> list[str]:
    """Parts of a text, as many to a chunk as have room together, each chunk beginning with the end of the one before.

    Where a chunk ends is looked up in the running lengths of the parts. A part longer than `most` ends the chunk before
    it, whatever its length, stands in windows of its own, and the chunk after it begins without overlap. Another chunk
    of fewer than `least` characters is lost.
    """
    text = tidy(text)
    if len(text) <= p.most:
        return settled([text], p)
    parts = _parts(text, p)
    ends = [0, *accumulate(len(x) + 1 for x in parts)]  # of each part, with the line end after it
    long = [k for k, x in enumerate(parts) if len(x) > p.most] + [len(parts)]
    out: list[str] = []
    at, overlap = 0, ""
    while at < len(parts):
        stop = long[bisect_left(long, at)]
        if stop == at:
            out += [x for x in _windows(parts[at], p) if len(x) >= p.least]
            at, overlap = at + 1, ""
            continue
        room = ends[at] + p.most + 1 - (len(overlap) + 1 if overlap else 0)
        end = max(at + 1, min(stop, bisect_right(ends, room) - 1))
        chunk = "\n".join(([overlap] if overlap else []) + parts[at:end]).strip()
        cut_off = end == stop < len(parts)
        if cut_off or len(chunk) >= p.least:
            out.append(chunk)
        overlap = out[-1][-p.overlap :].strip() if p.overlap > 0 and out and not cut_off else ""
        at = end
    return settled(out, p)


#: Bytes of text that are packed together, if it isn't one long text.
BATCH_BYTES = 2 << 20


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of at most BATCH_BYTES, or of one text."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)):
        if i > start and size + n > BATCH_BYTES:
            yield texts.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield texts.slice(start)


def pack(text: Column, p: Packing = Packing()) -> Column:
    """array<string> of packed(). What a worker holds besides Spark's batch, of 10,000 rows, is bounded by bytes."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for some in _slices(texts):
                yield pa.array([packed(t.as_py(), p) for t in some], pa.list_(pa.string()))

    return run(text)


def packed_chunks(rows: DataFrame, doc_id: str, text: str, source: str, source_level: Column | None = None, source_index: Column | None = None, p: Packing = Packing()) -> DataFrame:
    """The columns of rows but the text, and: chunk_id (document:source:index:piece, counted from 1), source,
    source_level, text, char_count, token_estimate, needs_ocr. Columns of rows that have one of these names go."""
    index = source_index if source_index is not None else F.lit(1)
    level = source_level if source_level is not None else F.lit(source)
    made = ("chunk_id", "source", "source_level", "text", "char_count", "token_estimate", "needs_ocr")
    kept = [c for c in rows.columns if c != text and c not in made]
    own = F.struct(level.alias("level"), index.cast("int").alias("index"), F.coalesce(F.nullif(F.col(doc_id).cast("string"), F.lit("")), F.lit("unknown")).alias("id"))
    d = rows.select(F.struct(*kept).alias("row") if kept else F.lit(None).alias("row"), own.alias("own"), F.posexplode(pack(F.col(text), p)).alias("piece", "text"))
    return d.select(
        *(F.col("row")[c].alias(c) for c in kept),
        F.format_string("%s:%s:%05d:%03d", "own.id", F.lit(source), "own.index", F.col("piece") + 1).alias("chunk_id"),
        F.lit(source).alias("source"),
        F.col("own.level").alias("source_level"),
        "text",
        F.length("text").alias("char_count"),
        token_estimate(F.col("text")).alias("token_estimate"),
        F.lit(False).alias("needs_ocr"),
    )


def chosen_chunks(docs: DataFrame, doc_id: str, text: str, size: int = MAX_CHARS, overlap: int = WINDOW_OVERLAP, least: int = 80, h: Headings = Headings()) -> DataFrame:
    """Structured chunks (article, clause, point) of documents that have any, else overlapping windows at level
    `fallback`: doc_id, chunk_no (from 1), level, article_number, clause_number, point_key, chunk, char_count. The choice
    is made within the row, so nothing is shuffled. Blank texts give no rows."""
    place = lambda: (F.lit("").alias(k) for k in ("article_number", "clause_number", "point_key"))
    fallback = F.transform(windows(F.col(text), size, overlap), lambda x: F.struct(F.lit("fallback").alias("level"), *place(), x.alias("chunk")))
    chosen = bound(chunk_structs(F.col(text), least, h), lambda s: F.when(F.size(s) > 0, s).otherwise(fallback))
    return docs.select(doc_id, F.posexplode(chosen).alias("n", "x")).select(doc_id, (F.col("n") + 1).alias("chunk_no"), "x.*", F.length("x.chunk").alias("char_count"))
