"""The clean corpus: chunks from what a document has, in a fixed order of preference, and issues for the rest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_text, strip, text_of
from .chunking import Packing, packed_chunks
from .corpus import last_wins, status_counts, with_document, without_chunks
from .topics import status_allowed

_PLACE = ("article_number", "clause_number", "point_key")


def _producer(rows: DataFrame, key: str, source: str, text: str, p: Packing, level: Column, index: Column | None = None) -> DataFrame:
    """Packed chunks in the common columns; those of a place that rows lack are blank."""
    given = rows.select(*(c for c in rows.columns if c not in (*_PLACE, "pdf_url")), *(text_of(F.col(c)).alias(c) if c in rows.columns else F.lit("").alias(c) for c in _PLACE), (F.col("pdf_url") if "pdf_url" in rows.columns else F.lit(None).cast("string")).alias("pdf_url"))
    return packed_chunks(given, key, text, source, level, index, p)


def clean_corpus(docs: DataFrame, chunks: DataFrame, key: str, doc_order: str, chunk_order: str, pdfs: DataFrame | None = None, content: str = "content_clean", pdf_urls: str = "pdf_urls", skipped: bool = False, p: Packing = Packing()) -> tuple[DataFrame, DataFrame]:
    """Chunks and issues of the last version of each document.

    A document's chunks come from its existing chunks, else from its content, else from its PDF text (pdfs: key, text,
    pdf_url, issue). A document with none of them is an issue: needs_ocr if it has PDF links, else missing_text. One
    whose content is too short for a chunk has neither. Chunks without a document are dropped; the document's columns
    count.
    """
    d = last_wins(docs, [key], [doc_order]).drop(doc_order)
    meta = d.drop(content, pdf_urls)
    order = W.partitionBy(key).orderBy(chunk_order)
    own = with_document(chunks.select(key, chunk_order, "text", F.col("level").alias("_level"), *(c for c in _PLACE if c in chunks.columns)), meta, key)
    own = own.withColumn("_no", F.row_number().over(order)).withColumnRenamed("text", "_text").drop(chunk_order)
    level = F.coalesce(F.nullif(F.col("_level"), F.lit("")), F.lit("unknown"))
    first = _producer(own, key, "crawler_chunk", "_text", p, level, F.col("_no")).drop("_level", "_no")
    rest = without_chunks(d, first, key)
    filled = clean_text(F.col(content)) != ""
    second = _producer(rest.where(filled).drop(pdf_urls), key, "content_clean", content, p, F.lit("document"))
    bare = rest.where(~filled).drop(content)
    known = pdfs.select(key, F.col("text").alias("_text"), "pdf_url", F.col("issue").alias("_issue")) if pdfs is not None else None
    bare = bare.join(known, key, "left") if known is not None else bare.withColumns({"_text": F.lit(None).cast("string"), "pdf_url": F.lit(None).cast("string"), "_issue": F.lit(None).cast("string")})
    third = _producer(bare.drop(pdf_urls, "_issue"), key, "pdf_text", "_text", p, F.lit("document"))
    urls = F.coalesce(F.size(pdf_urls), F.lit(0))
    why = F.when(urls == 0, "").when(F.lit(skipped), "pdf_extract_skipped").otherwise(F.coalesce("_issue", F.lit("pdf_extract_not_attempted")))
    issues = without_chunks(bare, third, key).select(
        *(c for c in meta.columns), F.when(urls > 0, "needs_ocr").otherwise("missing_text").alias("issue"), urls.alias("pdf_url_count"), why.alias("pdf_extract_issue")
    )
    return first.unionByName(second).unionByName(third), issues


def statistics(chunks: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """name and n: documents by source, chunks, and issues by kind."""
    by_source = chunks.groupBy("source").agg(F.count_distinct(key).alias("n")).select(F.concat(F.lit("documents_from_"), "source").alias("name"), "n")
    total = chunks.agg(F.count("*").alias("n")).select(F.lit("chunks").alias("name"), "n")
    kinds = issues.select(F.explode(F.array_distinct(F.array("issue", "pdf_extract_issue"))).alias("name")).where("name <> ''").groupBy("name").agg(F.count("*").alias("n"))
    return by_source.unionByName(total).unionByName(kinds)


def current_corpus(chunks: DataFrame, status: str, allowed: Iterable[str], scope: str = "current") -> DataFrame:
    """Chunks of an allowed status, marked with the scope of retrieval."""
    return chunks.where(status_allowed(F.col(status), allowed)).withColumn("retrieval_scope", F.lit(scope))


def current_report(chunks: DataFrame, status: str, allowed: Sequence[str]) -> DataFrame:
    return status_counts(chunks, status, status_allowed(F.col(status), allowed))


def with_fallback(text: Column, html: Column, other: Column, least: int = 800) -> Column:
    """other where the text is short or has no source, and other is at least as long."""
    poor = (F.length(text_of(text)) < least) | (strip(text_of(html)) == "")
    return F.when(poor & (text_of(other) != "") & (F.length(text_of(other)) >= F.length(text_of(text))), other).otherwise(text)
