"""Binary attachments: a bounded scan, and text of PDF files where a reader for them is installed."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, most_bytes: int = 20_000_000, glob: str = "*") -> DataFrame:
    """path, length, content of files; content is null, and isn't read, beyond most_bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    small = files.where(F.col("length") <= most_bytes).select("path", "length", "content")
    return small.unionByName(files.where(F.col("length") > most_bytes).select("path", "length", F.lit(None).cast("binary").alias("content")))


def pdf_texts(files: DataFrame, most_pages: int = 80) -> DataFrame:
    """path, text, issue: pdf_too_large, pdf_extract_failed or pdf_empty_text where there is no text, else ""."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            from pypdf import PdfReader
        except ImportError:
            PdfReader = None
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                text, issue = "", "pdf_too_large"
                if content is not None:
                    try:
                        if PdfReader is None:
                            raise RuntimeError("no PDF reader is installed")
                        text = "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages[:most_pages]).strip()
                        issue = "" if text else "pdf_empty_text"
                    except Exception:  # broken files of any kind are an issue of the file
                        issue = "pdf_extract_failed"
                rows.append((path, text, issue))
            yield pd.DataFrame(rows, columns=["path", "text", "issue"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, issue string")


def pdf_of_documents(docs: DataFrame, texts: DataFrame, key: str, urls: str = "pdf_urls", most_urls: int = 1) -> DataFrame:
    """key, text, pdf_url, issue of each document: the first text that isn't empty among those of its first `most_urls`
    different links; else the issue of the first of them, no_pdf_url without any. texts: path (the link), text, issue."""
    d = docs.select(key, F.slice(F.array_distinct(F.filter(F.coalesce(urls, F.array().cast("array<string>")), lambda u: F.trim(u) != "")), 1, most_urls).alias("links"))
    each = d.select(key, F.posexplode("links").alias("n", "path")).join(texts.select("path", "text", "issue"), "path", "left")
    tried = F.struct((F.coalesce(F.col("text"), F.lit("")) == "").alias("empty"), "n", F.coalesce("text", F.lit("")).alias("text"), F.col("path").alias("pdf_url"), F.coalesce("issue", F.lit("pdf_extract_failed")).alias("issue"))
    best = each.groupBy(key).agg(F.min(tried).alias("b")).select(key, "b.text", "b.pdf_url", F.when(F.col("b.empty"), F.col("b.issue")).otherwise("").alias("issue"))
    return d.select(key).join(best, key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"), "pdf_url", F.coalesce("issue", F.lit("no_pdf_url")).alias("issue"))
