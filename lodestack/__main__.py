"""python -m lodestack COMMAND ...: the corpus steps over Parquet tables.

  prepare DOCS CHUNKS OUT      clean chunks, issues and statistics below OUT
  current CHUNKS OUT STATUS... chunks of the given statuses
  report RECORDS               quality summary as JSON
  search CHUNKS QUERY          best chunks of a query
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.session import with_package
from .operators import assembly, quality, retrieval


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lodestack", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, places in (("prepare", ("docs", "chunks", "out")), ("current", ("chunks", "out")), ("report", ("records",)), ("search", ("chunks", "query"))):
        command = commands.add_parser(name)
        for p in places:
            command.add_argument(p)
    commands.choices["current"].add_argument("status", nargs="+")
    commands.choices["search"].add_argument("--top", type=int, default=10)
    for name, default in (("key", "canonical_doc_id"), ("doc-order", "crawl_time"), ("chunk-order", "chunk_id")):
        commands.choices["prepare"].add_argument(f"--{name}", default=default)
    a = parser.parse_args(argv)
    spark = with_package(spark or SparkSession.builder.getOrCreate())
    read = spark.read.parquet
    if a.command == "prepare":
        chunks, issues = assembly.clean_corpus(read(a.docs), read(a.chunks), a.key, a.doc_order, a.chunk_order)
        chunks.write.mode("overwrite").parquet(f"{a.out}/chunks")
        issues.write.mode("overwrite").parquet(f"{a.out}/issues")
        print(json.dumps({r.name: r.n for r in assembly.statistics(read(f"{a.out}/chunks"), read(f"{a.out}/issues"), a.key).collect()}))
    elif a.command == "current":
        assembly.current_corpus(read(a.chunks), "status", a.status).write.mode("overwrite").parquet(a.out)
    elif a.command == "report":
        r = read(a.records)
        urls = {c.removesuffix("_urls"): c for c in ("pdf_urls", "doc_urls", "docx_urls") if c in r.columns}
        print(json.dumps(quality.summary(r, "content_clean", "quality_score", urls, "chunk_count" if "chunk_count" in r.columns else None).first().asDict()))
    else:
        asked = spark.createDataFrame([(0, a.query)], "q int, text string")
        c = read(a.chunks)
        top = retrieval.lexical_topk(c, asked, "chunk_id", "title", "text", "q", "text", a.top).join(c, "chunk_id")
        place = retrieval.citation(F.col("article_number"), F.col("clause_number"), F.col("point_key"))
        for r in top.orderBy("rank").select("rank", "score", "chunk_id", "title", place.alias("citation"), retrieval.preview(F.col("text")).alias("preview")).collect():
            print(json.dumps(r.asDict(), ensure_ascii=False))


if __name__ == "__main__":
    main()
