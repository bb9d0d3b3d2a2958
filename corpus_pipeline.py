"""A training-data pipeline of five operators over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; stages are written as Parquet to the
shared folder and read again, so a lost executor costs one stage at most, and a stage's table is deleted once the next is
written. All but the last return the columns of documents. In all stages columns beyond those of documents stay, rows
without an id and rows that share one are kept apart by their texts where a verdict depends on them, and an empty table
gives an empty one; what nulls, empty and long texts and repeated rows give is said of each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodestack.functions.session import with_package
from lodestack.llm import bagminhash, bpe, decontaminate, line_dedup, ordinal
from lodestack.llm.common import shared_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects: sound and not toxic. Null and empty texts are scored 0, which is
    judged like any score; repeated rows go alike; without ratings all stay."""
    return ordinal.keep_selected(docs, ordinal.train(docs, table(with_package(spark), sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without blocks of lines that an earlier one has; those that nothing is left of go. n_chars follows. Null
    and empty texts, rows without an id, and repeats within one id stay as they are."""
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates. Rows without an id, and null and empty texts, are like no
    other and stay; rows that share an id stay or go together."""
    return bagminhash.keep_first(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark. Null and empty texts stay; repeated rows, and rows
    without an id, go by their own texts."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text's tokens, their number, and digests of them and of what they decode to. Null texts are empty and
    have no tokens; repeated rows give a row each."""
    return bpe.digests(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("decontamination", contamination),
    ("byte-level BPE", tokens),
]

#: The classifier, the signatures and the merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(with_package(spark), sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _delete(spark, f"{folder}/{k - 1}")
    return docs


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
