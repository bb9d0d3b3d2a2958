"""Embedding of texts: any model behind an iterator function, loaded once a worker, and a hashing one as the default."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .retrieval import embedding_text, flat_column

DIMENSIONS = 64
_WORD = re.compile(r"\w+")


def hashing_embedder(dimensions: int = DIMENSIONS) -> Callable[[Sequence[str]], np.ndarray]:
    """Signed counts of words and of pairs of neighbours, hashed and of unit length; texts without words are zero."""

    def embed(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), np.float32)
        for row, text in zip(out, texts):
            words = _WORD.findall((text or "").lower())
            hashes = np.array([zlib.crc32(x.encode("utf-8", "replace")) for x in [*words, *map(" ".join, zip(words, words[1:]))]], np.int64)
            if len(hashes):
                np.add.at(row, hashes % dimensions, np.where(hashes >> 16 & 1, 1.0, -1.0).astype(np.float32))
                row /= max(float(np.linalg.norm(row)), 1e-12)
        return out

    return embed


def embed(text: Column, load: Callable[[], Callable[[Sequence[str]], np.ndarray]] = hashing_embedder, batch: int = 64) -> Column:
    """array<float> of each text. load makes the model, once for each task; it is called with up to `batch` texts."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            values = list(texts)
            made = [row for i in range(0, len(values), batch) for row in model(values[i : i + batch])]
            yield pd.Series(made, index=texts.index, dtype=object)

    return run(text)


def collection_rows(chunks: DataFrame, chunk_id: str, title: str, text: str, metadata: Sequence[str], load: Callable = hashing_embedder) -> DataFrame:
    """Rows of a vector collection: id, document, flat metadata, embedding of the text below its title."""
    kinds = dict(chunks.dtypes)
    return chunks.select(
        F.col(chunk_id).cast("string").alias("id"),
        F.col(text).alias("document"),
        *(flat_column(c, kinds[c]).alias(c) for c in metadata),
        embed(embedding_text(F.col(title), F.col(text)), load).alias("embedding"),
    )
