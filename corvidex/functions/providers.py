"""Interfaces to models and their deterministic stand-ins.

A real encoder, re-ranker or recogniser is passed as a factory that is called
once a worker; without one the stand-ins keep every plan runnable and testable.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T


def hashing_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Signed feature hashing of words, unit length: texts sharing words are near."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = zlib.crc32(w.encode())
                out[i, h % dim] += 1.0 if h >> 31 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=out, where=n > 0)

    return encode


def encode_texts(df: DataFrame, id_col: str, text_col: str, factory: Callable[[], Callable[[list[str]], np.ndarray]] = hashing_encoder) -> DataFrame:
    """(id_col, embedding): one encoder a worker, Arrow batches in, vectors out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = factory()
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "embedding": list(encode(b[text_col].fillna("").tolist()))})

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, embedding array<float>")


def overlap_scores(pairs: DataFrame) -> DataFrame:
    """Stand-in re-ranker: share of the query's tokens that the text holds.  pairs(query_id, chunk_id, query, text)."""
    q, t = F.array_distinct(T.tokenize("query")), F.array_distinct(T.tokenize(F.coalesce("text", F.lit(""))))
    return pairs.select("query_id", "chunk_id", F.when(F.size(q) > 0, F.size(F.array_intersect(q, t)) / F.size(q)).otherwise(0.0).alias("ce_score"))
