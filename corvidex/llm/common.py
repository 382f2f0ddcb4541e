"""Shared pieces of the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, table  # noqa: F401

#: A side is broadcast only if its table on disk is smaller than this.
BROADCAST_BYTES = 8 << 20
#: And only up to so many rows, since sorted ids take far less room on disk than in memory.
BROADCAST_ROWS = 500_000


def big(c: str) -> Column:
    """An id column as bigint; malformed ids become null rather than failing."""
    return F.expr(f"try_cast(`{c}` as bigint)")


def chunk_texts(spark: SparkSession, base: str, *more: str) -> DataFrame:
    """(chunk_id bigint, texto, ...) of every stored row; repeated deliveries
    stay in (they are equal) and are removed where rows are small."""
    return table(spark, base, "chunks").select(big("chunk_id").alias("chunk_id"), "texto", *more).where("chunk_id is not null")


def size_on_disk(df: DataFrame) -> int:
    """Bytes of the folders behind a materialised table: one call a folder."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return total


def small(df: DataFrame, limit: int = 0) -> DataFrame:
    """Broadcast hint for a materialised table, only if its measured size and rows allow."""
    return F.broadcast(df) if size_on_disk(df) <= (limit or BROADCAST_BYTES) and df.count() <= BROADCAST_ROWS else df


def once(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows of df, where rows of different keys differ anyway: only keys are
    counted, and only the rows of repeated keys are exchanged.  Null keys stay."""
    twice = materialise(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows_")).where("n_rows_ > 1").select(key), "twice")
    if twice.isEmpty():
        return df
    return df.join(small(twice), key, "left_anti").unionByName(df.join(small(twice), key, "left_semi").distinct())


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer over uint64 (finaliser of the public splitmix64 generator)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
