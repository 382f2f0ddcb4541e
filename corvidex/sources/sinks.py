"""Writers: stores, graph, result lines, reports.  All are distributed writes; nothing passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_store(vectors: DataFrame, metadata: DataFrame, folder: str, encoder: dict) -> None:
    """Vectors and metadata as Parquet keyed by chunk_id, and the encoder's description."""
    vectors.write.mode("overwrite").parquet(f"{folder}/vectors")
    metadata.write.mode("overwrite").json(f"{folder}/metadata")
    spark = vectors.sparkSession
    spark.range(1).select(*[F.lit(v).alias(k) for k, v in encoder.items()]).coalesce(1).write.mode("overwrite").json(f"{folder}/encoder")


def graph_store(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{folder}/nodes")
    edges.write.mode("overwrite").parquet(f"{folder}/edges")


def result_lines(lines: DataFrame, path: str) -> None:
    """Nested JSON lines in query order (a range sort, not one task)."""
    lines.orderBy("query_id").write.mode("overwrite").json(path)


def pool_sheet(pooled: DataFrame, texts: DataFrame, path: str, text_chars: int = 1500, context_chars: int = 200) -> None:
    x = pooled.join(texts, "chunk_id").withColumn("text", F.substring("text", 1, text_chars)).withColumn("context", F.substring("context", 1, context_chars))
    x.orderBy("query_id", "best_rank", "chunk_id").write.mode("overwrite").option("header", True).csv(path)


def report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def slow_tasks(timings: DataFrame, threshold: float = 5.0, n: int = 300) -> DataFrame:
    """The slowest tasks above a threshold (a top-k report)."""
    return timings.where(F.col("seconds") >= threshold).orderBy(F.desc("seconds"), "doc_id").limit(n)


def text_list(df: DataFrame, column: str, path: str) -> None:
    df.select(column).orderBy(column).write.mode("overwrite").text(path)
