"""Incremental ingestion: an extra beside the batch build, not a capability of the reference.

New files of a folder are cleaned and chunked once each: a file stream with a
checkpoint and an available-now trigger does what a content cache does in a
batch build.  Late rows of an event table are counted in watermarked windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators.chunking import chunk_documents


def ingest_texts(spark: SparkSession, source: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Text files not seen before -> chunk rows in Parquet; ends when all are worked off."""
    files = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(source)
    docs = files.select(F.col("_metadata.file_path").alias("doc_id"), T.clean(F.col("value")).alias("text"))
    return chunk_documents(docs).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their value a type and window; rows later than ``late`` are dropped by the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
