"""Sequential folds over a query's ranking: near-duplicate suppression, diversification, fragments.

A query's head (at most ``window`` rows, a parameter of the feature) is folded
in one task; the tail never enters a fold and passes by.  Texts are joined to
the head only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from pyspark.sql.window import Window as W

from ..functions import text as T
from .chunking import split_limit


def _share(a: set, b: set) -> float:
    least = min(len(a), len(b))
    return len(a & b) / least if least else 0.0


def deduplicate(ranking: DataFrame, threshold: float = 0.45, n: int = 8, window: int = 200) -> DataFrame:
    """Rows of ranking(query_id, chunk_id, score, rank, text) without near-copies
    of a better kept row (shared n-grams over the shorter set).  Head rows
    without words are dropped; rows beyond the window are kept."""
    head = ranking.where(F.col("rank") <= window).select("query_id", "chunk_id", "rank", T.shingles(F.coalesce("text", F.lit("")), n).alias("grams"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[set] = []
        rows = []
        for row in pdf.sort_values("rank").itertuples():
            g = set(row.grams)
            if g and all(_share(g, o) < threshold for o in kept):
                kept.append(g)
                rows.append((row.query_id, row.chunk_id))
        return pd.DataFrame(rows, columns=["query_id", "chunk_id"])

    keep = head.groupBy("query_id").applyInPandas(fold, ranking.select("query_id", "chunk_id").schema)
    kept = ranking.where(F.col("rank") <= window).join(keep, ["query_id", "chunk_id"], "left_semi")
    out = kept.unionByName(ranking.where(F.col("rank") > window))
    return out.withColumn("place", F.row_number().over(W.partitionBy("query_id").orderBy("rank")))


def mmr(ranking: DataFrame, lam: float = 0.7, n: int = 10, window: int = 60, gram: int = 8) -> DataFrame:
    """Maximal marginal relevance over the head: n picks by lam x normalised score
    - (1 - lam) x largest overlap with a pick, ties to the better rank; then the
    rest of the head in order, then the tail."""
    head = ranking.where(F.col("rank") <= window).select("query_id", "chunk_id", "rank", "score", T.shingles(F.coalesce("text", F.lit("")), gram).alias("grams"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        grams = [set(g) for g in pdf["grams"]]
        s = pdf["score"].to_numpy(float)
        span = s.max() - s.min()
        rel = (s - s.min()) / (span if span else 1.0)
        worst = [0.0] * len(s)
        left, picked = list(range(len(s))), []
        while left and len(picked) < n:
            best = max(left, key=lambda i: (lam * rel[i] - (1 - lam) * worst[i], -i))
            left.remove(best)
            picked.append(best)
            for i in left:
                worst[i] = max(worst[i], _share(grams[i], grams[best]))
        order = picked + left
        return pd.DataFrame({"query_id": pdf["query_id"], "chunk_id": pdf["chunk_id"].to_numpy()[order], "place": range(1, len(order) + 1)})

    schema = ranking.select("query_id", "chunk_id").schema.add("place", IntegerType())
    placed = head.groupBy("query_id").applyInPandas(fold, schema)
    out = ranking.where(F.col("rank") <= window).join(placed, ["query_id", "chunk_id"])
    return out.unionByName(ranking.where(F.col("rank") > window).withColumn("place", F.col("rank").cast("int")))


def fragments(ranking: DataFrame, n: int = 10, limit: int = 250) -> DataFrame:
    """(query_id, rank, chunk_id, text): the first n pieces of at most ``limit``
    words of ranking(query_id, chunk_id, place, text); blank pieces are skipped."""
    # every text that is not blank gives a piece, so the first n of them are enough
    w = W.partitionBy("query_id").orderBy("place")
    head = ranking.where(F.col("text").rlike(r"\S")).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n)
    pieces = head.select("query_id", "chunk_id", "place", F.posexplode(split_limit(T.sanitize(F.coalesce("text", F.lit(""))), F.lit(limit))).alias("piece", "text"))
    w = W.partitionBy("query_id").orderBy("place", "piece")
    return pieces.where(F.trim("text") != "").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("query_id", "rank", "chunk_id", "text")
