"""Problem 6: one ranking from several differently-scaled scores.

Method: robust rank aggregation.  Within a query each channel's scores become
normalised ranks, so no scale or outlier counts.  For each item the ranks are
sorted and each is judged by the beta distribution of an order statistic (how
likely so good a rank by chance, a list's weight standing for its number of
lists); the smallest probability, corrected for the number of lists, is the
item's significance, by which items are ranked.  The re-ranker has its share
against the other channels together: the two significances are blended on the
log scale.

Defined cases: null and NaN scores are no score; equal scores share their mean
rank; a channel at weight 0 is off; an item absent from a list has the last
rank there; repeated rows count once; remaining ties go to the smaller id.
A query without a configuration uses DEFAULT_WEIGHTS.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import big, table

OTHERS = ("dense_a", "dense_b", "bm25", "grafo")
DEFAULT_WEIGHTS = {"bm25_weight": 0.5, "graph_weight": 0.0, "rerank_blend": 0.5}

_lgamma = np.vectorize(lgamma, otypes=[float])


def beta_cdf(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 120) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction (modified Lentz), element-wise."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    inner = (z > 0) & (z < 1)
    zi = np.where(inner, z, 0.5)
    tiny = 1e-300
    c, d = np.ones_like(zi), 1 - (p + q) * zi / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps + 1):
        for num in (m * (q - m) * zi / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * zi / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(zi) + q * np.log1p(-zi)) / p
    val = np.where(inner, front * h, np.where(z >= 1, 1.0, 0.0))
    return np.clip(np.where(swap, 1 - val, val), 0.0, 1.0)


def significance(ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Corrected minimum of the order-statistic probabilities.

    ``ranks`` n x m in (0, 1]; ``weights`` n x m, 0 where a list is off.
    Weights are scaled to sum to the number of lists that are on.
    """
    on = weights > 0
    lists = on.sum(axis=1)
    total = weights.sum(axis=1)
    scaled = weights * np.divide(lists, total, out=np.zeros_like(total), where=total > 0)[:, None]
    order = np.argsort(np.where(on, ranks, 2.0), axis=1, kind="stable")
    r = np.take_along_axis(np.where(on, ranks, 1.0), order, axis=1)
    k = np.cumsum(np.take_along_axis(scaled, order, axis=1), axis=1)
    live = np.take_along_axis(on, order, axis=1)
    p = beta_cdf(np.maximum(k, 1e-6), np.maximum(lists[:, None] - k, 0.0) + 1, r)
    low = np.where(live, p, 1.0).min(axis=1, initial=1.0)
    return np.clip(low * np.maximum(lists, 1), 1e-300, 1.0)


def ranks_within(scores: DataFrame) -> DataFrame:
    """Adds ``rank`` (mean rank of ties, best = 1) within (query_id, channel).  One
    exchange on (query_id, channel) serves both windows."""
    per = W.partitionBy("query_id", "channel")
    ties = F.count("*").over(W.partitionBy("query_id", "channel", "score"))
    return scores.withColumn("rank", F.rank().over(per.orderBy(F.desc("score"))) + (ties - 1) / 2)


def robust_rank(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """(query_id, item, significance, place) from scores(query_id, channel, item,
    score) and weights(query_id, w_<channel>..., blend): ``rerank`` has the share
    ``blend``, the others their weights."""
    clean = scores.where("score is not null and not isnan(score)").distinct()
    clean = clean.groupBy("query_id", "channel", "item").agg(F.max("score").alias("score"))
    w_of: Column = F.lit(0.0)
    for c in OTHERS:
        w_of = F.when(F.col("channel") == c, F.col(f"w_{c}")).otherwise(w_of)
    w_of = F.when(F.col("channel") == "rerank", F.col("blend")).otherwise(w_of)
    on = clean.join(weights, "query_id").where(w_of > 0).select("query_id", "channel", "item", "score")
    ranked = ranks_within(on)
    cols = [*OTHERS, "rerank"]
    wide = ranked.groupBy("query_id", "item").agg(*[F.max(F.when(F.col("channel") == c, F.col("rank"))).alias(f"r_{c}") for c in cols])
    wide = wide.withColumn("n", F.count("*").over(W.partitionBy("query_id"))).join(weights, "query_id")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            n = x["n"].to_numpy(float)[:, None]
            r = np.minimum(x[[f"r_{c}" for c in OTHERS]].to_numpy(float) / n, 1.0)
            p = significance(np.nan_to_num(r, nan=1.0), x[[f"w_{c}" for c in OTHERS]].to_numpy(float))
            rr = np.nan_to_num(np.minimum(x["r_rerank"].to_numpy(float) / n[:, 0], 1.0), nan=1.0)
            b = x["blend"].to_numpy(float)
            yield pd.DataFrame({"query_id": x["query_id"], "item": x["item"], "significance": (1 - b) * np.log(p) + b * np.log(rr)})

    judged = wide.mapInPandas(judge, "query_id string, item bigint, significance double")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.round("significance", 9), "item"))
    return judged.withColumn("place", place)


def _inputs(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    asked = table(spark, base, "retrieval_queries").groupBy("query_id").agg(F.min_by("config_id", "asked_at").alias("config_id"))
    cfg = table(spark, base, "retrieval_config").select("config_id", *DEFAULT_WEIGHTS).dropDuplicates(["config_id"])
    d = {k: F.greatest(F.coalesce(F.col(k), F.lit(v)), F.lit(0.0)) for k, v in DEFAULT_WEIGHTS.items()}
    weights = asked.join(cfg, "config_id", "left").select(
        "query_id", F.lit(1.0).alias("w_dense_a"), F.lit(1.0).alias("w_dense_b"), d["bm25_weight"].alias("w_bm25"), d["graph_weight"].alias("w_grafo"), F.least(d["rerank_blend"], F.lit(1.0)).alias("blend")
    )
    scores = table(spark, base, "channel_scores").select("query_id", "channel", big("chunk_id").alias("item"), "score").where("item is not null")
    return scores, weights


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    ranked = robust_rank(*_inputs(spark, base))
    return ranked.where("place <= 5").select("query_id", F.col("item").alias("chunk_id"))


def p6_ranking(spark: SparkSession, base: str) -> DataFrame:
    """The whole ranking of every query."""
    return robust_rank(*_inputs(spark, base)).select("query_id", F.col("item").alias("chunk_id"), F.round("significance", 6).alias("significance"), "place")
