"""Fusing and re-ordering rankings (query_id, channel, chunk_id, score), all queries at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .lexical import DECIMALS

RRF_K = 60
RERANK_K = 10


def ordered(by: str = "score", *keys: str) -> W:
    return W.partitionBy(*(keys or ("query_id",))).orderBy(F.desc(by), F.asc("chunk_id"))


def min_score(ranking: DataFrame, least: float) -> DataFrame:
    """Rows of at least ``least``; a channel that would be left empty stays whole."""
    top = F.max("score").over(W.partitionBy("query_id", "channel"))
    return ranking.withColumn("top", top).where((F.col("score") >= least) | (F.col("top") < least)).drop("top")


def weighted(rankings: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """Adds ``w``; channels at 0 or less are dropped, unknown channels weigh 1."""
    w: Column = F.lit(1.0)
    for name, value in (weights or {}).items():
        w = F.when(F.col("channel") == name, F.lit(float(value))).otherwise(w)
    return rankings.withColumn("w", w).where("w > 0 and score is not null")


def rrf(rankings: DataFrame, weights: dict[str, float] | None = None, k: int = RRF_K) -> DataFrame:
    """(query_id, chunk_id, score, rank): weighted reciprocal ranks.  A query
    with one live channel keeps that channel's raw scores."""
    live = weighted(rankings, weights)
    per = W.partitionBy("query_id")
    r = F.row_number().over(ordered("score", "query_id", "channel"))
    x = live.withColumn("r", r).withColumn("channels", F.size(F.collect_set("channel").over(per)))
    part = F.when(F.col("channels") > 1, F.col("w") / (k + F.col("r"))).otherwise(F.col("score"))
    fused = x.select("query_id", "chunk_id", part.alias("part")).groupBy("query_id", "chunk_id").agg(F.round(F.sum("part"), DECIMALS).alias("score"))
    return fused.withColumn("rank", F.row_number().over(ordered()))


def combsum(rankings: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(query_id, chunk_id, score, rank): weighted sum of min-max scores; a channel of equal scores adds 0."""
    per = W.partitionBy("query_id", "channel")
    x = weighted(rankings, weights).withColumn("lo", F.min("score").over(per)).withColumn("span", F.max("score").over(per) - F.min("score").over(per))
    part = F.col("w") * (F.col("score") - F.col("lo")) / F.when(F.col("span") == 0, 1.0).otherwise(F.col("span"))
    fused = x.select("query_id", "chunk_id", part.alias("part")).groupBy("query_id", "chunk_id").agg(F.round(F.sum("part"), DECIMALS).alias("score"))
    return fused.withColumn("rank", F.row_number().over(ordered()))


def expected_phenomenon(query_id: Column) -> Column:
    """1 up to query number 16, 2 up to 32, else 3; 0 without a number."""
    n = F.regexp_extract(query_id, r"(\d+)", 1).try_cast("bigint")
    return F.when(n.isNull(), 0).when(n <= 16, 1).when(n <= 32, 2).otherwise(3)


def phenomenon_boost(ranking: DataFrame, boost: float, mode: str = "add") -> DataFrame:
    """Lifts rows whose ``phenomenon`` is the query's ``expected``: by a share of
    the query's score span, or by a factor.  Boost 0 changes nothing."""
    if boost == 0:
        return ranking.withColumn("rank", F.row_number().over(ordered()))
    per = W.partitionBy("query_id")
    span = F.max("score").over(per) - F.min("score").over(per)
    hit = (F.col("phenomenon") == F.col("expected")) & (F.col("expected") > 0)
    lifted = F.col("score") + boost * F.col("span") if mode == "add" else F.col("score") * (1 + boost)
    out = ranking.withColumn("span", span).withColumn("score", F.round(F.when(hit, lifted).otherwise(F.col("score")), DECIMALS)).drop("span")
    return out.withColumn("rank", F.row_number().over(ordered()))


def rerank(ranking: DataFrame, depth: int = 150, blend: float = 0.5, k: int = RERANK_K) -> DataFrame:
    """Re-orders the first ``depth`` rows by ``ce_score``: replaced at blend 1 or
    more, else blended reciprocal ranks; the tail keeps its order behind."""
    head = F.col("rank") <= depth
    ce = W.partitionBy("query_id", head).orderBy(F.desc_nulls_last("ce_score"), F.asc("rank"))
    x = ranking.withColumn("ce_rank", F.when(head, F.row_number().over(ce)))
    b = float(blend)
    mixed = F.col("ce_score").cast("double") if b >= 1 else (1 - b) / (k + F.col("rank")) + b / (k + F.col("ce_rank"))
    x = x.withColumn("mixed", F.when(head, F.round(mixed, DECIMALS)))
    order = W.partitionBy("query_id").orderBy(head.desc(), F.desc_nulls_last("mixed"), F.asc("rank"))
    return x.withColumn("new_rank", F.row_number().over(order)).select("query_id", "chunk_id", F.coalesce("mixed", "score").alias("score"), F.col("new_rank").alias("rank"))


# ---- documents -----------------------------------------------------------


def _pooled(ranking: DataFrame, pool: int) -> DataFrame:
    """Adds the row's place within its document (hit) among the first ``pool`` rows."""
    w = W.partitionBy("query_id", "doc_id").orderBy("rank")
    return ranking.where(F.col("rank") <= pool).withColumn("hit", F.row_number().over(w))


def documents(ranking: DataFrame, mode: str = "max", n: int = 3, pool: int = 30, top_m: int = 3, bonus: float = 0.02, cap: int = 3, decay: float = 0.85, k: int = RRF_K) -> DataFrame:
    """(query_id, doc_id, score, rank): first ``n`` documents of a chunk ranking.

    Modes max, sum, mean (divided by top_m even with fewer hits) and rrf take the
    best top_m hits and add a bonus for more hits; rankdecay sums decaying
    reciprocal ranks.  Documents beyond the pool fill up free places by their
    best rank."""
    p = _pooled(ranking, pool)
    first = F.col("hit") <= top_m
    if mode == "rankdecay":
        agg = F.sum(F.pow(F.lit(decay), F.col("hit") - 1) / (k + F.col("rank")))
    elif mode == "max":
        agg = F.max("score")
    elif mode == "sum":
        agg = F.sum(F.when(first, F.col("score")))
    elif mode == "mean":
        agg = F.sum(F.when(first, F.col("score"))) / top_m
    elif mode == "rrf":
        agg = F.sum(F.when(first, 1.0 / (k + F.col("rank"))))
    else:
        raise ValueError(f"unknown document mode {mode!r}")
    factor = F.lit(1.0) if mode == "rankdecay" else 1 + bonus * F.least(F.count("*") - 1, F.lit(cap))
    scored = p.groupBy("query_id", "doc_id").agg(F.round(agg * factor, DECIMALS).alias("score"), F.min("rank").alias("first"))
    rest = ranking.where(F.col("rank") > pool).groupBy("query_id", "doc_id").agg(F.min("rank").alias("first")).join(scored, ["query_id", "doc_id"], "left_anti")
    both = scored.withColumn("beyond", F.lit(0)).unionByName(rest.select("query_id", "doc_id", F.lit(None).cast("double").alias("score"), "first", F.lit(1).alias("beyond")))
    w = W.partitionBy("query_id").orderBy("beyond", F.desc_nulls_last("score"), "first", "doc_id")
    return both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("query_id", "doc_id", "score", "rank")
