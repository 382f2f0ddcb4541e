"""Measuring rankings: hits, F1, nDCG, reciprocal rank, coverage, pooling, sweeps, validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T

DEFAULT_COVER = 0.30


def f1(found: Column, relevant: Column, k: int) -> Column:
    """F1 at k: precision over k, recall over min(relevant, k); 0 without relevant or found."""
    p, r = found / F.lit(float(k)), found / F.least(relevant, F.lit(k))
    return F.when((relevant > 0) & (found > 0), 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def f1_ceiling(relevant: Column, k: int = 3) -> Column:
    return f1(F.least(relevant, F.lit(k)), relevant, k)


def ideal_dcg(relevant: Column, k: int) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(relevant, F.lit(k)), F.lit(1)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))


def measures(ranked_hits: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, relevant, found, f1, ceiling, ndcg, rr): ranked_hits(query_id,
    rank, hit boolean), relevant(query_id, relevant); queries without a ranking
    score 0."""
    at = F.col("rank") <= k
    per = ranked_hits.where("hit").groupBy("query_id").agg(F.count_if(at).alias("found"), F.sum(F.when(at, 1 / F.log2(F.col("rank") + 1.0))).alias("dcg"), F.min("rank").alias("first"))
    x = relevant.join(per, "query_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return x.select(
        "query_id",
        "relevant",
        "found",
        F.round(f1(F.col("found"), F.col("relevant"), k), 6).alias("f1"),
        F.round(f1_ceiling(F.col("relevant"), k), 6).alias("ceiling"),
        F.round(F.when(F.col("relevant") > 0, F.coalesce("dcg", F.lit(0.0)) / ideal_dcg(F.col("relevant"), k)).otherwise(0.0), 6).alias("ndcg"),
        F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 6).alias("rr"),
    )


def macro(per_query: DataFrame) -> DataFrame:
    """One row of means over queries."""
    return per_query.agg(*[F.round(F.avg(c), 6).alias(c) for c in ("f1", "ceiling", "ndcg", "rr")], F.count("*").alias("queries"))


def gram_coverage(items: DataFrame, texts: DataFrame, n: int = 8) -> DataFrame:
    """(item_id, chunk_id, coverage): share of an item's n-grams in a text, for
    pairs sharing at least one.  Items' grams go first: only texts' grams that
    an item has are exchanged."""
    ig = items.select("item_id", T.norm_grams(F.coalesce("text", F.lit("")), n).alias("g")).where(F.size("g") > 0)
    sizes = ig.select("item_id", F.size("g").alias("total"))
    want = ig.select("item_id", F.explode("g").alias("gram"))
    have = texts.select("chunk_id", F.explode(T.norm_grams(F.coalesce("text", F.lit("")), n)).alias("gram"))
    shared = have.join(want, "gram").groupBy("item_id", "chunk_id").agg(F.count("*").alias("shared"))
    return shared.join(sizes, "item_id").select("item_id", "chunk_id", F.round(F.col("shared") / F.col("total"), 9).alias("coverage"))


def audit(items: DataFrame, texts: DataFrame, threshold: float = DEFAULT_COVER, n: int = 8) -> DataFrame:
    """(item_id, best, chunk_id, verdict): best coverage of every item: indexed, partial from 0.10, or absent."""
    cov = gram_coverage(items, texts, n)
    best = cov.withColumn("r", F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("coverage"), "chunk_id"))).where("r = 1")
    x = items.select("item_id").distinct().join(best, "item_id", "left")
    c = F.coalesce("coverage", F.lit(0.0))
    return x.select("item_id", F.round(c, 6).alias("best"), "chunk_id", F.when(c >= threshold, "indexed").when(c >= 0.10, "partial").otherwise("absent").alias("verdict"))


def coverage_hits(ranking: DataFrame, cov: DataFrame, owner: DataFrame, threshold: float = DEFAULT_COVER) -> DataFrame:
    """(query_id, rank, hit): a ranked chunk is a hit if it is the first to cover
    one of the query's items.  owner(query_id, item_id)."""
    good = cov.where(F.col("coverage") >= threshold).join(owner, "item_id").select("query_id", "item_id", "chunk_id")
    firsts = ranking.join(good, ["query_id", "chunk_id"]).groupBy("query_id", "item_id").agg(F.min("rank").alias("rank")).select("query_id", "rank").distinct()
    return ranking.select("query_id", "rank").join(firsts.withColumn("h", F.lit(True)), ["query_id", "rank"], "left").select("query_id", "rank", F.coalesce("h", F.lit(False)).alias("hit"))


def resolve_ids(questions: DataFrame, official: DataFrame, n: int = 5, least: float = 0.8) -> DataFrame:
    """(gt_id, query_id): official query of the greatest gram overlap above
    ``least``, ties to the larger id; met on shared grams, not on all pairs."""
    a = questions.select("gt_id", T.norm_grams(F.coalesce("text", F.lit("")), n).alias("g"))
    b = official.select("query_id", F.explode(T.norm_grams(F.coalesce("query", F.lit("")), n)).alias("gram"))
    shared = a.select("gt_id", F.size("g").alias("t"), F.explode("g").alias("gram")).join(b, "gram").groupBy("gt_id", "query_id", "t").agg(F.count("*").alias("c"))
    x = shared.withColumn("overlap", F.col("c") / F.col("t")).where(F.col("overlap") > least)
    return x.groupBy("gt_id").agg(F.max_by("query_id", F.struct("overlap", "query_id")).alias("query_id"))


def pool(rankings: dict[str, DataFrame], depth: int = 25) -> DataFrame:
    """(query_id, chunk_id, best_rank, finders) over the first ``depth`` rows of several configurations."""
    rows = reduce(DataFrame.unionByName, [r.where(F.col("rank") <= depth).select("query_id", "chunk_id", "rank").withColumn("finder", F.lit(name)) for name, r in rankings.items()])
    return rows.groupBy("query_id", "chunk_id").agg(F.min("rank").alias("best_rank"), F.array_join(F.array_sort(F.collect_set("finder")), ",").alias("finders"))


def sweep(rankings: dict[str, DataFrame], hits_of, relevant: DataFrame, k: int = 10) -> DataFrame:
    """(config, f1, ceiling, ndcg, rr, queries) of each configuration; channels are
    ranked once by the caller and only fused per configuration."""
    rows = [macro(measures(hits_of(r), relevant, k)).withColumn("config", F.lit(name)) for name, r in rankings.items()]
    return reduce(DataFrame.unionByName, rows)


def best_config(scores: DataFrame, by: str = "rr") -> DataFrame:
    """The winning row of each grid (config = grid/row), ties by nDCG, then name; names with ABLATION do not win."""
    x = scores.where(~F.col("config").contains("ABLATION")).withColumn("grid", F.split("config", "/")[0])
    return x.groupBy("grid").agg(F.min_by("config", F.struct(-F.col(by), -F.col("ndcg"), "config")).alias("config"), F.max(by).alias(by))


def results(docs: DataFrame, frags: DataFrame) -> DataFrame:
    """One nested result line a query: documents and fragments in rank order."""
    d = docs.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    f = frags.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("fragments"))
    return d.join(f, "query_id", "full")


def violations(lines: DataFrame, n_docs: int = 3, n_frags: int = 10, limit: int = 250) -> DataFrame:
    """(query_id, problem) for each broken rule of a result line."""
    size_ok = F.size("documents") == n_docs
    distinct = F.size(F.array_distinct(F.transform("documents", lambda x: x["doc_id"]))) == F.size("documents")
    long = F.exists("fragments", lambda x: F.size(F.filter(F.split(x["text"], r"\s+"), lambda w: w != "")) > limit)
    sep = F.exists("fragments", lambda x: x["text"].rlike("[\\u0085\\u2028\\u2029]"))
    rules = {"documents": ~F.coalesce(size_ok, F.lit(False)), "repeated_document": ~F.coalesce(distinct, F.lit(False)), "fragments": ~F.coalesce(F.size("fragments") == n_frags, F.lit(False)), "long_fragment": F.coalesce(long, F.lit(False)), "separator": F.coalesce(sep, F.lit(False))}
    problem = F.explode(F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull()))
    return lines.select("query_id", problem.alias("problem"))


def diagnostics(ranking: DataFrame, documents: DataFrame, good_chunks: DataFrame, good_docs: DataFrame, pool_rank: int = 10) -> DataFrame:
    """(query_id, doc_rank, frag_rank, pool_rank): first place of a relevant document
    among documents(query_id, doc_id, rank), of a relevant chunk among the first
    ``pool_rank`` rows of ranking(query_id, chunk_id, rank), and in the whole of it;
    null where there is none."""
    hit = ranking.join(good_chunks.select("query_id", "chunk_id").distinct(), ["query_id", "chunk_id"], "left_semi")
    per = hit.groupBy("query_id").agg(F.min(F.when(F.col("rank") <= pool_rank, F.col("rank"))).alias("frag_rank"), F.min("rank").alias("pool_rank"))
    d = documents.join(good_docs.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"], "left_semi").groupBy("query_id").agg(F.min("rank").alias("doc_rank"))
    return ranking.select("query_id").distinct().join(d, "query_id", "left").join(per, "query_id", "left").select("query_id", "doc_rank", "frag_rank", "pool_rank")


def mean_reciprocal(ranks: DataFrame, *columns: str) -> DataFrame:
    """One row: the mean of 1 / rank of each column, 0 where there is none."""
    return ranks.agg(*[F.round(F.avg(F.coalesce(1.0 / F.col(c), F.lit(0.0))), 6).alias(f"mrr_{c}") for c in columns])


def distinct_documents(ranking: DataFrame, n: int = 10) -> DataFrame:
    """(query_id, n_docs): distinct documents among the first n rows of ranking(query_id, doc_id, rank)."""
    return ranking.where(F.col("rank") <= n).groupBy("query_id").agg(F.count_distinct("doc_id").alias("n_docs"))


def same_document(a: Column, b: Column) -> Column:
    """Whether one normalised document name ends with the other; empty names match nothing."""
    x, y = T.norm_doc(a), T.norm_doc(b)
    return (F.length(x) > 0) & (F.length(y) > 0) & (F.endswith(x, y) | F.endswith(y, x))


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, missing): keys that stand on one side only (store checks)."""
    a = left.select(key).distinct().join(right.select(key), key, "left_anti").agg(F.count("*").alias("missing")).withColumn("side", F.lit("right"))
    b = right.select(key).distinct().join(left.select(key), key, "left_anti").agg(F.count("*").alias("missing")).withColumn("side", F.lit("left"))
    return a.unionByName(b).select("side", "missing")
