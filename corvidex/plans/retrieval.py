"""Retrieval composed over all queries at once, and its presets."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import diversify, fusion, graph, lexical


@dataclass(frozen=True)
class Settings:
    """Every knob of retrieval; the defaults are the code defaults of the semantics."""

    depth: int = 1000
    min_score: float = 0.0
    weights: dict[str, float] = field(default_factory=lambda: {"bm25": 0.5, "grafo": 0.5})
    fusion: str = "rrf"
    boost: float = 0.20
    boost_mode: str = "add"
    rerank_depth: int = 150
    rerank_blend: float = 0.5
    dedupe_threshold: float = 0.45
    dedupe_window: int = 200
    mmr_lambda: float = 1.0
    rm3: bool = False
    doc_mode: str = "rankdecay"
    doc_decay: float = 0.85
    doc_pool: int = 30
    doc_top_m: int = 3
    doc_bonus: float = 0.02
    doc_cap: int = 3
    n_docs: int = 3
    n_fragments: int = 10


PRESETS = {
    "code_default": Settings(),
    "readme_submitted": replace(Settings(), weights={"bm25": 1.0, "grafo": 0.5}, fusion="combsum", boost=0.08, boost_mode="multiply", rerank_depth=0, doc_mode="max"),
}


def fuse(channels: DataFrame, s: Settings) -> DataFrame:
    live = channels if s.min_score <= 0 else fusion.min_score(channels, s.min_score)
    return (fusion.rrf if s.fusion == "rrf" else fusion.combsum)(live, s.weights)


def retrieve(channels: DataFrame, chunks: DataFrame, s: Settings = PRESETS["code_default"], ce_scores: DataFrame | None = None) -> dict[str, DataFrame]:
    """channels(query_id, channel, chunk_id, score), chunks(chunk_id, doc_id,
    phenomenon, text), ce_scores(query_id, chunk_id, ce_score) -> candidates,
    unique, documents and fragments.  Branches that a setting turns off are not
    part of the plan.  Only the head is folded; the tail keeps its order behind it."""
    meta = chunks.select("chunk_id", "doc_id", "phenomenon")
    fused = fuse(channels, s).where(F.col("rank") <= s.depth)
    boosted = fused.join(meta, "chunk_id").withColumn("expected", fusion.expected_phenomenon(F.col("query_id")))
    ranked = fusion.phenomenon_boost(boosted, s.boost, s.boost_mode).select("query_id", "chunk_id", "score", "rank")
    if ce_scores is not None and s.rerank_depth > 0:
        ranked = fusion.rerank(ranked.join(ce_scores, ["query_id", "chunk_id"], "left"), s.rerank_depth, s.rerank_blend)
    docs = fusion.documents(ranked.join(meta.select("chunk_id", "doc_id"), "chunk_id"), s.doc_mode, s.n_docs, s.doc_pool, s.doc_top_m, s.doc_bonus, s.doc_cap, s.doc_decay)
    texts = ranked.join(chunks.select("chunk_id", "doc_id", "text"), "chunk_id")  # at most ``depth`` rows a query
    unique = diversify.deduplicate(texts, s.dedupe_threshold, window=s.dedupe_window)
    if s.mmr_lambda < 1:
        unique = diversify.mmr(unique.drop("rank").withColumnRenamed("place", "rank"), s.mmr_lambda)
    frags = diversify.fragments(unique, s.n_fragments).join(meta.select("chunk_id", "doc_id"), "chunk_id")
    return {"candidates": ranked, "unique": unique, "documents": docs, "fragments": frags}


def search(chunks: DataFrame, queries: DataFrame, s: Settings = PRESETS["code_default"], dense: DataFrame | None = None, names: DataFrame | None = None, node_chunks: DataFrame | None = None, edge_rows: DataFrame | None = None, ce_scores: DataFrame | None = None) -> dict[str, DataFrame]:
    """Retrieval from texts to results for all queries(query_id, query) at once:
    BM25 over chunks(chunk_id, doc_id, phenomenon, text), once more with the
    feedback's terms if ``rm3`` asks for them, the graph channel from entity
    ``names``, node_chunks and edges, and dense rankings(query_id, channel,
    chunk_id, score); then ``retrieve``.  A channel that is not given, or weighs
    nothing, is not part of the plan."""
    index = lexical.Index(chunks.select("chunk_id", "text"), queries)
    out = []
    if s.weights.get("bm25", 1.0) > 0:
        out.append(index.bm25(s.depth, terms=index.expanded() if s.rm3 else None).select("query_id", F.lit("bm25").alias("channel"), "chunk_id", "score"))
    if names is not None and s.weights.get("grafo", 1.0) > 0:
        g = graph.graph_search(graph.link(queries, names), node_chunks, edge_rows, s.depth)
        out.append(g.select("query_id", F.lit("grafo").alias("channel"), "chunk_id", "score"))
    if dense is not None:
        out.append(dense.select("query_id", "channel", "chunk_id", "score"))
    return retrieve(reduce(DataFrame.unionByName, out), chunks, s, ce_scores)
