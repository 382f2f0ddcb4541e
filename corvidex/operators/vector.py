"""Dense channel: exact cosine top-k of a query set against all vectors, in blocks.

The query side is a stated set.  It is cut into blocks; every block is sent to
every partition of the stored vectors, which multiplies matrices of bounded size
and keeps its own k best, so only queries x partitions x k rows are exchanged.  A query set
too large to send is worked off by joining on block numbers instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexical import top_k

#: Query vectors are sent to all executors only below so many floats (32 MB).
SENT_FLOATS = 8_000_000
#: Cosines made at once, and stored vectors among them.
CELLS, BLOCK = 1 << 20, 1024


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two float arrays as an expression; null if a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def _unit(rows: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    m = np.stack(rows.to_numpy()).astype(np.float64)
    n = np.linalg.norm(m, axis=1)
    ok = n > 0
    return m[ok] / n[ok, None], ok


def dense_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True) -> DataFrame:
    """(query_id, chunk_id, score, rank) of vectors(chunk_id, embedding) for
    queries(query_id, embedding).  Null and zero vectors take no part."""
    q = queries.where("embedding is not null").select("query_id", "embedding")
    sizes = q.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    stored = vectors.where("embedding is not null").select("chunk_id", "embedding")
    if (sizes["n"] or 0) * (sizes["d"] or 0) > SENT_FLOATS:
        return _by_blocks(stored, q, k, exclude_self, sizes["n"] * sizes["d"] // SENT_FLOATS + 1)
    qp = q.toPandas()
    return top_k(_nearest(stored, qp, k, exclude_self), k)


def _nearest(stored: DataFrame, qp: pd.DataFrame, k: int, exclude_self: bool) -> DataFrame:
    schema = "query_id bigint, chunk_id bigint, score double"
    if qp.empty:
        return stored.sparkSession.createDataFrame([], schema)
    qm, ok = _unit(qp["embedding"])
    ids = qp["query_id"].to_numpy()[ok]
    sent = stored.sparkSession.sparkContext.broadcast((ids, qm.astype(np.float64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qi, m = sent.value
        best = Best(qi, m, k, exclude_self)
        for b in batches:
            best.add(b)
        yield from best.rows()

    return stored.mapInPandas(run, schema)


class Best:
    """The k best of each query among the blocks of vectors seen so far, in room bound by CELLS and queries x k."""

    def __init__(self, qi: np.ndarray, qm: np.ndarray, k: int, exclude_self: bool):
        self.qi, self.qm, self.k, self.exclude_self = qi, qm, k, exclude_self
        self.floor = np.full(len(qi), -np.inf)
        self.kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # place of the query, chunk_id, score
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, block: pd.DataFrame) -> None:
        if not len(block):
            return
        vm, ok = _unit(block["embedding"])
        vi = block["chunk_id"].to_numpy()[ok]
        for at in range(0, len(vi), BLOCK):
            v, ids = vm[at : at + BLOCK], vi[at : at + BLOCK]
            step = max(1, CELLS // len(v))
            for q0 in range(0, len(self.qi), step):
                s = self.qm[q0 : q0 + step] @ v.T
                if self.exclude_self:
                    s[self.qi[q0 : q0 + step, None] == ids[None, :]] = -np.inf
                # a row below its query's k-th best so far is out, one beside it may still win by its id
                low = self.floor[q0 : q0 + step]
                if len(ids) > self.k:
                    low = np.maximum(low, np.partition(s, len(ids) - self.k, axis=1)[:, len(ids) - self.k]) if not self.kept[0].size else low
                q, c = np.nonzero((s >= low[:, None] - 1e-8) & np.isfinite(s))
                self.held.append((q + q0, ids[c], np.round(s[q, c], 9)))
                self.n += len(q)
                if self.n > CELLS:
                    self.settle()
            self.settle()

    def settle(self) -> None:
        """Drops what is no longer among the k best and lifts the floors."""
        if not self.n:
            return
        q, i, s = (np.concatenate(x) for x in zip(self.kept, *self.held))
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        full = place == self.k - 1
        self.floor[q[full]] = s[full]
        self.kept = tuple(x[place < self.k] for x in (q, i, s))
        self.held, self.n = [], 0

    def rows(self) -> Iterator[pd.DataFrame]:
        self.settle()
        q, i, s = self.kept
        for at in range(0, len(q), 100_000):
            yield pd.DataFrame({"query_id": self.qi[q[at : at + 100_000]], "chunk_id": i[at : at + 100_000], "score": s[at : at + 100_000]})


def best_of_block(qi: np.ndarray, qm: np.ndarray, block: pd.DataFrame, k: int, exclude_self: bool) -> pd.DataFrame:
    best = Best(qi, qm, k, exclude_self)
    best.add(block)
    return pd.concat([pd.DataFrame({"query_id": qi[:0], "chunk_id": np.zeros(0, np.int64), "score": np.zeros(0)}), *best.rows()])


def _by_blocks(stored: DataFrame, q: DataFrame, k: int, exclude_self: bool, blocks: int) -> DataFrame:
    """Queries too many to send: both sides are numbered into blocks and each
    query block meets each vector block in one co-group."""
    parts = max(blocks, stored.rdd.getNumPartitions())
    qs = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    left = qs.withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = stored.withColumn("vb", F.pmod(F.xxhash64("chunk_id"), F.lit(parts))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], "chunk_id": [], "score": []})
        m, ok = _unit(a["embedding"])
        return best_of_block(a["query_id"].to_numpy()[ok], m, b, k, exclude_self)

    near = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(run, "query_id bigint, chunk_id bigint, score double")
    return top_k(near, k)
