"""Exact top k of sums: a query's score for a chunk is the sum of what the query's
features give to it.

The queries' features are sent to every task; a task turns its chunks, block by
block, into a matrix of features by chunks and adds up the matrix rows of each
query.  Two passes over the stored rows: the first counts, in every task, how many
of its scores lie in which narrow range, from a floor of the task's own up; ranges
that hold k scores together bound a query's k-th best from below.  The second gives
the chunks that reach the bound.  So about k rows a query are exchanged, and not one
for every query and chunk that share a feature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Cells of a block's matrix, and of the scores made at once (they stay in a core's cache).
CELLS, HELD = 1 << 21, 1 << 17
#: Single precision decides what is added up in double: scores may be so much below a bound.
SLACK = 1e-3
#: A score's range are its sign, exponent and first seven binary digits.
RANGE_BITS = 16
#: Shares of a task's scores that are counted: at least this one, and so many times the share wanted.
LEAST_SHARE, SHARES = 1 / 64, 8
_ROWS = 1 << 17

#: Gives (feature, place in the block, value) of a block of rows, whose first column is chunk_id.
Features = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


class Groups:
    """Queries grouped by their number of features: pairs (query, feature) as two arrays of numbers."""

    def __init__(self, query: np.ndarray, feature: np.ndarray):
        order = np.lexsort((feature, query))
        query, feature = query[order], feature[order]
        who, start, n = np.unique(query, return_index=True, return_counts=True)
        self.size = int(who[-1]) + 1 if len(who) else 0
        self.by_n = [(who[n == m], feature[start[n == m][:, None] + np.arange(m)]) for m in np.unique(n)]


def _blocks(batches: Iterator[pa.RecordBatch], features: Features, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(chunk ids, features by chunks) of each block."""
    step = max(16, min(4096, CELLS // max(size, 1)))
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            f, c, v = features(part)
            n = part.num_rows
            yield part.column(0).to_numpy(zero_copy_only=False), np.bincount(f * n + c, weights=v, minlength=size * n).reshape(size, n)


def _scored(m: np.ndarray, groups: Groups, floor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, their features, scores in single precision) of the queries that may reach their floor in a block."""
    low = m.astype(np.float32)
    most = low.max(1)
    for who, of in groups.by_n:
        live = np.flatnonzero(most[of].sum(1) * (1 + SLACK) >= floor[who])
        step = max(1, HELD // (of.shape[1] * m.shape[1]))
        for at in range(0, len(live), step):
            k = live[at : at + step]
            yield who[k], of[k], np.add.reduce(low.take(of[k], 0), 1)


def _ranges(features: Features, groups: Groups, size: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiny = np.finfo(np.float32).tiny
        floor, first, held, n = np.full(groups.size, tiny, np.float32), True, [], 0
        total = (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def summed() -> tuple[np.ndarray, np.ndarray]:
            key, place = np.unique(np.concatenate([total[0], *held]), return_inverse=True)
            return key, np.bincount(place, weights=np.concatenate([total[1], *(np.ones(len(x), np.int64) for x in held)]), minlength=len(key)).astype(np.int64)

        for _, m in _blocks(batches, features, size):
            for who, _, s in _scored(m, groups, floor):
                if first:  # any floor is right: what is not counted only makes the bound lower
                    at = max(0, s.shape[1] - int(np.ceil(share * s.shape[1])))
                    floor[who] = np.maximum(np.partition(s, at, axis=1)[:, at], tiny)
                q, c = np.nonzero(s >= floor[who][:, None])
                held.append((who[q].astype(np.int64) << RANGE_BITS) | (s[q, c].view(np.int32) >> RANGE_BITS))
                n += len(q)
                if n > 1 << 21:
                    total, held, n = summed(), [], 0
            first = False
        key, count = summed() if held else total
        for at in range(0, len(key), _ROWS):
            k = key[at : at + _ROWS]
            yield pa.RecordBatch.from_arrays([pa.array((k >> RANGE_BITS).astype(np.int32)), pa.array((k & ((1 << RANGE_BITS) - 1)).astype(np.int32)), pa.array(count[at : at + _ROWS])], ["q", "range", "n"])

    return run


def _reaching(features: Features, groups: Groups, size: int, bound: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def rows() -> pa.RecordBatch:
            q, c, s = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(c.astype(np.int64)), pa.array(s)], ["q", "chunk_id", "score"])

        for ids, m in _blocks(batches, features, size):
            for who, of, s in _scored(m, groups, bound):
                q, c = np.nonzero(s >= bound[who][:, None])
                held.append((who[q], ids[c], m[of[q], c[:, None]].sum(1)))
                n += len(q)
                if n >= _ROWS:
                    yield rows()
                    held, n = [], 0
        if n:
            yield rows()

    return run


def top_sums(stored: DataFrame, features: Features, size: int, groups: Groups, k: int, n: int) -> DataFrame:
    """(q int, chunk_id, score) with every chunk that belongs to the k best of a
    query, and a few more.  stored: n rows, chunk_id first; features: numbers below
    ``size``, values positive; chunks that share nothing with a query are not given."""
    counted = stored.mapInArrow(_ranges(features, groups, size, min(1.0, max(SHARES * k / max(n, 1), LEAST_SHARE))), "q int, range int, n bigint")
    per = counted.groupBy("q", "range").agg(F.sum("n").alias("n"))
    so_far = F.sum("n").over(W.partitionBy("q").orderBy(F.desc("range")))
    found = per.withColumn("n", so_far).where(F.col("n") >= k).groupBy("q").agg(F.max("range").alias("range")).toArrow()  # a number a query
    bound = np.full(groups.size, np.finfo(np.float32).tiny, np.float32)
    bound[found["q"].to_numpy()] = (found["range"].to_numpy().astype(np.int32) << RANGE_BITS).view(np.float32) * np.float32(1 - SLACK)
    return stored.mapInArrow(_reaching(features, groups, size, bound), "q int, chunk_id bigint, score double")
