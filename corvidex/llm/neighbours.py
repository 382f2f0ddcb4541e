"""Problem 1: the k most similar vectors of every vector.

Method: collision-counting hashing.  A vector's hash values are single random
projections.  Within a cell the projections of the stored vectors are sorted
arrays; around each query a window is opened on every array and widened by
virtual rehashing; vectors that fall into the window of at least COLLISIONS of
the PROJECTIONS arrays are verified by exact cosine.  A stored row stops
widening when the window is REACH times as wide as the distance of its k-th
verified neighbour: two vectors at that distance then collide often enough with
a probability of about 0.97.  A visiting query opens the window that nearly all
rows of the cell needed.

One window over all vectors would cost the square of their number, so the
arrays are kept by cell.  Cells are the surroundings of centres: at most
MAX_CENTRES by k-means over a sample of SAMPLE vectors a centre; a cell of more
than 4 x CELL_ROWS rows is divided among vectors of its own, drawn by chance, so
a dense region has as many more cells as it has more rows (MAX_PIVOTS at most in
all; beyond it cells grow).  A vector is stored in the nearest cell and queries
the next ones; probes grow with the logarithm of the number of cells.  A pair
that meets in any cell counts for both.  Vectors equal in all elements form one
class first, so a vector repeated in a third of all rows is stored once.

The more cells there are, the more near pairs a border between cells parts, so
the lists so found are a beginning: a row's label is the greatest hash among the
rows within two steps of its list, and every row is compared with all rows that
have its own label or one of its neighbours' in common with it.  What any
neighbour of a neighbour knows is thus found wherever the borders lie.

Every row is indexed; only the centres come from samples.  Recall against brute
force is measured in tests and in the README.  Defined cases: null, empty and
zero vectors and such with a value that is no number take no part, nor do
vectors of another length than most (ties: the longer); ties go to the smaller
id; repeated rows count once; with fewer than k other vectors all that are found
are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise, mix64, small, table

K = 5
PROJECTIONS, COLLISIONS = 24, 10
#: Half width of the first window, in units of a unit vector's distance, the factor it grows by, and how often.
WIDTH, GROWTH, ROUNDS = 0.25, 1.4, 6
#: Half width over distance at which two vectors meet in COLLISIONS arrays with a chance of about 0.97.
REACH = 0.8
CELL_ROWS, MAX_CENTRES, MAX_PIVOTS = 400, 1024, 1 << 16
#: Sampled vectors a centre, and rounds of k-means over them.
SAMPLE, REFINE = 32, 4
#: Decimals of a cosine that count; beyond them the smaller id comes first.
DECIMALS = 5
#: Centres whose pivots a row is compared with, where cells are divided.
SCANNED = 32
#: Cells in a task.
TASK_CELLS = 32
#: Rows compared at once with one label or several, and of a label beyond which its rows are searched as a cell, divided beyond 4 x CELL_ROWS.
BLOCK_ROWS = 256


def directions(n: int, dim: int, seed: int) -> np.ndarray:
    """n random unit directions, the same on every worker."""
    d = np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def matrix(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of a list<float> column and which rows are usable."""
    ok = np.array(col.is_valid())
    lens = np.diff(col.offsets.to_numpy())
    ok &= lens == dim
    m = np.zeros((len(col), dim), np.float32)
    v = col.values.to_numpy(zero_copy_only=False)
    start = col.offsets.to_numpy()[:-1]
    if ok.any():
        m[ok] = v[start[ok][:, None] + np.arange(dim)]
    n = np.linalg.norm(m.astype(np.float64), axis=1)
    ok &= np.isfinite(n) & (n > 0)
    m[ok] = (m[ok] / n[ok, None]).astype(np.float32)
    return m, ok


def nearest_centres(m: np.ndarray, c: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the nearest centres of each row, nearest first; their squared distances less the row's own square)."""
    p = min(probes, len(c))
    at, far = np.empty((len(m), p), np.int64), np.empty((len(m), p), np.float32)
    half = (c * c).sum(axis=1)
    for s in range(0, len(m), 4096):
        d = half - 2 * (m[s : s + 4096] @ c.T)
        part = np.argpartition(d, p - 1, axis=1)[:, :p]
        v = np.take_along_axis(d, part, 1)
        o = np.argsort(v, axis=1, kind="stable")
        at[s : s + 4096], far[s : s + 4096] = np.take_along_axis(part, o, 1), np.take_along_axis(v, o, 1)
    return at, far


def drawn(v: DataFrame, dim: int, take) -> np.ndarray:
    """Vectors drawn by chance: ``take(unit vectors, uniform numbers)`` says which.  The
    numbers follow from the ids, so a lost task draws the same again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, ok = matrix(b.column(1), dim)
            u = (mix64(b.column(0).to_numpy().astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / 2**53
            rows = np.flatnonzero(ok)
            rows = rows[take(m[rows], u[rows])] if len(rows) else rows
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array([x.tobytes() for x in m[rows]], pa.binary())], names=["id", "vec"])

    got = sorted(v.select("id", "embedding").mapInArrow(run, "id bigint, vec binary").collect(), key=lambda r: r["id"])
    return np.frombuffer(b"".join(bytes(r["vec"]) for r in got), np.float32).reshape(-1, dim)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """k centres of the sample x, or x itself if it is no larger."""
    if len(x) <= k:
        return x.copy()
    c = x[:: len(x) // k][:k].copy()
    for _ in range(REFINE):
        a = nearest_centres(x, c, 1)[0][:, 0]
        order = np.argsort(a, kind="stable")
        starts = np.flatnonzero(np.diff(a[order], prepend=-1))
        sums = np.add.reduceat(x[order], starts, axis=0)
        c[a[order][starts]] = sums / np.diff(starts, append=len(x))[:, None]
    return c


class Cells:
    """Centres of all cells: cell j < len(top) is that of centre j, unless it is
    divided; the pivots of divided cells follow."""

    def __init__(self, v: DataFrame, dim: int, n: int):
        k = int(np.clip(-(-n // CELL_ROWS), 1, MAX_CENTRES))
        share = min(1.0, 1.2 * k * SAMPLE / max(n, 1))
        self.top = k_means(drawn(v, dim, lambda m, u: u < share), k)
        sent = v.sparkSession.sparkContext.broadcast(self.top)

        def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = sent.value
            total = np.zeros(len(c), np.int64)
            for b in batches:
                m, ok = matrix(b.column(0), dim)
                if ok.any():
                    total += np.bincount(nearest_centres(m[ok], c, 1)[0][:, 0], minlength=len(c))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(c)), pa.int32()), pa.array(total)], names=["cell", "n"])

        rows = np.zeros(max(len(self.top), 1), np.int64)
        if len(self.top):  # at most MAX_CENTRES rows, whatever the input
            for r in v.select("embedding").mapInArrow(homes, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
                rows[r["cell"]] = r["n"]
        wide = rows > 4 * CELL_ROWS
        want = np.where(wide, -(-rows // CELL_ROWS), 0)
        chance = np.where(wide, want / np.maximum(rows, 1), 0.0) * min(1.0, MAX_PIVOTS / max(want.sum(), 1))
        pivots = np.zeros((0, dim), np.float32)
        if wide.any():
            pivots = drawn(v, dim, lambda m, u: u < chance[nearest_centres(m, sent.value, 1)[0][:, 0]])
        of = nearest_centres(pivots, self.top, 1)[0][:, 0] if len(pivots) else np.zeros(0, np.int64)
        order = np.argsort(of, kind="stable")
        self.pivots, of = pivots[order], of[order]
        self.inside = {int(c): slice(*np.searchsorted(of, [c, c + 1])) for c in np.unique(of)}
        self.count = len(self.top) + len(self.pivots)
        self.probes = 2 + int(np.ceil(np.log(max(self.count, 2)) / np.log(32)))

    def probed(self, m: np.ndarray) -> np.ndarray:
        """The cells each row looks in, its own first; -1 where there are fewer."""
        if not self.inside:
            return nearest_centres(m, self.top, self.probes)[0]
        at, far = nearest_centres(m, self.top, max(SCANNED, self.probes))
        wide = at.shape[1]
        cells, dist = np.full((at.size, self.probes), -1), np.full((at.size, self.probes), np.inf)
        cells[:, 0], dist[:, 0] = at.ravel(), far.ravel()
        order = np.argsort(at, axis=None, kind="stable")
        which, starts = np.unique(at.ravel()[order], return_index=True)
        for c, some in zip(which.tolist(), np.split(order, starts[1:])):
            if c in self.inside:
                s = self.inside[c]
                x, y = nearest_centres(m[some // wide], self.pivots[s], self.probes)
                cells[some, : x.shape[1]], dist[some, : x.shape[1]] = x + s.start + len(self.top), y
        cells, dist = cells.reshape(len(m), -1), dist.reshape(len(m), -1)
        o = np.argpartition(dist, self.probes - 1, axis=1)[:, : self.probes]
        o = np.take_along_axis(o, np.argsort(np.take_along_axis(dist, o, 1), axis=1, kind="stable"), 1)
        return np.where(np.isinf(np.take_along_axis(dist, o, 1)), -1, np.take_along_axis(cells, o, 1))


def packed(m: np.ndarray, rows: np.ndarray | slice = slice(None)) -> pa.Array:
    """Unit rows of m as binary, two bytes an element: integers up to a row's greatest,
    since the row's length gives the scale back."""
    top = np.abs(m).max(axis=1, keepdims=True, initial=0)
    whole = np.ascontiguousarray(np.rint(m * (32767 / np.where(top > 0, top, 1))).astype(np.int16)[rows])
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(m.shape[1] * 2), len(whole), [None, pa.py_buffer(whole)]).cast(pa.binary())


def unpacked(vec: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    m = np.frombuffer(b"".join(vec.to_pylist()), np.int16).reshape(-1, dim).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def assign(v: DataFrame, dim: int, cells: Cells) -> DataFrame:
    """(cell, home, id, vec): each vector in its own cell and as a query in those it
    probes.  vec takes two bytes an element, which halves what is exchanged."""
    sent = v.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, ok = matrix(b.column(1), dim)
            ids = b.column(0).to_numpy()[ok]
            m = m[ok]
            if not len(m):
                continue
            at = sent.value.probed(m)
            who, place = np.nonzero(at >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(at[who, place].astype(np.int32)), pa.array(place == 0), pa.array(ids[who]), packed(m, who)], names=["cell", "home", "id", "vec"])

    return v.select("id", "embedding").mapInArrow(run, "cell int, home boolean, id bigint, vec binary")


class Arrays:
    """The sorted projections of a cell's stored rows."""

    def __init__(self, hx: np.ndarray):
        self.n, m = hx.shape
        kind = np.uint16 if self.n < 65535 else np.uint32
        order = np.argsort(hx, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(hx, order, 0).T)
        self.place = np.empty((m, self.n), kind)
        np.put_along_axis(self.place, order.T, np.arange(self.n, dtype=kind)[None, :], 1)

    def collisions(self, hq: np.ndarray, half: float) -> np.ndarray:
        """counts[q, x]: arrays in whose query-centred window x falls; membership is a comparison of places."""
        counts = np.zeros((len(hq), self.n), np.uint8)
        for j, (arr, place) in enumerate(zip(self.sorted, self.place)):
            lo = np.searchsorted(arr, hq[:, j] - half).astype(place.dtype)
            hi = np.searchsorted(arr, hq[:, j] + half, side="right").astype(place.dtype)
            counts += (place[None, :] - lo[:, None]) < (hi - lo)[:, None]
        return counts


def most(key: np.ndarray, k: int, none: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest values of each row, all different, without those equal to ``none``."""
    at = key.shape[1] - min(k, key.shape[1])
    return np.nonzero(key >= np.maximum(np.partition(key, at, axis=1)[:, at], none + 1)[:, None])


def search_cell(ids: np.ndarray, home: np.ndarray, m: np.ndarray, seed: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, neighbour, cosine) found in one cell.  Stored rows widen their
    windows until the k-th neighbour lies well inside; visiting queries open the
    window that 19 of 20 stored rows needed.  Pairs count for both sides."""
    order = np.argsort(ids, kind="stable")  # places then order ties as ids do
    ids, home, m = ids[order], home[order], m[order]
    h = m @ (directions(PROJECTIONS, m.shape[1], seed) * np.sqrt(m.shape[1])).T
    sx, ix = m[home], ids[home]
    out_q, out_x, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    enough = min(k, len(ix) - 1)
    if not len(ix) or (enough < 1 and home.all()):
        return out_q[0], out_x[0], out_s[0]
    arrays = Arrays(h[home])
    wide = np.int64(max(len(ids), 1))
    kind = np.int32 if wide < 1 << 14 else np.int64
    none = np.iinfo(kind).min

    known = np.full(len(ix), -2, np.float32)  # cosine of each stored row's k-th neighbour so far
    place = np.cumsum(home) - 1
    columns = np.arange(len(ix), dtype=kind)[None, :]

    def look(rows: np.ndarray, half: float) -> np.ndarray:
        """Keeps the best pairs of each row, and of visitors those that are better
        than what a stored row has; gives the distance of each row's k-th neighbour,
        infinite if there are fewer."""
        reached = np.full(len(rows), np.inf)
        for s in range(0, len(rows), 512):
            part = rows[s : s + 512]
            met = arrays.collisions(h[part], half) >= COLLISIONS
            own = np.flatnonzero(home[part])
            met[own, place[part[own]]] = False
            cos = m[part] @ sx.T
            q, x = most(np.where(met, np.rint(cos * np.float32(10**DECIMALS)).astype(kind) * kind(wide) - columns, none), k, none)
            out_q.append(ids[part][q]), out_x.append(ix[x]), out_s.append(cos[q, x])
            n = np.bincount(q, minlength=len(part))
            worst = np.full(len(part), np.inf, np.float32)
            np.minimum.at(worst, q, cos[q, x])
            full = np.flatnonzero((n >= enough) & (n > 0))
            reached[s + full] = np.sqrt(np.maximum(2 - 2 * worst[full], 0))
            if len(own):
                some = full[home[part[full]]]
                known[place[part[some]]] = np.where(n[some] >= k, worst[some], -2)
            else:
                y, c = np.nonzero(met & (cos >= known[None, :] - np.float32(1e-4)))
                out_q.append(ix[c]), out_x.append(ids[part][y]), out_s.append(cos[y, c])
        return reached

    active, needed = np.flatnonzero(home), []
    for step in range(ROUNDS + 1):
        half = WIDTH * GROWTH**step if step < ROUNDS else np.inf
        far = look(active, half) * REACH
        done = far <= half
        needed.append(np.maximum(far[done], WIDTH * REACH))
        active = active[~done]
        if not len(active) or np.isinf(half):
            break
    widths = np.concatenate(needed)
    look(np.flatnonzero(~home), float(np.quantile(widths, 0.95)) if len(widths) > k and np.isfinite(widths).all() else np.inf)
    q, x, s = np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_s)
    keep = best(q, x, s, k)
    return q[keep], x[keep], s[keep]


def best(q: np.ndarray, x: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best distinct (q, x) by cosine, ties to the smaller x."""
    o = np.lexsort((x, -np.round(s, DECIMALS), q))
    o = o[np.r_[True, (q[o][1:] != q[o][:-1]) | (x[o][1:] != x[o][:-1])]] if len(o) else o  # a pair has one cosine, so its copies are neighbours
    first = np.r_[True, q[o][1:] != q[o][:-1]] if len(o) else np.zeros(0, bool)
    rank = np.arange(len(o)) - np.maximum.accumulate(np.where(first, np.arange(len(o)), 0))
    return o[rank < k]


def nearest(vectors: DataFrame, k: int = K) -> DataFrame:
    """(id, neighbour, score, rank) of vectors(id, embedding) with distinct vectors."""
    sizes = vectors.where("embedding is not null and size(embedding) > 0").groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    n, dim = (first["n"], first["dim"]) if first else (0, 1)
    cells = Cells(vectors, dim, n)

    def run(batches: pa.Table) -> pa.Table:
        t = batches.combine_chunks()
        m = unpacked(t.column("vec"), dim)
        q, x, s = search_cell(t.column("id").to_numpy(), np.array(t.column("home").to_pylist(), bool), m, 50_000 + t.column("cell")[0].as_py(), k)
        return pa.table({"id": pa.array(q, pa.int64()), "neighbour": pa.array(x, pa.int64()), "score": pa.array(s.astype(np.float32), pa.float32())})

    # tasks grow in number with the cells, not in size
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cells.count // TASK_CELLS))
    found = assign(vectors, dim, cells).repartition(parts, "cell").groupBy("cell").applyInArrow(run, "id bigint, neighbour bigint, score float").repartition(parts, "id")
    lists = materialise(ranked(found, k).drop("rank"), "lists")
    return ranked(lists.unionByName(regrouped(vectors, lists, dim, k, parts)), k)


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    """(id, neighbour, score, rank): the k best of (id, neighbour, score), ties to the smaller neighbour."""
    w = W.partitionBy("id").orderBy(F.desc(F.round("score", DECIMALS)), "neighbour")
    return pairs.groupBy("id", "neighbour").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def within(label: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, neighbour, cosine): the k best of each row among those of its label.  Rows
    are sorted by label and id.  Small groups are compared whole, several at once."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
    ends = np.flatnonzero(np.diff(label, append=label[-1:] + 1)) + 1
    start, g = 0, 0
    while start < len(label):
        g = max(int(np.searchsorted(ends, start + BLOCK_ROWS, side="right")), g + 1)
        rows = slice(start, int(ends[g - 1]))
        start, (l, i, x) = rows.stop, (label[rows], ids[rows], m[rows])
        if len(i) > 4 * CELL_ROWS:
            centres = x[:: CELL_ROWS]
            at = nearest_centres(x, centres, 4)[0]
            for c in range(len(centres)):
                r, place = np.nonzero(at == c)
                out.append(search_cell(i[r], place == 0, x[r], c, k))
        elif len(i) > BLOCK_ROWS:
            out.append(search_cell(i, np.ones(len(i), bool), x, 0, k))
        else:
            cos = x @ x.T
            mates = l[:, None] == l[None, :]
            np.fill_diagonal(mates, False)
            q, n = most(np.where(mates, np.rint(cos * np.float32(10**DECIMALS)).astype(np.int32) * np.int32(len(i)) - np.arange(len(i), dtype=np.int32)[None, :], np.iinfo(np.int32).min), k, np.iinfo(np.int32).min)
            out.append((i[q], i[n], cos[q, n]))
    return tuple(np.concatenate(c) for c in zip(*out))


def regrouped(vectors: DataFrame, lists: DataFrame, dim: int, k: int, parts: int) -> DataFrame:
    """(id, neighbour, score) among rows that share a label, see above.  A vector is
    exchanged once to meet its labels and once for each, of which near rows share most."""
    edges = lists.select("id", "neighbour").unionByName(lists.select("id", F.col("id").alias("neighbour")).distinct())
    label = edges.groupBy("id").agg(F.max(F.xxhash64("neighbour")).alias("label"))
    label = edges.join(label.withColumnRenamed("id", "neighbour"), "neighbour").groupBy("id").agg(F.max("label").alias("label"))
    labels = edges.join(label.withColumnRenamed("id", "neighbour"), "neighbour").groupBy("id").agg(F.collect_set("label").alias("labels"))

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, ok = matrix(b.column(1), dim)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), packed(m, ok)], names=["id", "vec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, ids, m = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dim), np.float32)

        def pairs(rows: int) -> pa.RecordBatch:
            q, x, s = within(label[:rows], ids[:rows], m[:rows], k)
            keep = best(q, x, s, k)  # a row stands in several groups
            return pa.RecordBatch.from_arrays([pa.array(q[keep]), pa.array(x[keep]), pa.array(s[keep].astype(np.float32))], names=["id", "neighbour", "score"])

        for b in batches:
            if b.num_rows:
                label, ids, m = np.r_[label, b.column(0).to_numpy()], np.r_[ids, b.column(1).to_numpy()], np.vstack([m, unpacked(b.column(2), dim)])
                whole = int(np.searchsorted(label, label[-1]))  # the last label may go on
                if whole:
                    yield pairs(whole)
                    label, ids, m = label[whole:], ids[whole:], m[whole:]
        if len(label):
            yield pairs(len(label))

    vec = vectors.select("id", "embedding").mapInArrow(halves, "id bigint, vec binary")
    met = vec.join(labels, "id").select(F.explode("labels").alias("label"), "id", "vec")
    return met.repartition(parts, "label").sortWithinPartitions("label", "id").mapInArrow(run, "id bigint, neighbour bigint, score float")


def neighbours(vectors: DataFrame, k: int = K) -> DataFrame:
    """(id, neighbour, score, rank) of vectors(id, embedding); equal vectors are
    searched once and then spread to their ids."""
    v = vectors.where("id is not null and embedding is not null and size(embedding) > 0")
    key = F.struct(F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    ids = v.select("id", key.alias("key")).distinct()
    reps = ids.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    member = materialise(ids.join(reps, "key").select("id", "rep", "copies"), "members")
    repeated = materialise(member.where("copies > 1").select("id", "rep"), "copies")
    rest = small(materialise(repeated.where("id <> rep").select("id"), "spare"))
    one = v.join(rest, "id", "left_anti")
    twice = vectors.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select("id")
    twice = small(materialise(twice, "twice"))
    single = one.join(twice, "id", "left_anti").unionByName(one.join(twice, "id", "left_semi").dropDuplicates(["id"]))
    found = materialise(nearest(single.select("id", "embedding"), k), "nearest")
    if repeated.isEmpty():
        return found
    # the k + 1 smallest ids of a class serve all that look for it
    wr = W.partitionBy("rep").orderBy("id")
    firsts = repeated.withColumn("r", F.row_number().over(wr)).where(F.col("r") <= k + 1).select("rep", F.col("id").alias("other"))
    stand = found.select(F.col("id").alias("rep"), "neighbour", "score")
    spread = stand.join(firsts.select(F.col("rep").alias("neighbour"), "other"), "neighbour", "left").select("rep", F.coalesce("other", "neighbour").alias("neighbour"), "score")
    own = firsts.select("rep", F.col("other").alias("neighbour"), F.lit(1.0).cast("float").alias("score"))
    lists = spread.unionByName(own)
    wide = member.select("id", "rep").join(lists, "rep").where("id <> neighbour").select("id", "neighbour", "score").distinct()
    w = W.partitionBy("id").orderBy(F.desc(F.round("score", DECIMALS)), "neighbour")
    return wide.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _vectors(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "chunk_vectors").select(F.col("chunk_id").alias("id"), "embedding")


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    n = neighbours(_vectors(spark, base))
    return n.select(F.least("id", "neighbour").alias("chunk_id_a"), F.greatest("id", "neighbour").alias("chunk_id_b")).distinct()


def p1_topk(spark: SparkSession, base: str) -> DataFrame:
    """The list itself: neighbours of every vector in order."""
    return neighbours(_vectors(spark, base)).select(F.col("id").alias("chunk_id"), F.col("neighbour").alias("neighbour_id"), F.round(F.col("score").cast("double"), 3).alias("score"), "rank")
