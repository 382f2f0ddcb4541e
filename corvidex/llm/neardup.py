"""Problem 5: groups of lightly edited copies.

Method: improved consistent weighted sampling over TF-IDF weighted word
shingles, banded; candidates are verified.  Texts that read the same form one
class first, so copies cost nothing further.  A shingle's weight is its term
frequency times its inverse document frequency, counted over all texts in a
fixed table of hashed counters (a few neighbours share a counter, at any size).
Each weighted sample is a pair
(shingle, quantised weight) that two texts share with the probability of their
weighted Jaccard similarity; BANDS bands of ROWS samples make the buckets.  In
a bucket texts are ordered by one further sample, another in every band, so
groups that share a bucket lie apart in it; every text meets its neighbours, the
first of the bucket and the first with the same further sample, so n texts give
O(n) candidates; buckets are range-sorted, so a large one is spread over tasks.  What
the components of these leave open is then compared whole: in every bucket of
several components, all pairs of texts of different ones.  So every two texts that
share a bucket are compared or known to be of one group, whatever the bucket's
size.  Candidates whose samples agree too rarely (sketches of four bits a
sample) are dropped before any text is compared; the rest are verified by the similarity
asked for (the unweighted share of common shingles), which is exact.

Defined cases: null, empty and shorter texts are in no group; repeated rows
count once; equal texts of different ids are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import chunk_texts, materialise, mix64, small
from .components import components
from .wordhash import Runs, Words, blocks, flat_runs, shingles_of

#: TESTDATA.md's definition: three-word shingles, half of them shared, 40 words or more.
SHINGLE, THRESHOLD, MIN_WORDS = 3, 0.5, 40
BANDS, ROWS = 32, 3
#: Bands of unweighted samples beside them, for large groups: the shingles a third of all texts share weigh little,
#: but so large a group needs a small chance a pair.
PLAIN_BANDS, PLAIN_ROWS = 6, 8
#: Hashed document-frequency counters (1 MB), fixed at every size.
COUNTERS = 1 << 18
PIECES = 64
#: Neighbours in a bucket that a text meets, besides the firsts; low bits of a bucket's number that hold the further sample.
NEIGHBOURS, REFINED = 4, 20
#: Pairs of one bucket that a task compares (a larger bucket is divided among tasks), and at once.
TASK_PAIRS, BLOCK_PAIRS = 1 << 28, 1 << 16
NAME_BITS = 10
#: Bits of a shingle's hash that are kept (a block holds fewer than 2 ** (64 - BITS) texts).
BITS = 46
#: Samples that must agree in their four-bit sketches before a pair's texts are compared: far below what THRESHOLD gives.
AGREE, PLAIN_AGREE = 20, 16
#: Texts drawn for at once.
DRAWN = 8
#: Rows of random variates, and steps of the logarithm of a weight.
TABLE, LEVELS, LOG_WEIGHTS = 1 << 12, 20, (-2.5, 3.5)
#: A shingle's weight is tf x log(1 + N / (DAMP x df)): shingles of the stock phrases of a corpus weigh next to nothing.
DAMP = 12
_MEMO = Runs(Words(accents=True))


def distinct(sh: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, text, times) of the distinct shingles of each text, by text: one
    sort of keys that hold the text's number above BITS bits of the hash."""
    if not len(sh):
        return sh, who, who
    key = np.sort((who.astype(np.uint64) << np.uint64(BITS)) | (sh >> np.uint64(64 - BITS)))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    u = key[first]
    return u & np.uint64((1 << BITS) - 1), (u >> np.uint64(BITS)).astype(np.int64), np.diff(first, append=len(key))


def keys_and_counts(df: DataFrame, min_words: int) -> DataFrame:
    """One pass: (id, h1, h2) of each long enough text, and partial counters of
    shingle document frequency (block, counts)."""
    size = COUNTERS // PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        total = np.zeros(COUNTERS, np.int32)
        for b in batches:
            given = b.column(0).to_numpy()
            ids, k1, k2 = [], [], []
            for start, part in blocks([t.split() if t else [] for t in b.column(1).to_pylist()]):
                h, who = flat_runs(part, _MEMO)
                enough = np.bincount(who, minlength=len(part)) >= min_words
                h, who = h[enough[who]], (np.cumsum(enough) - 1)[who[enough[who]]]
                ids.append(given[start + np.flatnonzero(enough)])
                ends = np.flatnonzero(np.diff(who, append=-1)) + 1
                for x, y in zip(np.r_[0, ends[:-1]], ends):
                    d = xxhash.xxh3_128_intdigest(h[x:y].tobytes())
                    k1.append((d >> 64) - (1 << 63)), k2.append((d & ((1 << 64) - 1)) - (1 << 63))
                total += np.bincount(counter(distinct(*shingles_of(h, who, SHINGLE))[0]), minlength=COUNTERS).astype(np.int32)
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names=_PASS1)
        none = [None] * PIECES
        counts = [total[k * size : (k + 1) * size].tobytes() for k in range(PIECES)]
        yield pa.RecordBatch.from_arrays([pa.array(none, pa.int64())] * 3 + [pa.array(range(PIECES), pa.int32()), pa.array(counts, pa.binary())], names=_PASS1)

    return df.select("id", "text").mapInArrow(run, "id bigint, h1 bigint, h2 bigint, block int, counts binary")


_PASS1 = ["id", "h1", "h2", "block", "counts"]


def add_counts(partial: DataFrame) -> np.ndarray:
    """Sums the counters by block in the executors; the driver gets COUNTERS numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(c, np.int32).astype(np.int64)
                acc[k] = acc[k] + v if k in acc else v
        yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int32()), pa.array([v.astype(np.int32).tobytes() for v in acc.values()], pa.binary())], names=["block", "counts"])

    summed = partial.select("block", "counts").where("block is not null").repartition(16, "block").mapInArrow(run, "block int, counts binary")
    out = np.zeros((PIECES, COUNTERS // PIECES), np.int64)
    for r in summed.collect():
        out[r["block"]] = np.frombuffer(bytes(r["counts"]), np.int32)
    return out.ravel()


class Sampler:
    """Improved consistent weighted sampling with K = BANDS x ROWS samples.

    The gamma and uniform variates of a shingle come from one of TABLE rows,
    chosen by its hash, and its weight is rounded to one of LEVELS steps, so the
    sampling values of every (row, level) are computed once a worker and a text
    only looks them up.  The smallest value of a sample, with NAME_BITS bits of the
    shingle's hash in its last places, is the sample: shingles that share a row
    are still told apart."""

    def __init__(self, seed: int = 7, k: int = BANDS * ROWS):
        rng = np.random.default_rng(seed)
        r = rng.gamma(2.0, 1.0, (TABLE, 1, k)).astype(np.float32)
        logc = np.log(rng.gamma(2.0, 1.0, (TABLE, 1, k))).astype(np.float32)
        beta = rng.random((TABLE, 1, k)).astype(np.float32)
        logw = np.linspace(*LOG_WEIGHTS, LEVELS, dtype=np.float32)[None, :, None]
        t = np.floor(logw / r + beta)
        self.a = self.ordered((logc - r * (t - beta + 1)).reshape(TABLE * LEVELS, k))
        self.plain = self.ordered(rng.random((TABLE * LEVELS, PLAIN_BANDS * PLAIN_ROWS), dtype=np.float32))

    @staticmethod
    def ordered(x: np.ndarray) -> np.ndarray:
        """Floats as integers of the same order, the low NAME_BITS bits free for the shingle's name."""
        b = x.view(np.uint32)
        return np.where(b >> 31, ~b, b | np.uint32(1 << 31)) & np.uint32(~((1 << NAME_BITS) - 1) & 0xFFFFFFFF)

    def rows(self, sh: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Row of (shingle, weight) in the table."""
        lo, hi = LOG_WEIGHTS
        level = np.clip(np.rint((np.log(weight) - lo) * ((LEVELS - 1) / (hi - lo))), 0, LEVELS - 1).astype(np.int64)
        return ((sh >> np.uint64(20)).astype(np.int64) & (TABLE - 1)) * LEVELS + level

    def plain_rows(self, sh: np.ndarray) -> np.ndarray:
        """Row of a shingle in the table of unweighted samples."""
        return ((sh >> np.uint64(19)) % np.uint64(TABLE * LEVELS)).astype(np.int64)

    def draw(self, table: np.ndarray, row: np.ndarray, sh: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sample hashes of each set; ``starts`` are the sets' first rows.  A few sets at a
        time, in one buffer, so that their values stay in the processor's cache."""
        k = table.shape[1]
        name = ((sh >> np.uint64(34)) & np.uint64((1 << NAME_BITS) - 1)).astype(np.uint32)[:, None]
        out = np.empty((len(starts), k), np.uint32)
        ends = np.r_[starts[1:], len(row)]
        buffer = np.empty((0, k), np.uint32)
        for s in range(0, len(starts), DRAWN):
            a, b = starts[s], ends[min(s + DRAWN, len(starts)) - 1]
            if b - a > len(buffer):
                buffer = np.empty((b - a, k), np.uint32)
            values = np.take(table, row[a:b], axis=0, out=buffer[: b - a], mode="clip")
            values |= name[a:b]
            np.minimum.reduceat(values, starts[s : s + DRAWN] - a, axis=0, out=out[s : s + DRAWN])
        return mix64(out.astype(np.uint64) + np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_SAMPLER: list[Sampler] = []
#: Bytes of a sketch: the weighted samples first, then the unweighted ones.
SKETCH = (BANDS * ROWS + PLAIN_BANDS * PLAIN_ROWS) // 2


def banded(s: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """One number for each band of samples: its low REFINED bits come from the next band's first sample."""
    h = np.broadcast_to((np.arange(bands, dtype=np.uint64) + np.uint64(1 + 1000 * seed)) * np.uint64(0xD1342543DE82EF95), (len(s), bands)).copy()
    with np.errstate(over="ignore"):
        for j in range(rows):
            h = mix64(h * np.uint64(31) + s[:, j::rows])
    return ((h >> np.uint64(REFINED)) << np.uint64(REFINED)) | (np.roll(s[:, ::rows], -1, axis=1) >> np.uint64(64 - REFINED))


def samples(df: DataFrame, counts: np.ndarray, n: int) -> DataFrame:
    """(id, buckets, sketch): BANDS bucket hashes and a four-bit sketch of the samples of each text."""
    sent = df.sparkSession.sparkContext.broadcast(counts.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _SAMPLER:
            _SAMPLER.append(Sampler())
        sampler, freq = _SAMPLER[0], sent.value
        for b in batches:
            given, ids = b.column(0).to_numpy(), [np.zeros(0, np.int64)]
            every, bits = [np.zeros((0, BANDS + PLAIN_BANDS), np.uint64)], [np.zeros((0, SKETCH), np.uint8)]
            for start, part in blocks([t.split() for t in b.column(1).to_pylist()]):
                sh, who, tf = distinct(*shingles_of(*flat_runs(part, _MEMO), SHINGLE))
                rows = sampler.rows(sh, tf * np.log1p(n / (DAMP * np.maximum(freq[counter(sh)], 1))))
                some, starts = np.unique(who, return_index=True)  # another text of a chosen id may be short
                if not len(some):
                    continue
                ids.append(given[start + some])
                w, p = sampler.draw(sampler.a, rows, sh, starts), sampler.draw(sampler.plain, sampler.plain_rows(sh), sh, starts)
                every.append(np.hstack([banded(w, BANDS, ROWS, 1), banded(p, PLAIN_BANDS, PLAIN_ROWS, 2)]))
                nib = (np.hstack([w, p]) >> np.uint64(60)).astype(np.uint8)
                bits.append(nib[:, ::2] | (nib[:, 1::2] << 4))
            keys = np.concatenate(every)
            ends = np.arange(len(keys) + 1, dtype=np.int32) * (BANDS + PLAIN_BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64))), fixed(np.concatenate(bits))], names=["id", "buckets", "sketch"])

    return df.select("id", "text").mapInArrow(run, "id bigint, buckets array<bigint>, sketch binary")


def counter(sh: np.ndarray) -> np.ndarray:
    """Place of a shingle in the document-frequency counters."""
    return (sh & np.uint64(COUNTERS - 1)).astype(np.int64)


def fixed(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def words(col: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(len(col), SKETCH // 8)


def agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sketches agree in AGREE weighted samples or PLAIN_AGREE unweighted ones; rows are broadcast."""
    cut = BANDS * ROWS // 16
    differ = []
    for some in (range(cut), range(cut, SKETCH // 8)):
        total = np.zeros(np.broadcast_shapes(x.shape[:-1], y.shape[:-1]), np.uint8)
        for j in some:
            d = x[..., j] ^ y[..., j]
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            total += np.bitwise_count(d & np.uint64(0x1111111111111111))
        differ.append(total)
    return (differ[0] <= BANDS * ROWS - AGREE) | (differ[1] <= PLAIN_BANDS * PLAIN_ROWS - PLAIN_AGREE)


def agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sketches agree in AGREE samples or more, about 50 bytes a text moved."""
    s = sketches.select("id", "sketch").dropDuplicates(["id"])
    j = pairs.join(s.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a").join(s.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.select([0, 1]).filter(pa.array(agree(words(b.column(2)), words(b.column(3)))))

    return j.mapInArrow(run, "a bigint, b bigint")


def candidates(bk: DataFrame) -> DataFrame:
    """The pairs of ``met``."""
    return met(bk)[0]


def met(bk: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((a, b), (id, bucket)) from bk(id, bucket): pairs, and the rows of the buckets in
    which these need not be all pairs: those of more than NEIGHBOURS + 1 rows or at a
    task's edge.  Rows are range-sorted by (bucket, id) in one
    exchange, so a bucket of any size is spread over tasks; each task reads its
    rows in order and pairs a row with the NEIGHBOURS rows of its bucket before it,
    with the first of the bucket and with the first that has the same further
    sample.  The rows at the tasks' edges (NEIGHBOURS + 1 at each) are paired
    across in a second, small step."""
    schema = "a bigint, b bigint, bucket bigint, part int, pos bigint"
    names = ["a", "b", "bucket", "part", "pos"]

    def batch(a, b, bucket=None, part=None, pos=None) -> pa.RecordBatch:
        none = lambda t: pa.nulls(len(a), t)
        cols = [pa.array(a, pa.int64()), pa.array(b, pa.int64()) if b is not None else none(pa.int64())]
        cols += [none(pa.int64()), none(pa.int32()), none(pa.int64())] if bucket is None else [pa.array(bucket, pa.int64()), pa.array(part, pa.int32()), pa.array(pos, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last_id, last_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        head: dict[int, tuple[int, int]] = {}  # shift -> (id, key) of the run that is open
        first = None
        seen = 0
        for rb in batches:
            if not rb.num_rows:
                continue
            i, k = np.r_[last_id, rb.column(0).to_numpy()], np.r_[last_b, rb.column(1).to_numpy()]
            m = len(last_id)
            group = k >> REFINED
            pairs = []
            late = np.arange(max(NEIGHBOURS + 1, m), len(i))
            late = late[group[late] == group[late - NEIGHBOURS - 1]]
            crowd = np.unique((late[:, None] - np.arange(NEIGHBOURS + 2)[None, :]).ravel())
            for o in range(1, NEIGHBOURS + 1):
                at = np.arange(max(o, m), len(i))
                same = at[(group[at] == group[at - o]) & (i[at] != i[at - o])]
                pairs.append((i[same - o], i[same]))
            for shift in (REFINED, 0):
                key = k[m:] >> shift
                start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
                firsts = i[m:][start]
                if shift in head and key[0] == head[shift][1]:
                    firsts = np.where(start == 0, head[shift][0], firsts)
                far = firsts != i[m:]
                pairs.append((firsts[far], i[m:][far]))
                head[shift] = (int(firsts[-1]), int(key[-1]))
            a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            yield batch(np.minimum(a, b), np.maximum(a, b))
            if len(crowd):
                yield batch(i[crowd], None, k[crowd], np.full(len(crowd), -1), np.zeros(len(crowd), np.int64))
            if first is None or len(first[0]) <= NEIGHBOURS:
                first = (i[: NEIGHBOURS + 1], k[: NEIGHBOURS + 1])  # nothing has left the rows kept yet
            seen += len(i) - m
            last_id, last_b = i[-NEIGHBOURS - 1 :], k[-NEIGHBOURS - 1 :]
        if first is not None:
            for side, (x, y) in ((0, first), (1, (last_id, last_b))):
                yield batch(x, None, y, np.full(len(x), part), side * seen + np.arange(len(x)))

    ordered = bk.select("id", "bucket").repartitionByRange("bucket", "id").sortWithinPartitions("bucket", "id")
    x = materialise(ordered.mapInArrow(run, schema), "pairs_and_edges")
    rest = x.where("part is not null").select(F.col("a").alias("id"), F.shiftright("bucket", REFINED).alias("bucket")).distinct()
    edge = x.where("part >= 0").select("part", "pos", F.col("a").alias("id"), F.shiftright("bucket", REFINED).alias("bucket"))
    w = W.orderBy("part", "pos")  # a few rows a task
    before = F.array(*[F.struct(F.lag("id", o).over(w).alias("id"), F.lag("bucket", o).over(w).alias("bucket")) for o in range(1, NEIGHBOURS + 1)])
    across = edge.select("id", "bucket", before.alias("ps")).select("id", "bucket", F.explode("ps").alias("p")).where("p.bucket = bucket and p.id <> id")
    return x.where("part is null").select("a", "b").unionByName(across.select(F.least("p.id", "id").alias("a"), F.greatest("p.id", "id").alias("b"))).distinct(), rest


def left_open(rest: DataFrame, roots: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b): all pairs that share a bucket of rest(id, bucket), lie in different
    components and agree in their sketches.  The pairs of a bucket are counted by its
    rows, those of a large one divided among tasks by the first of the two."""
    r = rest.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = r.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    several = several.select("bucket", F.ceil(F.col("n").cast("double") * F.col("n") / (2 * TASK_PAIRS)).cast("int").alias("parts"))
    r = materialise(r.join(several, "bucket"), "left_open").join(sketches.select("id", "sketch").dropDuplicates(["id"]), "id")
    mine = F.pmod(F.xxhash64("id"), F.col("parts")) == F.col("part")
    r = r.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("bucket", "part", "id", "root", mine.alias("mine"), "sketch")

    def pairs(ids: np.ndarray, root: np.ndarray, own: np.ndarray, sk: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = np.flatnonzero(own)
        step = max(1, BLOCK_PAIRS // len(ids))
        for s in range(0, len(rows), step):
            x = rows[s : s + step]
            for t in range(x[0] + 1, len(ids), BLOCK_PAIRS):
                y = np.arange(t, min(t + BLOCK_PAIRS, len(ids)))
                p, q = np.nonzero(agree(sk[x][:, None], sk[y][None]) & (x[:, None] < y[None, :]) & (root[x][:, None] != root[y][None, :]))
                if len(p):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[x[p]]), pa.array(ids[y[q]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def closed(to_end: bool) -> Iterator[pa.RecordBatch]:
            """Pairs of all buckets that are known to be complete."""
            cols = [np.concatenate(c) for c in zip(*held)]
            bucket, part = cols[:2]
            starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])
            ends = np.r_[starts[1:], len(bucket)]
            n = len(starts) - (not to_end)
            for a, b in zip(starts[:n], ends[:n]):
                yield from pairs(*(c[a:b] for c in cols[2:]))
            held[:] = [tuple(c[starts[n] :] for c in cols)] if n < len(starts) else []

        for b in batches:
            if b.num_rows:
                new = (b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy(), b.column(4).to_numpy(zero_copy_only=False).astype(bool), words(b.column(5)))
                same = held and held[-1][0][-1] == new[0][-1] and held[-1][1][-1] == new[1][-1]
                held.append(new)
                if not same:
                    yield from closed(False)
        if held:
            yield from closed(True)

    return r.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "id").mapInArrow(run, "a bigint, b bigint").distinct()


def sets(df: DataFrame) -> DataFrame:
    """(id, s): distinct shingle hashes of each text, as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vals = []
            for _, part in blocks([t.split() for t in b.column(1).to_pylist()]):
                sh, who, _n = distinct(*shingles_of(*flat_runs(part, _MEMO), SHINGLE))
                vals += np.split(sh.view(np.int64), np.searchsorted(who, np.arange(1, len(part))))
            ends = np.cumsum([0, *map(len, vals)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(vals) if vals else np.zeros(0, np.int64)))], names=["id", "s"])

    return df.select("id", "text").mapInArrow(run, "id bigint, s array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b) whose shingle sets share at least ``threshold`` of their union.  Only
    candidates' texts are turned into sets."""
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "cand_ids")
    s = materialise(sets(texts.join(small(ids), "id", "left_semi")), "sets").dropDuplicates(["id"])
    j = pairs.join(s.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(s.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(*(_lists(b.column(k)) for k in (2, 3))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= threshold * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return j.mapInArrow(run, "a bigint, b bigint")


def _lists(col: pa.Array) -> list[np.ndarray]:
    off, v = col.offsets.to_numpy(), col.values.to_numpy()
    return [v[a:b] for a, b in zip(off, off[1:])]


def groups(df: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """df(id, text) -> ((id, rep): class of equal texts, (rep, root): group of a
    class).  Classes alone in their group are absent from the second."""
    first = materialise(keys_and_counts(df, min_words), "keys")
    counts = add_counts(first)
    keyed = first.where("block is null").select("id", "h1", "h2").distinct()
    reps = keyed.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    member = materialise(keyed.join(reps, ["h1", "h2"]).groupBy("id").agg(F.min("rep").alias("rep")), "member")
    chosen = materialise(member.select(F.col("rep").alias("id")).distinct(), "reps")
    n = chosen.count()
    texts = df.join(small(chosen), "id", "left_semi")  # rows of a repeated id give equal samples, which pair with nothing new
    drawn = materialise(samples(texts, counts, n), "samples")
    pairs, rest = met(drawn.select("id", F.explode("buckets").alias("bucket")))
    pairs = materialise(agreeing(pairs, drawn), "pairs")
    roots = components(verified(pairs, texts, threshold))
    more = materialise(left_open(rest, roots, drawn).join(pairs, ["a", "b"], "left_anti"), "pairs_left_open")
    if more.isEmpty():
        return member, roots
    edges = verified(more, texts, threshold).unionByName(roots.select(F.col("root").alias("a"), F.col("id").alias("b")))
    return member, components(edges)


def classes(df: DataFrame) -> DataFrame:
    """(id, group): every text that counts, with the smallest id of its group."""
    member, roots = groups(df)
    out = member.join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left")
    return out.select("id", F.coalesce("root", "rep").alias("group"))


def _texts(spark: SparkSession, base: str) -> DataFrame:
    return chunk_texts(spark, base).select(F.col("chunk_id").alias("id"), F.col("texto").alias("text")).where("text is not null")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    c = materialise(classes(_texts(spark, base)), "classes")
    a, b = c.select("group", F.col("id").alias("chunk_id_a")), c.select("group", F.col("id").alias("chunk_id_b"))
    return a.join(b, "group").where("chunk_id_a < chunk_id_b").select("chunk_id_a", "chunk_id_b")


def p5_classes(spark: SparkSession, base: str) -> DataFrame:
    """One row a chunk that counts: its group and the group's size."""
    c = materialise(classes(_texts(spark, base)), "classes")
    return c.join(c.groupBy("group").agg(F.count("*").alias("n_members")), "group").select(F.col("id").alias("chunk_id"), F.col("group").alias("group_id"), "n_members")
