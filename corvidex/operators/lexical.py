"""Lexical channel: inverted index restricted to the query vocabulary, BM25, pseudo-relevance feedback.

All functions take and give DataFrames for all queries at once.  A chunk is
(chunk_id bigint, text), a query (query_id, query).  Null texts have length 0
and still count in N and in the mean length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..session import materialise
from . import sums

#: Decimals kept before ranking, so that summation order decides no tie.
DECIMALS = 9


def top_k(df: DataFrame, k: int, keys: tuple[str, ...] = ("query_id",), score: str = "score", tie: str = "chunk_id") -> DataFrame:
    """Best k rows by score, ties to the smaller id; Spark limits each partition before the exchange."""
    w = W.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term): distinct tokens of each query."""
    return queries.select("query_id", F.explode(F.array_distinct(T.tokenize(F.coalesce("query", F.lit(""))))).alias("term")).distinct()


def tokenised(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", T.tokenize(F.coalesce("text", F.lit(""))).alias("tokens"))


#: Terms of queries that are sent to every task; beyond, texts are exploded and joined with them.
ROW_TERMS = 500_000


def idf(df: Column, n: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def _lists(of: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of each element."""
    return np.repeat(np.arange(len(of)), np.diff(of.offsets.to_numpy())), of.flatten().to_numpy(zero_copy_only=False)


def _counts(vocabulary: pa.Array):
    """Rows (chunk_id, words) -> (chunk_id, dl, ts, ns): tokens, numbers of the terms of the vocabulary and how often each stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = pa.array(T.STOPWORDS)
        for b in batches:
            words = pc.split_pattern(b.column(1), " ")
            flat = words.flatten()
            row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
            token = pc.and_(pc.greater(pc.utf8_length(flat), 1), pc.invert(pc.is_in(flat, stop))).to_numpy(zero_copy_only=False)
            term = pc.fill_null(pc.index_in(flat, vocabulary), -1).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(term >= 0)
            key, n = np.unique(row[hit] * len(vocabulary) + term[hit], return_counts=True)
            r, t = np.divmod(key, max(len(vocabulary), 1))
            ends = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(words)))]).astype(np.int32)
            listed = lambda x: pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32)))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.bincount(row[token], minlength=len(words)).astype(np.int32)), listed(t), listed(n)], ["chunk_id", "dl", "ts", "ns"])

    return run


def _parts(weight: np.ndarray, avgdl: float, k1: float, b: float):
    """What each term gives to each chunk, for rows (chunk_id, dl, ts, ns)."""

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dl = batch.column(1).to_numpy().astype(np.float64)
        c, t = _lists(batch.column(2))
        tf = _lists(batch.column(3))[1].astype(np.float64)
        return t.astype(np.int64), c, weight[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[c] / avgdl))

    return run


class _Counted:
    """Chunks reduced to their length and the counts of the terms(query_id, term), written."""

    def __init__(self, chunks: DataFrame, terms: DataFrame):
        self.terms, self.n_pairs = terms, terms.count()
        self.sent = self.n_pairs <= ROW_TERMS
        (self._send if self.sent else self._join)(chunks)

    def _send(self, chunks: DataFrame) -> None:
        """Terms and queries as numbers: (chunk_id, dl, ts, ns), and the driver's share of at most ROW_TERMS pairs."""
        spark = chunks.sparkSession
        pairs = self.terms.select("query_id", "term").toArrow()
        ids, vocabulary = pairs["query_id"].unique(), pairs["term"].unique()
        self.ids, self.vocabulary = ids.to_pylist(), vocabulary
        self.groups = sums.Groups(pc.index_in(pairs["query_id"], ids).to_numpy().astype(np.int64), pc.index_in(pairs["term"], vocabulary).to_numpy().astype(np.int64))
        words = chunks.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), T.word_line(F.coalesce("text", F.lit(""))).alias("words"))
        self.table = materialise(words.mapInArrow(_counts(self.vocabulary), "chunk_id bigint, dl int, ts array<int>, ns array<int>"), "index")
        stats = self.table.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
        self.n, self.avgdl = stats["n"], stats["avgdl"] or 1.0
        df = np.zeros(len(self.vocabulary))
        held = self.table.select(F.explode("ts").alias("t")).groupBy("t").agg(F.count("*").alias("c")).toArrow()
        df[held["t"].to_numpy()] = held["c"].to_numpy()
        self.idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        self.weights = spark.createDataFrame([(t, float(w)) for t, w, c in zip(self.vocabulary.to_pylist(), self.idf, df) if c], "term string, idf double")

    def _join(self, chunks: DataFrame) -> None:
        """The same by joins: postings(term, chunk_id, tf, dl)."""
        asked = self.terms.select("term").distinct()
        one = tokenised(chunks).select("chunk_id", F.size("tokens").alias("dl"), F.explode_outer("tokens").alias("term"))
        hit = one.join(asked.withColumn("hit", F.lit(True)), "term", "left")
        per = hit.groupBy("chunk_id", "dl", F.when(F.col("hit"), F.col("term")).alias("term")).agg(F.count("*").alias("n"))
        out = per.groupBy("chunk_id", "dl").agg(F.filter(F.collect_list(F.struct("term", "n")), lambda s: s["term"].isNotNull()).alias("tf"))
        self.table = materialise(out, "index")
        self.postings = self.table.select("chunk_id", "dl", F.explode("tf").alias("x")).select("x.term", "chunk_id", F.col("x.n").alias("tf"), "dl")
        self.stats = self.table.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))  # one row
        w = self.postings.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(self.stats))
        self.weights = w.select("term", idf(F.col("df"), F.col("n")).alias("idf"))

    def bm25(self, k: int, k1: float, b: float) -> DataFrame:
        if self.sent:
            spark = self.table.sparkSession
            got = sums.top_sums(self.table, _parts(self.idf, self.avgdl, k1, b), len(self.vocabulary), self.groups, k, self.n)
            ids = spark.createDataFrame(list(enumerate(self.ids)), StructType([StructField("q", IntegerType()), StructField("query_id", self.terms.schema["query_id"].dataType)]))
            return top_k(got.join(F.broadcast(ids), "q").select("query_id", "chunk_id", F.round("score", DECIMALS).alias("score")), k)  # at most ROW_TERMS ids
        part = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
        scored = self.postings.join(self.weights, "term").crossJoin(F.broadcast(self.stats.select("avgdl"))).withColumn("part", part).join(self.terms, "term")
        return top_k(scored.groupBy("query_id", "chunk_id").agg(F.round(F.sum("part"), DECIMALS).alias("score")), k)


class Index:
    """Inverted index of chunks(chunk_id, text) for queries(query_id, query).

    Texts are tokenised once: a row is reduced to its length and the counts of the
    terms that any query asks for, and the result is written.  Document frequencies,
    N, the mean length and the scores all come from that table.  With feedback the
    terms are found in a second pass over the few chunks it needs, and counted in
    one more scan."""

    def __init__(self, chunks: DataFrame, queries: DataFrame):
        self.chunks = chunks
        self.terms = materialise(query_terms(queries), "terms")
        self.counted = _Counted(chunks, self.terms)

    def bm25(self, k: int = 1000, k1: float = 1.2, b: float = 0.75, terms: DataFrame | None = None) -> DataFrame:
        """(query_id, chunk_id, score, rank): BM25 over distinct query terms, or over ``terms(query_id, term)``."""
        return (self.counted if terms is None else _Counted(self.chunks, terms)).bm25(k, k1, b)

    def feedback_terms(self, feedback: int = 10, terms: int = 10) -> DataFrame:
        """(query_id, term, weight): expansion terms from the first ``feedback``
        chunks of a first pass: chunks that hold the term times its idf in the
        query vocabulary, or the count where it has none."""
        first = materialise(self.bm25(feedback).select("query_id", "chunk_id"), "first")
        few = self.chunks.join(first.select("chunk_id").distinct(), "chunk_id", "left_semi")
        held = tokenised(few).select("chunk_id", F.explode(F.array_distinct("tokens")).alias("term"))
        counts = first.join(held, "chunk_id").groupBy("query_id", "term").agg(F.count("*").alias("c"))
        weight = F.round(F.coalesce(F.nullif(F.col("c") * F.coalesce("idf", F.lit(0.0)), F.lit(0.0)), F.col("c").cast("double")), DECIMALS)
        fresh = counts.join(self.terms, ["query_id", "term"], "left_anti").join(self.counted.weights, "term", "left").select("query_id", "term", weight.alias("weight"))
        return top_k(fresh, terms, score="weight", tie="term")

    def expanded(self, feedback: int = 10, terms: int = 10) -> DataFrame:
        """(query_id, term): query terms with their expansion."""
        return materialise(self.terms.unionByName(self.feedback_terms(feedback, terms).select("query_id", "term")).distinct(), "expanded")


def bm25(chunks: DataFrame, queries: DataFrame, k: int = 1000, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, chunk_id, score, rank): BM25 over distinct query terms."""
    return Index(chunks, queries).bm25(k, k1, b)


def rm3_terms(chunks: DataFrame, queries: DataFrame, feedback: int = 10, terms: int = 10) -> DataFrame:
    """(query_id, term, weight): the feedback's expansion terms."""
    return Index(chunks, queries).feedback_terms(feedback, terms)
