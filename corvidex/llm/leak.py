"""Problem 9: evaluation passages inside training documents.

Method: size-partitioned MinHash containment search, then exact shingle
containment.  A leaked part is a run of RUN consecutive words; the set of its
SHINGLE-word shingles has one fixed size, so all search domains lie in one size
partition and containment 1 means Jaccard 1: a run and its copy always have the
same MinHash signature, whatever the length of the document around it.  Every
RUN-word window of a document and of an item gives a signature of HASHES
minima; items meet documents on equal signatures, and candidates are verified
by exact containment of RUN-word shingles.  Short items and long documents thus
meet at equal sizes, which is what the size partition is for.

Text is compared in lower case without accents, punctuation, spacing and line
breaks; words split by a hyphen at a line end are read both joined and split.

Defined cases: null, empty and shorter texts contain no run; repeated rows and
copies of an item count for each id; ties cannot occur (the result is a set).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, mix64, small, table
from .wordhash import Words, blocks, flat, fold, running_min, shingles, split

RUN = 12
SHINGLE = 5
HASHES = 3
#: Signatures sought are sent to the workers only up to so many (16 MB); beyond it the join alone decides.
SENT = 2_000_000

_HYPHEN = re.compile("(?<=[^\\W\\d_])[-\u2010\u00ad\u00ac]\\s*\\n\\s*(?=[^\\W\\d_])")
_MEMO = Words(accents=False)


def readings(text: str | None) -> list[list[str]]:
    """The text's words; a second reading with line-end hyphens joined if there are any."""
    if not text:
        return []
    out = [split(text)]
    if _HYPHEN.search(text):
        out.append(split(_HYPHEN.sub("", text)))
    return out


def signatures(h: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature of every RUN-word window within one text, number of the text)."""
    s = shingles(h, SHINGLE)
    span = RUN - SHINGLE + 1
    if len(s) < span:
        return s[:0], who[:0]
    sig = np.zeros(len(s) - span + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            sig = mix64(sig * np.uint64(31) + running_min(s if k == 0 else mix64(s + np.uint64(k)), span))
    inside = who[: len(sig)] == who[RUN - 1 : RUN - 1 + len(sig)]
    return sig[inside], who[: len(sig)][inside]


def minima(df: DataFrame, id_col: str, text_col: str, sought: np.ndarray | None = None) -> DataFrame:
    """(id, m): window signatures of each text; only those in ``sought`` if given."""
    spark = df.sparkSession
    sent = None if sought is None else spark.sparkContext.broadcast(np.sort(sought))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for ws in readings(t):
                    if len(ws) >= RUN:
                        ids.append(i), lists.append(ws)
            ids = np.array(ids, np.int64)
            out_i, out_m = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for start, part in blocks(lists):
                m, who = signatures(*flat(part, _MEMO))
                if sent is not None and len(m) and len(sent.value):
                    at = np.minimum(np.searchsorted(sent.value, m), len(sent.value) - 1)
                    hit = sent.value[at] == m
                    m, who = m[hit], who[hit]
                elif sent is not None:
                    m, who = m[:0], who[:0]
                out_i.append(ids[start + who]), out_m.append(m)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_i)), pa.array(np.concatenate(out_m).view(np.int64))], names=["id", "m"])

    return df.select(F.col(id_col).cast("bigint"), F.col(text_col)).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).mapInArrow(run, "id bigint, m bigint")


def run_set(text: str | None) -> set[tuple[str, ...]]:
    """Every RUN-word shingle of a text, as words."""
    return {tuple(ws[k : k + RUN]) for ws in ([fold(w) for w in r] for r in readings(text)) for k in range(len(ws) - RUN + 1)}


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): docs(doc_id, text) that hold a run of RUN words of items(item_id, text)."""
    sought = materialise(minima(items, "item_id", "text").distinct().select(F.col("id").alias("item_id"), "m"), "sought")
    few = sought.count() <= SENT
    wanted = np.array([r["m"] for r in sought.select("m").distinct().collect()], np.int64).view(np.uint64) if few else None
    pairs = materialise(minima(docs, "doc_id", "text", wanted).join(small(sought), "m").select(F.col("id").alias("doc_id"), "item_id").distinct(), "pairs")
    per_doc = pairs.groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    texts = docs.select("doc_id", "text").join(small(materialise(per_doc, "per_doc")), "doc_id")
    asked = texts.select("doc_id", "text", F.explode("items").alias("item_id")).join(small(materialise(items.select("item_id", F.col("text").alias("item")).distinct(), "items")), "item_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, set] = {}
        for b in batches:
            keep, last, grams = [], None, set()
            for d, t, item in zip(*(b.column(k).to_pylist() for k in range(3))):
                if (d, t) != last:
                    last, grams = (d, t), run_set(t)
                if item not in memo:
                    memo[item] = run_set(item)
                keep.append(not grams.isdisjoint(memo[item]))
            yield b.select([0, 3]).filter(pa.array(keep, pa.bool_()))

    return asked.select("doc_id", "text", "item", "item_id").mapInArrow(verify, "doc_id bigint, item_id bigint").distinct()


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    return contained(table(spark, base, "documents"), table(spark, base, "benchmark"))


def p9_report(spark: SparkSession, base: str) -> DataFrame:
    """For each item with a leak: its question and the number of documents that hold it."""
    hits = contained(table(spark, base, "documents"), table(spark, base, "benchmark"))
    items = table(spark, base, "benchmark").select("item_id", "gt_id").distinct()
    return hits.groupBy("item_id").agg(F.count("*").alias("n_docs")).join(items, "item_id").select("item_id", "gt_id", "n_docs")
