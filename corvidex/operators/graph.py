"""Entity graph: mentions, nodes, edges, linking and one-hop expansion.

Mentions: (chunk_id, doc_id, ordinal, entity, group).  Pairs are made within a
chunk only, of all its entities in the frequency band.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..session import materialise
from . import sums
from .chunking import CAPITALS
from .lexical import DECIMALS, top_k

MIN_CHUNKS, CEILING = 3, 0.02
EDGE_CHUNKS, EDGE_DOCS = 40, 20

# Words that are no entity.
NOT_ENTITY = (
    "el", "la", "los", "las", "un", "una", "en", "de", "del", "por", "para",
    "con", "sin", "sobre", "entre", "este", "esta", "estos", "estas", "sus",
    "the", "a", "an", "in", "of", "for", "and", "or", "this", "these", "its",
    "asimismo", "ademas", "sin embargo", "por otro lado", "finalmente",
    "durante", "mientras", "cuando", "aunque", "segun", "tras", "desde",
)
# Words of captions.
CAPTION_WORDS = (
    "figure", "fig", "table", "tabla", "cuadro", "grafico", "chart",
    "ver tabla", "ver figura", "see table", "see figure", "et al", "ibid",
    "op cit", "pp", "vol", "fuente", "source", "nota", "footnote",
)
# Words inside a name, and how many further words a name may have.
INSIDE_NAME = frozenset(("de", "del", "la", "las", "los", "y", "e"))
FURTHER_WORDS = 3
ACRONYM_LETTERS = (2, 6)
_CAPITAL = "[" + re.escape("".join(sorted(CAPITALS))) + "]"
_SHORT = rf"{_CAPITAL}{{{ACRONYM_LETTERS[0]},{ACRONYM_LETTERS[1]}}}(?!\w)"
_ACRONYM = re.compile(rf"(?<!\w){_SHORT}(?:[/-]{_SHORT})?")
_LONG = rf"{_CAPITAL}\w{{2,}}+"
_NAME = re.compile(rf"(?<!\w){_LONG}(?:\s+(?:(?:{'|'.join(sorted(INSIDE_NAME))})\s+)?{_LONG}){{0,{FURTHER_WORDS}}}")


def spans_of(text: str) -> list[tuple[str, str, int, int]]:
    """Acronyms (ORG) and names (MISC) with their places, found in a text.

    An acronym is a word of 2 to 6 capitals, or two of them around a slash or a
    dash.  A name is a capitalised word of three letters or more and up to three
    further ones, each with at most one small word before it; a run without a space
    that opens the text or a sentence is no name."""
    out = [(m[0], "ORG", m.start(), m.end()) for m in _ACRONYM.finditer(text)]
    for m in _NAME.finditer(text):
        name, start = m[0], m.start()
        opens = start == 0 or "." in text[max(0, start - 2) : start]
        if not name.isupper() and name.lower() not in NOT_ENTITY and (" " in name or not opens):
            out.append((name, "MISC", start, m.end()))
    return out


def heuristic_mentions(chunks: DataFrame) -> DataFrame:
    """chunks(chunk_id, text) -> (chunk_id, name, group, start, end), a narrow Arrow map; null texts give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *s) for i, t in zip(b["chunk_id"], b["text"]) if t for s in spans_of(t)]
            yield pd.DataFrame(rows, columns=["chunk_id", "name", "group", "start", "end"])

    return chunks.select("chunk_id", "text").mapInPandas(run, "chunk_id bigint, name string, group string, start int, end int")


def gaps_of(text: str) -> list[str]:
    """Text between each two neighbouring mentions that do not overlap, in order."""
    out, end = [], None
    for _, _, a, b in sorted(spans_of(text), key=lambda m: (m[2], -m[3])):
        if end is not None and a >= end:
            out.append(text[end:a])
        end = b if end is None else max(end, b)
    return out


def gaps(chunks: DataFrame) -> DataFrame:
    """chunks(chunk_id, text) -> (chunk_id, gap_no, between), a narrow Arrow map over whole texts; null texts give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, k, g) for i, t in zip(b["chunk_id"], b["text"]) if t for k, g in enumerate(gaps_of(t))]
            yield pd.DataFrame(rows, columns=["chunk_id", "gap_no", "between"])

    return chunks.select("chunk_id", "text").mapInPandas(run, "chunk_id bigint, gap_no int, between string")


def clean_mentions(mentions: DataFrame) -> DataFrame:
    """Normalised, noise-free mentions: first of each (chunk, entity), with its place among those of the chunk."""
    key = T.norm_entity(F.col("name"))
    x = mentions.withColumn("entity", key)
    ok = (F.length("entity") >= 3) & ~F.col("entity").rlike(r"^[0-9 ]+$") & ~F.col("entity").isin(*NOT_ENTITY, *CAPTION_WORDS) & ~F.col("entity").rlike("^(see|ver) ")
    x = x.where(ok).groupBy("chunk_id", "entity").agg(F.min("start").alias("start"), F.min_by("end", F.struct("start", "end")).alias("end"), F.min_by("group", F.struct("start", "group")).alias("group"))
    w = W.partitionBy("chunk_id").orderBy("start", "entity")
    return x.withColumn("ordinal", F.row_number().over(w))


def kept_entities(mentions: DataFrame, n_chunks: DataFrame, low: int = MIN_CHUNKS, ceiling: float = CEILING, allowed: tuple[str, ...] = ()) -> DataFrame:
    """(entity, frequency) in the frequency band, or on the allow-list; n_chunks is one row (n)."""
    f = mentions.groupBy("entity").agg(F.count_distinct("chunk_id").alias("frequency"))
    top = F.greatest(F.lit(1), F.floor(F.col("n") * ceiling))
    band = (F.col("frequency") >= low) & (F.col("frequency") <= top)
    return f.crossJoin(F.broadcast(n_chunks)).where(band | F.col("entity").isin(*allowed) if allowed else band).select("entity", "frequency")


def nodes(mentions: DataFrame, kept: DataFrame) -> DataFrame:
    """(entity, tipo, frecuencia): type most often seen, ties by name."""
    x = mentions.join(kept.select("entity"), "entity", "left_semi")
    per = x.groupBy("entity", "group").agg(F.count("*").alias("c"))
    tipo = per.withColumn("r", F.row_number().over(W.partitionBy("entity").orderBy(F.desc("c"), "group"))).where("r = 1").select("entity", F.col("group").alias("tipo"))
    return tipo.join(kept.select("entity", F.col("frequency").alias("frecuencia")), "entity")


def pairs(mentions: DataFrame, kept: DataFrame) -> DataFrame:
    """(a, b, chunk_id, relacion): entity pairs of a chunk, a < b; ``label`` of the
    mention pair if the input has one."""
    m = mentions.join(kept.select("entity"), "entity", "left_semi")
    per = m.groupBy("chunk_id").agg(F.array_sort(F.collect_set("entity")).alias("es"))
    i = F.explode(F.transform(F.sequence(F.lit(1), F.size("es") - 1), lambda k: k))
    one = per.where(F.size("es") > 1).select("chunk_id", "es", i.alias("i"))
    return one.select("chunk_id", F.col("es")[F.col("i") - 1].alias("a"), F.explode(F.slice("es", F.col("i") + 1, F.size("es"))).alias("b"))


def labelled_pairs(mentions: DataFrame, kept: DataFrame, chunks: DataFrame) -> DataFrame:
    """(a, b, chunk_id, relacion) and doc_id if chunks have it: entity pairs of a chunk, a < b, labelled by the text
    between their first mentions; pairs too far apart, or that overlap, are bare
    co-occurrences.  mentions(chunk_id, entity, start, end), chunks(chunk_id, text).
    If ``kept`` numbers its entities (e), a and b are numbers, in the order of the names."""
    owner = [c for c in ("doc_id",) if c in chunks.columns]
    number = "e" if "e" in kept.columns else "entity"
    m = mentions.join(kept.select("entity", *{number} - {"entity"}), "entity")
    per = m.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("start", "entity", "end", F.col(number).alias("n")))).alias("m")).where(F.size("m") > 1)
    one = per.join(chunks.select("chunk_id", "text", *owner), "chunk_id").select("chunk_id", "text", *owner, F.posexplode("m").alias("i", "x"), "m")
    two = one.select("chunk_id", "text", *owner, "x", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))
    between = F.when((F.col("y.start") - F.col("x.end")).between(0, T.RELATION_SPAN), F.substring("text", F.col("x.end") + 1, F.col("y.start") - F.col("x.end")))
    label = F.coalesce(T.relation_type(between), F.lit("coocurre_con"))
    first = F.col("x.entity") < F.col("y.entity")
    return two.select("chunk_id", *owner, F.when(first, F.col("x.n")).otherwise(F.col("y.n")).alias("a"), F.when(first, F.col("y.n")).otherwise(F.col("x.n")).alias("b"), label.alias("relacion"))


def edges(pair_rows: DataFrame, min_bare: int = 1) -> DataFrame:
    """(a, b, relacion, peso, chunks, docs): label most often seen (ties by name),
    number of chunks, first EDGE_CHUNKS chunk ids and EDGE_DOCS documents; bare
    co-occurrence below ``min_bare`` is dropped.  pair_rows: (a, b, chunk_id, doc_id, relacion)."""
    lab = pair_rows.groupBy("a", "b", "relacion").agg(F.count("*").alias("c"))
    best = lab.groupBy("a", "b").agg(F.min_by("relacion", F.struct(-F.col("c"), "relacion")).alias("relacion"))
    peso = pair_rows.select("a", "b", "chunk_id").distinct().groupBy("a", "b").agg(F.count("chunk_id").alias("peso"))

    def firsts(column: str, n: int, name: str) -> DataFrame:
        """The n smallest values of each edge: ranked before they are collected, so a hot edge is never one list."""
        w = W.partitionBy("a", "b").orderBy(column)
        x = pair_rows.select("a", "b", column).where(F.col(column).isNotNull()).distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)
        return x.groupBy("a", "b").agg(F.array_sort(F.collect_list(column)).alias(name))

    per = peso.join(firsts("chunk_id", EDGE_CHUNKS, "chunks"), ["a", "b"]).join(firsts("doc_id", EDGE_DOCS, "docs"), ["a", "b"], "left").withColumn("docs", F.coalesce("docs", F.array().cast(ArrayType(pair_rows.schema["doc_id"].dataType))))
    out = per.join(best, ["a", "b"])
    return out.where((F.col("relacion") != "coocurre_con") | (F.col("peso") >= min_bare))


def link(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(query_id, entity): names that stand as whole words in a query, longest
    first, none inside a longer one that stands there.  Names meet queries on
    their first word, so it is an equi-join."""
    q = queries.select("query_id", T.norm_entity(F.coalesce("query", F.lit(""))).alias("q"))
    words = q.select("query_id", F.concat(F.lit(" "), "q", F.lit(" ")).alias("q"), F.explode(F.array_distinct(F.split("q", " "))).alias("head"))
    n = names.select("entity", F.split("entity", " ")[0].alias("head")).where("entity <> ''")
    hit = words.join(n, "head").where(F.contains("q", F.concat(F.lit(" "), "entity", F.lit(" ")))).select("query_id", "entity").distinct()
    longer = hit.select("query_id", F.col("entity").alias("long"))
    inside = hit.join(longer, "query_id").where((F.length("long") > F.length("entity")) & F.contains("long", F.col("entity"))).select("query_id", "entity")
    return hit.join(inside, ["query_id", "entity"], "left_anti")


#: Rows of (seed, entity) and of (query, seed) that are sent to every task; beyond, they are joined.
SENT_ROWS = 2_000_000


def seed_pairs(node_chunks: DataFrame, seeds: DataFrame) -> DataFrame:
    """(a, b, peso), a < b: the pairs of entities of a chunk of which one is a seed at least, with the number of their chunks.
    node_chunks(entity, chunk_id), distinct; seeds(entity)."""
    s = materialise(seeds.select("entity").distinct(), "seeds")
    flagged = node_chunks.select("entity", "chunk_id").join(s.withColumn("seed", F.lit(True)), "entity", "left")
    x = flagged.where("seed").select("chunk_id", F.col("entity").alias("x"))
    y = flagged.select("chunk_id", F.col("entity").alias("y"), "seed")
    both = x.join(y, "chunk_id").where("x < y or (x > y and seed is null)")  # a pair of two seeds once
    return both.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("peso"))


def _given(numbers: np.ndarray, starts: np.ndarray, seed: np.ndarray, part: np.ndarray):
    """What each seed gives to each chunk, for rows (chunk_id, es): the seeds of entity numbers[i] are those from starts[i] to starts[i + 1]."""

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        es = batch.column(1)
        c, e = np.repeat(np.arange(len(es)), np.diff(es.offsets.to_numpy())), np.searchsorted(numbers, es.flatten().to_numpy(zero_copy_only=False))
        n = starts[e + 1] - starts[e]
        at = np.repeat(starts[e] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return seed[at].astype(np.int64), np.repeat(c, n), part[at]

    return run


def graph_search(seeds: DataFrame, node_chunks: DataFrame, edge_rows: DataFrame, k: int = 1000, neighbour: float = 0.4) -> DataFrame:
    """(query_id, chunk_id, score, rank): 1 for each chunk of a linked entity,
    ``neighbour`` x min(peso, 10) / 10 for each chunk of a neighbour, from every
    seed.  seeds(query_id, entity), node_chunks(entity, chunk_id), distinct;
    edge_rows(a, b, peso), of which those of seeds are enough."""
    seeds = materialise(seeds.select("query_id", "entity"), "linked")
    both = edge_rows.select(F.col("a").alias("entity"), F.col("b").alias("other"), "peso").unionByName(edge_rows.select(F.col("b").alias("entity"), F.col("a").alias("other"), "peso"))
    itself = seeds.select("entity").distinct()
    near = both.join(itself, "entity", "left_semi").select("entity", "other", (neighbour * F.least("peso", F.lit(10)) / 10.0).alias("part"))
    given = materialise(itself.select("entity", F.col("entity").alias("other"), F.lit(1.0).alias("part")).unionByName(near), "given")
    if max(given.count(), seeds.count()) <= SENT_ROWS:
        return _sent_search(seeds, node_chunks, given, k)
    total = seeds.join(given, "entity").join(node_chunks.withColumnRenamed("entity", "other"), "other").groupBy("query_id", "chunk_id").agg(F.round(F.sum("part"), DECIMALS).alias("score"))
    return top_k(total, k)


def _sent_search(seeds: DataFrame, node_chunks: DataFrame, given: DataFrame, k: int) -> DataFrame:
    """The search with seeds and their neighbours, SENT_ROWS at most, as numbers sent to every task."""
    spark = seeds.sparkSession
    entities = materialise(given.select("other").distinct().withColumn("e", F.monotonically_increasing_id()), "numbers")
    names = materialise(given.select("entity").distinct().withColumn("s", F.monotonically_increasing_id()), "seeds")
    g = given.join(entities, "other").join(names, "entity").select("s", "e", "part").toArrow()
    numbers, o = np.unique(g["e"].to_numpy(), return_inverse=True)
    own, s = np.unique(g["s"].to_numpy(), return_inverse=True)
    order = np.argsort(o, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(o, minlength=len(numbers)))]).astype(np.int64)
    q = seeds.join(names, "entity").select("query_id", "s").toArrow()
    ids = q["query_id"].unique()
    groups = sums.Groups(pc.index_in(q["query_id"], ids).to_numpy().astype(np.int64), np.searchsorted(own, q["s"].to_numpy()))
    stored = materialise(node_chunks.join(entities.withColumnRenamed("other", "entity"), "entity").groupBy(F.col("chunk_id").cast("bigint").alias("chunk_id")).agg(F.collect_list("e").alias("es")), "entities")
    got = sums.top_sums(stored, _given(numbers, starts, s[order].astype(np.int32), g["part"].to_numpy()[order]), len(own), groups, k, stored.count())
    back = spark.createDataFrame(list(enumerate(ids.to_pylist())), StructType([StructField("q", IntegerType()), StructField("query_id", seeds.schema["query_id"].dataType)]))
    return top_k(got.join(F.broadcast(back), "q").select("query_id", "chunk_id", F.round("score", DECIMALS).alias("score")), k)


def link_coverage(queries: DataFrame, linked: DataFrame, node_chunks: DataFrame) -> DataFrame:
    """One row: queries, queries with a linked entity, distinct chunks reached."""
    reach = linked.join(node_chunks, "entity").agg(F.count_distinct("chunk_id").alias("chunks"))
    done = linked.agg(F.count_distinct("query_id").alias("linked"))
    return queries.agg(F.count_distinct("query_id").alias("queries")).crossJoin(done).crossJoin(reach)
