"""Problem 7: lines repeated across the documents of one source.

Method: every line becomes an identifier (its letters only, so figures, case,
spacing, punctuation and symbols do not count).  Lines with fewer places than
any block needs break a text into runs; the suffixes of these runs, each whole,
form a suffix array for each source.  The common prefixes of neighbours in it
are the repeated multi-line blocks; a block's distinct chunks are counted, and
the lines of the blocks that stand in enough of them are the result.

The array is sorted by Spark within (source, first line): suffixes with other
first lines have no common prefix, so a source with a third of all rows is many
tasks.  Equal suffixes are sorted once.  A line that stands in enough chunks is
in such a block wherever it stands: either the places of the line branch or end
after it, and it is a common prefix itself, or all go on alike and the longer
block has as many chunks.

Defined cases: null and empty texts hold no line; lines without letters never
count and part runs; repeated rows of a chunk count once; a null source is a
source of its own.  Where two stored rows of one chunk_id differ in text, each
is looked at and the chunk counts once.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import chunk_texts, materialise, once, small
from .lookalike import LATIN_OF

MIN_DOCS = 8
MIN_SHARE = 0.10

def _skeleton() -> tuple[str, str]:
    """Folding to what a letter looks like without accents: full-width forms,
    accented letters, and look-alikes of other scripts (problem 4)."""
    fold = {chr(c): chr(c - 0xFEE0) for c in [*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]}
    for c in [*range(0xC0, 0x250), *range(0x400, 0x460), *range(0x1E00, 0x1F00)]:
        d = unicodedata.normalize("NFD", chr(c))
        if len(d) > 1 and not unicodedata.combining(d[0]):
            fold[chr(c)] = d[0]
    fold |= LATIN_OF
    fold = {k.lower(): v.lower() for k, v in fold.items() if len(k.lower()) == 1}
    return "".join(fold), "".join(fold.values())


_FROM, _TO = _skeleton()


def line_ids(text: Column) -> Column:
    """array<bigint>: identifier of each line, null for lines without letters."""
    letters = lambda x: F.regexp_replace(x, r"[^\p{L}]+", "")
    return F.transform(F.split(F.translate(F.lower(text), _FROM, _TO), "\n"), lambda x: F.when(letters(x) != "", F.xxhash64(letters(x))))


def lines(texts: DataFrame) -> DataFrame:
    """(source, chunk_id, version, line_no, line): lines with letters; ``version``
    tells different texts of one chunk_id apart."""
    ids = line_ids(F.col("text"))
    each = texts.where("text is not null").select("source", "chunk_id", F.xxhash64("text").alias("version"), F.posexplode(ids).alias("pos", "line")).where("line is not null")
    return each.select("source", "chunk_id", "version", (F.col("pos") + 1).alias("line_no"), "line")


def same_source(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


class Blocks:
    """Repeated blocks of texts(source, chunk_id, text), from the suffix arrays of their sources."""

    def __init__(self, texts: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE):
        every = materialise(lines(texts), "lines")
        self.limits = materialise(texts.select("source", "chunk_id").distinct().groupBy("source").agg(F.count("*").alias("n_docs")).withColumn("least", F.greatest(F.lit(min_docs), F.ceil(min_share * F.col("n_docs") - 1e-9))), "sources")
        # a block has no more places than any of its lines; at most lines-per-text / min_share lines a source pass
        lim = small(self.limits.select(F.col("source").alias("s"), "least"))
        places = every.groupBy("source", "line").agg(F.count("*").alias("places")).join(lim, same_source("source", "s")).where("places >= least")
        often = small(materialise(places.select(F.col("source").alias("s"), F.col("line").alias("l")), "often"))
        cand = every.join(often, same_source("source", "s") & (F.col("line") == F.col("l")), "left_semi").distinct()
        self.suffixes = materialise(suffixes(cand), "suffixes")
        self.blocks = materialise(self._qualifying(), "blocks")

    def _qualifying(self) -> DataFrame:
        """(source, first, len, block, hash, docs) of the blocks that stand in enough distinct chunks."""
        cut = materialise(common_prefixes(self.suffixes), "prefixes")
        met = self._met(cut).select("source", "first", "len", "hash", "chunk_id").distinct()
        docs = met.groupBy("source", "first", "len", "hash").agg(F.count("*").alias("docs"))
        lim = small(self.limits.select(F.col("source").alias("s"), "least", "n_docs"))
        ok = docs.join(lim, same_source("source", "s")).where("docs >= least").select("source", "first", "len", "hash", "docs", "n_docs")
        c = cut.select(F.col("source").alias("s"), F.col("hash").alias("h"), "block")
        return ok.join(c, same_source("source", "s") & (F.col("hash") == F.col("h"))).drop("s", "h")

    def _met(self, blocks: DataFrame) -> DataFrame:
        """Suffixes with each block they begin with: a suffix tries the lengths that blocks with its first line have."""
        lens = blocks.select("source", "first", "len").distinct().groupBy(F.col("source").alias("s"), F.col("first").alias("f")).agg(F.collect_list("len").alias("lens"))
        b = blocks.select(F.col("source").alias("s2"), F.col("hash").alias("h2"))
        x = self.suffixes.join(lens, same_source("source", "s") & (F.col("first") == F.col("f"))).select("source", "first", "chunk_id", "version", "line_no", "suffix", F.explode("lens").alias("len")).where("len <= size(suffix)")
        x = x.withColumn("hash", F.xxhash64(F.slice("suffix", F.lit(1), F.col("len"))))
        return x.join(b, same_source("source", "s2") & (F.col("hash") == F.col("h2")), "left_semi")

    def lines(self) -> DataFrame:
        """(source, chunk_id, line_no): every line of every place of a qualifying block."""
        at = self._met(self.blocks).groupBy("source", "chunk_id", "version", "line_no").agg(F.max("len").alias("len"))
        return at.select("source", "chunk_id", F.explode(F.sequence(F.col("line_no"), F.col("line_no") + F.col("len") - 1)).alias("line_no")).distinct()


def suffixes(cand: DataFrame) -> DataFrame:
    """(source, first, suffix, chunk_id, version, line_no): the suffixes of all runs of
    neighbouring candidate lines (gaps and islands within one text)."""
    text = ["source", "chunk_id", "version"]
    w = W.partitionBy(*text).orderBy("line_no")
    runs = cand.withColumn("run", F.col("line_no") - F.row_number().over(w)).groupBy(*text, "run").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    each = runs.select(*text, F.col("x")[0]["line_no"].alias("start"), F.transform("x", lambda z: z["line"]).alias("ids")).select(*text, "start", "ids", F.posexplode("ids").alias("k", "first"))
    return each.select("source", "first", F.expr("slice(ids, k + 1, size(ids) - k)").alias("suffix"), "chunk_id", "version", (F.col("start") + F.col("k")).alias("line_no"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix of two id arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first_no = F.array_position(same, False)
    return F.when(b.isNull(), 0).when(first_no == 0, F.size(same)).otherwise(first_no - 1).cast("int")


def common_prefixes(suffixes: DataFrame) -> DataFrame:
    """(source, first, len, block, hash): common prefixes of neighbours in the suffix
    array, and suffixes that stand again as they are."""
    sa = suffixes.groupBy("source", "first", "suffix").agg(F.count("*").alias("places"))
    w = W.partitionBy("source", "first").orderBy("suffix")
    lcp = sa.withColumn("lcp", common_prefix(F.col("suffix"), F.lag("suffix").over(w)))
    cut = lcp.where("lcp > 0").select("source", "first", F.slice("suffix", F.lit(1), F.col("lcp")).alias("block")).unionByName(sa.where("places > 1").select("source", "first", F.col("suffix").alias("block"))).distinct()
    return cut.select("source", "first", F.size("block").alias("len"), "block", F.xxhash64("block").alias("hash"))


def _texts(spark: SparkSession, base: str) -> DataFrame:
    return chunk_texts(spark, base, "fuente").select(F.col("fuente").alias("source"), "chunk_id", F.col("texto").alias("text"))


def p7_found(spark: SparkSession, base: str) -> DataFrame:
    """Lines of the blocks that stand in enough chunks; a single line is a block of length one."""
    return Blocks(_texts(spark, base)).lines().select("chunk_id", "line_no").distinct()


def p7_blocks(spark: SparkSession, base: str) -> DataFrame:
    """Blocks that stand in enough chunks, with their lines, distinct chunks and share of the source."""
    b = Blocks(_texts(spark, base)).blocks
    return b.select("source", F.col("len").alias("n_lines"), F.hex("hash").alias("block_id"), "docs", F.round(F.col("docs") / F.col("n_docs"), 6).alias("share"))


def p7_cleaned(spark: SparkSession, base: str) -> DataFrame:
    """(chunk_id, texto): every distinct chunk without its source's repeated blocks.
    Wherever a line of such a block stands in the source a block stands (see the
    module), so the text is rebuilt in the scan and only the lines of blocks are joined."""
    t = _texts(spark, base)
    bad = Blocks(t).blocks.select("source", F.explode("block").alias("line")).groupBy("source").agg(F.collect_set("line").alias("bad"))
    per = small(materialise(bad.select(F.col("source").alias("s"), "bad"), "bad"))
    x = once(t, "chunk_id").join(per, same_source("source", "s"), "left")
    raw = F.split("text", "\n")
    keep = F.filter(F.arrays_zip(raw.alias("t"), line_ids(F.col("text")).alias("i")), lambda z: ~F.coalesce(F.array_contains(F.coalesce("bad", F.array().cast("array<bigint>")), z["i"]), F.lit(False)))
    return x.select("chunk_id", F.when(F.col("text").isNotNull(), F.array_join(F.transform(keep, lambda z: z["t"]), "\n")).alias("texto"))
