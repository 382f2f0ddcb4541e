"""Planning a corpus build: exclusions, translations, routing, shards, triage, inventory."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..session import materialise

# Language suffixes of file names and their order of preference.
LANGUAGE_RANK = {
    "spa": 0, "esp": 1, "espanol": 1,
    "eng": 2, "ing": 3, "english": 2, "ingles": 3,
    "por": 4, "portugues": 4, "fra": 5, "chi": 9, "rus": 9,
}
# Recognition language where no folder decides, and code maps.
DEFAULT_LANGUAGE = "eng+spa"
TWO_LETTER = {"spa": "es", "eng": "en", "por": "pt", "fra": "fr", "deu": "de", "ita": "it"}
DATA_IMAGE = ("table", "chart", "stoplight", "by-country", "figure", "fig-", "graph", "matrix", "timeline")
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "gif", "webp", "tif", "tiff", "bmp", "avif")
SHARD_FROM, SHARD_PAGES = 120, 60
PREFERRED_BELOW = 5


def glob_regex(pattern: str) -> str:
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern.lower()) + "$"


def excluded_by(path: Column, patterns: tuple[str, ...] = ()) -> Column:
    """First pattern that matches the file's name in any letter case, empty if none."""
    name = F.lower(T.file_name(path))
    out = F.lit("")
    for p in reversed(patterns):
        out = F.when(name.rlike(glob_regex(p)), F.lit(p)).otherwise(out)
    return out


def carries_data(name: Column) -> Column:
    return F.lower(name).rlike("|".join(DATA_IMAGE))


def redundant_translations(files: DataFrame, keep_below: int = PREFERRED_BELOW) -> DataFrame:
    """Paths of PDFs in a language of rank ``keep_below`` or more that have a sibling in a preferred one."""
    pattern = r"(?i)[-_]?(" + "|".join(sorted(LANGUAGE_RANK, key=len, reverse=True)) + ")$"
    s = T.stem(F.col("path"))
    x = files.where(T.suffix(F.col("path")) == "pdf").select("path", F.lower(F.regexp_extract(s, pattern, 1)).alias("language"), F.regexp_replace(F.lower(F.regexp_replace(s, pattern, "")), "[-_]+$", "").alias("base"))
    x = x.where((F.col("language") != "") & (F.length("base") >= 8))
    ranks = F.create_map(*[F.lit(v) for kv in LANGUAGE_RANK.items() for v in kv])
    x = x.withColumn("rank", F.coalesce(F.element_at(ranks, F.col("language")), F.lit(6)))
    good = x.groupBy("base").agg(F.count_distinct("language").alias("languages"), F.min("rank").alias("best")).where((F.col("languages") > 1) & (F.col("best") < keep_below))
    return x.where(F.col("rank") >= keep_below).join(good, "base", "left_semi").select("path")


def language_for(path: Column, folders: tuple[tuple[str, str], ...] = ()) -> Column:
    """Recognition language of a path: that of the first (part of a path, language) that matches."""
    out = F.lit(DEFAULT_LANGUAGE)
    for key, lang in reversed(folders):
        out = F.when(F.contains(path, F.lit(key)), F.lit(lang)).otherwise(out)
    return out


def two_letter_codes(codes: Column) -> Column:
    """array: 2-letter codes of 'spa+eng', unknown ones left out, Spanish if none remains."""
    m = F.create_map(*[F.lit(v) for kv in TWO_LETTER.items() for v in kv])
    got = F.filter(F.transform(F.split(codes, r"\+"), lambda c: F.element_at(m, F.trim(c))), lambda c: c.isNotNull())
    return F.when(F.size(got) > 0, got).otherwise(F.array(F.lit("es")))


def is_design_heavy() -> Column:
    share = F.col("multicolumn_pages") / F.greatest("sampled_pages", F.lit(1))
    return (F.col("chars_per_page") < 2200) & (F.col("images_per_page") >= 1.0) & (share >= 0.4)


def is_complex_layout() -> Column:
    return F.coalesce("two_up", F.lit(False)) | (F.col("multicolumn_pages") / F.greatest("sampled_pages", F.lit(1)) >= 0.3)


def triage_class() -> Column:
    c = F.col("chars_per_page")
    return F.when(c < 100, F.when(F.col("images_per_page") >= 0.5, "scanned").otherwise("empty")).when(c < 400, "sparse").otherwise("digital")


def sampled_pages(pages: DataFrame, n: int = 12) -> DataFrame:
    """Even sample of at most n pages a file (the sampling is the feature)."""
    w = W.partitionBy("path").orderBy("page")
    x = pages.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(W.partitionBy("path")))
    step = F.greatest(F.floor(F.col("_n") / n), F.lit(1))
    return x.where((F.col("_i") % step == 0) & (F.col("_i") / step < n)).drop("_i", "_n")


def folder_report(profiles: DataFrame) -> DataFrame:
    """Counts by class, pages to recognise, multi-column and two-up files of each folder, with a total row (folder null)."""
    return profiles.rollup("folder").agg(
        *[F.count_if(F.col("klass") == k).alias(k) for k in ("digital", "sparse", "scanned", "empty")],
        F.sum(F.when(F.col("klass").isin("scanned", "empty"), F.col("pages")).otherwise(0)).alias("ocr_pages"),
        F.count_if(F.col("multicolumn_pages") > 0).alias("multicolumn"),
        F.count_if(F.coalesce("two_up", F.lit(False))).alias("two_up"),
    )


def plan(files: DataFrame, ocr: bool = True, layout_model: bool = True, excluded: tuple[str, ...] = ()) -> DataFrame:
    """files(path, format, pages, klass, profile columns, routed) -> one row a task:
    (path, route, first_page, last_page, weight).  Each file takes exactly one
    route; long digital files are split into shards."""
    fmt = F.col("format")
    scanned = F.col("klass").isin("scanned", "empty")
    route = F.when(fmt == "img", F.when(carries_data(T.file_name(F.col("path"))) & F.lit(ocr), "ocr").otherwise("skip"))
    route = route.when((fmt == "pdf") & scanned, "ocr" if ocr else "skip").when((fmt == "pdf") & F.coalesce("routed", F.lit(False)) & F.lit(layout_model), "layout").when((fmt == "pdf") & (F.coalesce("pages", F.lit(0)) > SHARD_FROM), "shard").otherwise("file")
    x = files.where(excluded_by(F.col("path"), excluded) == "").withColumn("route", route).where("route <> 'skip'")
    first = F.when(F.col("route") == "shard", F.sequence(F.lit(0), F.col("pages") - 1, F.lit(SHARD_PAGES))).otherwise(F.array(F.lit(0)))
    x = x.select("path", "route", "pages", F.explode(first).alias("first_page"))
    last = F.when(F.col("route") == "shard", F.least(F.col("first_page") + SHARD_PAGES, "pages")).otherwise(F.coalesce("pages", F.lit(1)))
    return x.select("path", "route", "first_page", last.alias("last_page"), (last - F.col("first_page")).alias("weight"))


def inventory_lookup(inv: DataFrame) -> DataFrame:
    """(key, doc_id, phenomenon, observatory): one row a normalised path; repeats keep the smallest doc_id."""
    x = inv.where("path is not null").withColumn("key", path_key(F.col("path")))
    return x.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min_by("phenomenon", "doc_id").alias("phenomenon"), F.min_by("observatory", "doc_id").alias("observatory"))


def path_key(path: Column) -> Column:
    """Paths written in several forms as one: slashes, leading dots, letter case, separators."""
    p = F.regexp_replace(F.translate(path, "\\", "/"), "/+", "/")
    return F.regexp_replace(F.regexp_replace(F.lower(p), r"^(\./|/)+", ""), r"[_\s]+", "-")


def with_inventory(files: DataFrame, inv: DataFrame) -> DataFrame:
    """files(path, ...) with doc_id, phenomenon (first of 1 to 3 in the folder where
    the inventory has none) and observatory; doc_id is null for files without a row."""
    x = files.withColumn("key", path_key(F.col("path"))).join(inventory_lookup(inv), "key", "left")
    folder = F.regexp_extract(F.split("path", "/")[0], "[123]", 0).try_cast("int")
    return x.withColumn("phenomenon", F.coalesce("phenomenon", folder, F.lit(0))).drop("key")


def fallback_ids(files: DataFrame) -> DataFrame:
    """files(path, doc_id, ...) with DOC-00000 and so on, the file's place in order of
    path, where doc_id is null or empty.  Places come from a range sort and the
    partitions' counts, so no task sees all files."""
    stored = materialise(files.repartitionByRange("path").sortWithinPartitions("path").withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "places")
    counts = stored.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # one row a partition
    x = stored.join(F.broadcast(offsets.drop("_rows")), "_part")
    place = F.col("_at") - F.col("_first") + F.col("_offset")
    return x.withColumn("doc_id", F.coalesce(F.nullif("doc_id", F.lit("")), F.format_string("DOC-%05d", place))).drop("_part", "_at", "_first", "_offset")


def with_profiles(files: DataFrame, profiles: DataFrame) -> DataFrame:
    """files(path, ...) with the triage profile of each path; files that were not
    profiled have nulls in its columns."""
    return files.join(profiles.dropDuplicates(["path"]), "path", "left")


def routed_files(files: DataFrame, routing: DataFrame) -> DataFrame:
    """Files that the routing list(path) names, in any way of writing the path."""
    keys = routing.select(path_key(F.col("path")).alias("_key")).distinct()
    return files.withColumn("_key", path_key(F.col("path"))).join(keys, "_key", "left_semi").drop("_key")


def not_cached(files: DataFrame, manifest: DataFrame, version: str = "1") -> DataFrame:
    """Files whose content key is not in the manifest (incremental rebuild)."""
    key = F.sha1(F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string"), F.lit(version)))
    return files.withColumn("cache_key", key).join(manifest.select("cache_key"), "cache_key", "left_anti")


def extractor_choice(scores: DataFrame, margin: float = 1.0) -> DataFrame:
    """scores(folder, path, delta) -> (folder, wins, losses, mean_delta, choose): a
    folder changes extractor if it wins more often than it loses and on average."""
    x = scores.groupBy("folder").agg(F.count_if(F.col("delta") > margin).alias("wins"), F.count_if(F.col("delta") < -margin / 2).alias("losses"), F.round(F.avg("delta"), 6).alias("mean_delta"))
    return x.withColumn("choose", (F.col("wins") > F.col("losses")) & (F.col("mean_delta") > 0))


def round_robin(files: DataFrame, n: int) -> DataFrame:
    """The first n files taking one from each folder in turn (a sampling operator)."""
    w = W.partitionBy("folder").orderBy("path")
    x = files.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n)
    return x.withColumn("place", F.row_number().over(W.orderBy("turn", "folder"))).where(F.col("place") <= n).select("folder", "path", "place")
