"""Problem 4: one consistent form for text that looks the same.

Steps, each a no-op on ordinary text: format characters that have no glyph are
dropped; every space separator becomes a plain space; presentation forms
(full-width, ligatures) become their plain letters; the rest is composed (NFC);
then script-aware repair: per token the dominant script is found and letters
of another script that look like letters of the dominant one are substituted,
only in tokens that mix scripts (or whose every letter is a look-alike while
the text around is in the other script) and only if the result stands in the
vocabulary of the corpus.

Line breaks, letter case, words and punctuation are visible and are kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import big, chunk_texts, materialise, small, table

# Letters of other scripts drawn like a Latin letter (Cyrillic and Greek, as in the public Unicode confusables).
LATIN_OF = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "к": "k",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J", "З": "3",
    "ο": "o", "ν": "v", "α": "a", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "γ": "y", "χ": "x", "τ": "t", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}
LATIN_OF.pop("З")  # a digit, not a letter
CYRILLIC_OF = {v: k for k, v in reversed(LATIN_OF.items()) if "\u0400" <= k <= "\u052F"}
CYRILLIC_OF |= {g: CYRILLIC_OF[lat] for g, lat in LATIN_OF.items() if "\u0370" <= g <= "\u03FF" and lat in CYRILLIC_OF}

#: Text that holds none of these needs no work; the rest goes the long way.
_INVISIBLE = r"\u00AD\u034F\u061C\u115F\u1160\u17B4\u17B5\u180E\u200B-\u200F\u202A-\u202E\u2060-\u2064\u206A-\u206F\uFE00-\uFE0F\uFEFF"
_SPACES = r"\u00A0\u1680\u2000-\u200A\u202F\u205F\u3000\t"
_ODD = re.compile(rf"[{_INVISIBLE}{_SPACES}\u0300-\u036F\uFB00-\uFB06\uFF01-\uFF5E\u2010\u2011\u0370-\u03FF\u1F00-\u1FFF]")
_MIXED = re.compile(r"[A-Za-z\u00C0-\u024F][\u0370-\u052F]|[\u0370-\u052F][A-Za-z\u00C0-\u024F]")
_GONE = re.compile(f"[{_INVISIBLE}]")
_SPACE = re.compile(f"[{_SPACES}]")
_FORMS = {0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl", 0xFB05: "st", 0xFB06: "st", 0x2010: "-", 0x2011: "-"} | {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_TOKEN = re.compile(r"[^\W\d_]+")
_CYR = re.compile(r"[\u0400-\u052F]")
_GREEK = re.compile(r"[\u0370-\u03FF]")
_FOREIGN = re.compile(r"[\u0370-\u052F]")
_LAT = re.compile(r"[A-Za-z\u00C0-\u024F]")


def plain(text: str) -> str:
    """Everything but the repair of look-alike letters."""
    if not _ODD.search(text):
        return text
    text = _SPACE.sub(" ", _GONE.sub("", text)).translate(_FORMS)
    return unicodedata.normalize("NFC", text)


def token_repairs(text: str) -> list[tuple[str, str]]:
    """(token, repaired token) for tokens that hold look-alike letters of a foreign script."""
    out: list[tuple[str, str]] = []
    if text.isascii() or not _FOREIGN.search(text):
        return out
    n_cyr = len(_CYR.findall(text))
    n_lat = len(_LAT.findall(text))
    mixed = _MIXED.search(text) is not None
    latin_text = n_lat >= n_cyr
    if not mixed and not latin_text and not _GREEK.search(text):
        # an all-look-alike Latin token in Cyrillic text
        cand = {t for t in _TOKEN.findall(text) if all(c in CYRILLIC_OF for c in t)}
        return [(t, "".join(CYRILLIC_OF[c] for c in t)) for t in cand]
    for t in set(_TOKEN.findall(text)):
        cyr = sum("\u0400" <= c <= "\u052F" for c in t)
        grk = sum("\u0370" <= c <= "\u03FF" for c in t)
        lat = len(t) - cyr - grk
        if max(cyr, grk, lat) == len(t) and (len(t) == lat) == latin_text and not grk:
            continue  # one script, that of the text
        if max(cyr, grk, lat) == len(t):
            to_latin = latin_text
            if not all(c in (LATIN_OF if to_latin else CYRILLIC_OF) for c in t):
                continue
        else:
            # the dominant script is the one the whole token can be written in; of two, the one with more letters
            can_latin = all(c in LATIN_OF for c in t if "\u0370" <= c <= "\u052F")
            can_cyrillic = all(c in CYRILLIC_OF for c in t if not "\u0400" <= c <= "\u052F")
            to_latin = can_latin if can_latin != can_cyrillic else lat > cyr or (lat == cyr and latin_text)
        m = LATIN_OF if to_latin else CYRILLIC_OF
        r = "".join(m.get(c, c) for c in t)
        if r != t:
            out.append((t, r))
    return out


def repair(text: str, known=None) -> str:
    """Substitute look-alikes token by token; ``known`` is the set of admitted results (None: all)."""
    todo = {t: r for t, r in token_repairs(text) if known is None or r in known}
    return _TOKEN.sub(lambda m: todo.get(m[0], m[0]), text) if todo else text


def canonical(text: str | None, known=None) -> str | None:
    """The consistent form of one text; null stays null, empty stays empty."""
    return text if not text else repair(plain(text), known)


def first_pass(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base, cand): rows of ``df`` whose plain form differs or that hold
    repairable tokens; ``cand`` are the repaired tokens to look up."""
    schema = "id bigint, raw string, base string, cand array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, raws, bases, cands = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t:
                    continue
                p = plain(t)
                c = [] if p.isascii() else sorted({r for _, r in token_repairs(p)})
                if c or p != t:
                    ids.append(i), raws.append(t), bases.append(p), cands.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raws, pa.string()), pa.array(bases, pa.string()), pa.array(cands, pa.list_(pa.string()))], names=["id", "raw", "base", "cand"])

    return df.select(F.col(id_col).cast("bigint"), F.col(text_col)).where(F.col(text_col).isNotNull()).mapInArrow(run, schema)


def vocabulary_of(df: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """The words of ``wanted(word)`` that stand in the corpus.  The corpus's
    tokens meet the wanted list before any shuffle, so only hits move."""
    words = df.select(F.explode(F.split(F.col(text_col), r"[^\p{L}]+")).alias("word"))
    return words.join(small(wanted), "word", "left_semi").distinct()


def repaired(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, raw, canon): rows whose consistent form differs from what is stored.

    Null and empty texts have no such row.  Candidate words are looked up in
    the vocabulary of all of ``df``; rows wait in a written table meanwhile.
    """
    odd = materialise(first_pass(df, id_col, text_col), "odd")
    cands = materialise(odd.select(F.explode("cand").alias("word")).distinct(), "cands")
    known = materialise(vocabulary_of(df, text_col, cands), "known")
    per_row = odd.where(F.size("cand") > 0).select("id", "raw", F.explode("cand").alias("word")).join(small(known), "word").groupBy("id", "raw").agg(F.collect_set("word").alias("known"))
    joined = odd.join(per_row.select(F.col("id").alias("kid"), F.col("raw").alias("kraw"), "known"), (F.col("id") == F.col("kid")) & (F.col("raw") == F.col("kraw")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column(3).to_pylist()
            canon = [repair(t, set(k)) if k else t for t, k in zip(b.column(2).to_pylist(), known)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(canon, pa.string())], names=["id", "raw", "canon"])

    out = joined.select("id", "raw", "base", "known").mapInArrow(run, "id bigint, raw string, canon string")
    return out.where("raw <> canon")


def same_looking(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b: rows that look the same and differ in characters.

    Of two such rows at least one is not in the consistent form, so unchanged
    rows enter only if their text is the form of a changed row (a semi-join on
    128-bit digests); whole texts are not shuffled.  Pairs are needed between
    different stored forms only; equal copies make none among themselves.
    """
    digest = lambda c: F.struct(F.xxhash64(c).alias("h1"), F.xxhash64(F.lit("x"), c).alias("h2"))
    fixed = materialise(repaired(df, id_col, text_col).select("id", digest(F.col("raw")).alias("raw"), digest(F.col("canon")).alias("key")).distinct(), "fixed")
    keys = materialise(fixed.select("key").distinct(), "keys")
    rest = df.select(F.col(id_col).cast("bigint").alias("id"), digest(F.col(text_col)).alias("raw")).where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).withColumn("key", F.col("raw"))
    rest = rest.join(small(keys), "key", "left_semi").distinct().select("id", "raw", "key")
    known_ids = fixed.select("id", "raw")
    members = fixed.unionByName(rest.join(known_ids, ["id", "raw"], "left_anti"))
    a, b = members.select(F.col("id").alias("id_a"), F.col("raw").alias("raw_a"), "key"), members.select(F.col("id").alias("id_b"), F.col("raw").alias("raw_b"), "key")
    return a.join(b, "key").where("id_a < id_b and raw_a <> raw_b").select("id_a", "id_b").distinct()


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    texts = chunk_texts(spark, base)
    pairs = same_looking(texts, "chunk_id", "texto").withColumn("field", F.lit("texto"))
    names = table(spark, base, "chunks").select(big("chunk_id").alias("chunk_id"), "nombre_archivo").where("chunk_id is not null and nombre_archivo is not null")
    names = materialise(names.groupBy("nombre_archivo").agg(F.min("chunk_id").alias("chunk_id")), "names")
    pairs = pairs.unionByName(same_looking(names, "chunk_id", "nombre_archivo").withColumn("field", F.lit("nombre_archivo")))
    return pairs.select("field", F.col("id_a").alias("chunk_id_a"), F.col("id_b").alias("chunk_id_b")).distinct()


def p4_canonical(spark: SparkSession, base: str) -> DataFrame:
    """Every distinct chunk with its consistent text and file name (null where null)."""
    df = table(spark, base, "chunks").select(big("chunk_id").alias("chunk_id"), "texto", "nombre_archivo").where("chunk_id is not null").distinct()
    for col in ("texto", "nombre_archivo"):
        fix = repaired(df, "chunk_id", col).select(F.col("id").alias("chunk_id"), F.col("raw").alias(col), F.col("canon").alias(f"{col}_fix"))
        df = df.join(fix, ["chunk_id", col], "left").withColumn(f"{col}_canon", F.coalesce(f"{col}_fix", col)).drop(f"{col}_fix")
    return df.select("chunk_id", "texto_canon", "nombre_archivo_canon")
