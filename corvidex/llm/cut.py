"""Problem 10: texts cut off by a field limit or in transfer.

Method: a vocabulary of the whole corpus is built and used as a trie (every
proper prefix of every word, met by the suspects' last tokens in a join, so
the trie is never held in one place).  Suspects are texts that close with no
whole sentence.  Three kinds of evidence are weighed for each of them:

- trie: the last token is a proper prefix of words and next to never a word by
  itself (its own uses are fewer than KNOWN of the uses of what it begins);
- length: the texts of its source stop at exactly this length, in characters or
  bytes, far more often than at the lengths around it;
- closing: the last token closes a sentence in fewer than CLOSES of its uses
  (CLOSES_BARE where no mark stands after it), so the sentence goes on.

A suspect is cut if one of them speaks for it.  A closing line of its own (list
item, reference, signature) has no sentence to go on: there only the trie, or
the length together with the closing rate, counts.  The lack of a full stop is
no evidence by itself.

Defined cases: null, empty and blank texts are no case; a text that ends in a
broken character is cut; repeated rows count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise, small, table

#: A word that closes a sentence in fewer than this share of its uses does not close one:
#: where dots stand after it, and where no mark stands at all.
CLOSES, CLOSES_BARE = 0.03, 0.09
#: A source's limit: suspects of exactly one length exceed what the lengths around it
#: (so many to each side) let expect by so many times its root, and by so many.
AROUND, SIGMAS, EXCESS = 50, 6, 3
#: Words of a closing line of its own at most.
OWN_LINE_WORDS = 8

_WORD = re.compile(r"[^\W_]+")
_WHOLE = re.compile(r"[.!?。！？][\"'»”’)\]]*$")
_DOTS = re.compile(r"(?:…|\.\.+|\[…\]|\[\.\.\.\])[\"'»”’)\]]*$")
_TAIL = re.compile(r"[.…\s\"'»”’)\]\[]+$")
_GAP_END = re.compile(r"[\"'»”’)\]]*(?:[.!?…]|\n\s*\n)")
_SPLITS = ("-\n", "\u2010\n", "\u00ad\n", "\u00ac\n")  # a word goes on in the next line
#: A token is a word if its own uses, last tokens left out, are at least this share of the uses of the words it begins.
KNOWN = 0.02
_PAIRS = re.compile(r"([^\W_]+)([^\w]*)")
_ITEM = re.compile(r"^\s*(?:[-•*–—]\s|\(?\d{1,2}[.)]\s|[^\s:][^:\n]{0,30}:\s)|\d+\s*/\s*\d+\s*$")

SCHEMA = "kind string, k1 string, doc_id bigint, source string, n bigint, m bigint, dots boolean, own boolean, head string, token string, prev string, chars int, octets int, broken boolean"
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def ending(text: str) -> dict | None:
    """What the end of a text shows; None if it closes with a whole sentence or is blank."""
    t = text.rstrip()
    lines = t.split("\n")
    while len(lines) > 1 and not any(c.isalpha() for c in lines[-1]) and "�" not in lines[-1]:
        lines.pop()  # page numbers and blank lines after the end
    t = "\n".join(lines).rstrip()
    if not t:
        return None
    dots = _DOTS.search(t) is not None
    if not dots and _WHOLE.search(t):
        return None
    last = lines[-1].strip()
    core = _TAIL.sub("", t)
    words = _WORD.findall(core[-200:])
    n_last = len(_WORD.findall(last))
    first = _WORD.search(last)
    return {
        "dots": dots,
        "own": len(lines) > 1 and not dots and n_last <= OWN_LINE_WORDS and _ITEM.search(last) is not None,
        "head": first[0] if first and len(lines) > 1 and not dots and n_last <= OWN_LINE_WORDS and first[0][0].isupper() else None,
        "token": words[-1] if words and core.endswith(words[-1]) else None,
        "prev": words[-2].lower() if len(words) > 1 else "",
        "broken": "�" in t[-3:],
    }


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: the suspects, and partial counts of words,
    of capitalised words after a word, of line heads, and of texts by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        ends: Counter = Counter()
        caps: Counter = Counter()
        cap_ends: Counter = Counter()
        heads: Counter = Counter()
        for b in batches:
            rows: dict[str, list] = {k: [] for k in _NAMES}

            def put(**kw):
                for k in _NAMES:
                    rows[k].append(kw.get(k))

            for i, text, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if not text or not text.strip():
                    continue
                pairs = _PAIRS.findall(text)
                if pairs:
                    words.update([w for w, gap in pairs[:-1] if gap not in _SPLITS])
                    before = ""
                    for w, gap in pairs[:-1]:
                        closes = gap != " " and gap != "" and _GAP_END.match(gap) is not None
                        if closes:
                            ends[w] += 1
                        if w[0].isupper() and before:
                            caps[before] += 1
                            if closes:
                                cap_ends[before] += 1
                        before = "" if closes else w
                heads.update([m for m in _LINE_HEAD.findall(text)])
                e = ending(text)
                if e:
                    put(kind="doc", doc_id=i, source=source, chars=len(text), octets=len(text.encode()), n=1, m=0, **e)
            if len(words) > 300_000:
                yield _counts(words, ends, caps, cap_ends, heads)
            if rows["kind"]:
                yield pa.RecordBatch.from_pydict(rows, schema=_ARROW)
        yield _counts(words, ends, caps, cap_ends, heads)

    return docs.select("doc_id", "text", "source").mapInArrow(run, SCHEMA)


_LINE_HEAD = re.compile(r"(?m)^[ \t]*([^\W\d_]+)")
_ARROW = pa.schema([("kind", pa.string()), ("k1", pa.string()), ("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("m", pa.int64()), ("dots", pa.bool_()), ("own", pa.bool_()), ("head", pa.string()), ("token", pa.string()), ("prev", pa.string()), ("chars", pa.int32()), ("octets", pa.int32()), ("broken", pa.bool_())])


def _counts(words: Counter, ends: Counter, caps: Counter, cap_ends: Counter, heads: Counter) -> pa.RecordBatch:
    kind, key, n, m = [], [], [], []
    for name, total, part in (("word", words, ends), ("cap", caps, cap_ends), ("head", heads, {})):
        kind += [name] * len(total)
        key += list(total)
        n += list(total.values())
        m += [part.get(k, 0) for k in total]
    for c in (words, ends, caps, cap_ends, heads):
        c.clear()
    none = [None] * len(key)
    return pa.RecordBatch.from_pydict({**{f: none for f in _NAMES}, "kind": kind, "k1": key, "n": n, "m": m}, schema=_ARROW)


def limits(doc: DataFrame) -> DataFrame:
    """(source, unit, length): lengths at which a source's suspects stop again and again."""
    each = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("octets").alias("unit"), F.col("octets").alias("length")))).alias("x")
    n = doc.select("source", each).groupBy("source", "x.unit", "x.length").agg(F.count("*").alias("n"))
    w = W.partitionBy("source", "unit").orderBy("length").rangeBetween(-AROUND, AROUND)  # one row a length
    expected = (F.sum("n").over(w) - F.col("n")) / (2 * AROUND)
    return n.withColumn("expected", expected).where(F.col("n") >= F.col("expected") + SIGMAS * F.sqrt("expected") + EXCESS).select("source", "unit", "length")


def evidence(docs: DataFrame) -> DataFrame:
    """(doc_id, source, broken, dots, own, part, at_limit, goes_on) of every suspect among docs(doc_id, text, source)."""
    facts = materialise(scan(docs), "cut")
    doc = materialise(facts.where("kind = 'doc'").select("doc_id", "source", "dots", "own", "head", "token", "prev", "chars", "octets", "broken").distinct(), "suspects")
    count = lambda kind: facts.where(F.col("kind") == kind).groupBy("k1").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))

    # Closing lines of their own: heads that open a short unpunctuated last line in at least half of their lines.
    closers = doc.where("head is not null").groupBy("head").agg(F.countDistinct("doc_id").alias("last"))
    closers = closers.join(count("head"), F.col("head") == F.col("k1")).where("last >= 2 and last * 2 >= n").select("head", F.lit(True).alias("closer"))

    # The vocabulary, and its trie as the proper prefixes the suspects' tokens meet.
    words = materialise(count("word"), "words")
    tokens = materialise(doc.where("token is not null").select("token").distinct(), "tokens")
    starts = F.transform(F.expr("sequence(1, length(k1) - 1)"), lambda i: F.substring("k1", F.lit(1), i))
    prefixes = words.where("length(k1) > 1").select(F.explode(starts).alias("token"), "n")
    begins = prefixes.join(small(tokens), "token", "left_semi").groupBy("token").agg(F.sum("n").alias("begun"))
    seen = words.join(small(tokens), F.col("k1") == F.col("token"), "left_semi").select(F.col("k1").alias("token"), F.col("n").alias("w_n"), F.col("m").alias("w_m"))
    caps = count("cap").select(F.lower("k1").alias("prev"), "n", "m").groupBy("prev").agg(F.sum("n").alias("c_n"), F.sum("m").alias("c_m"))

    x = doc.join(seen, "token", "left").join(begins, "token", "left").join(closers, "head", "left").join(caps, "prev", "left")
    lim = materialise(limits(doc), "limits")
    for unit in ("chars", "octets"):
        at = lim.where(F.col("unit") == unit).select(F.col("source").alias("ls"), F.col("length").alias("lv"), F.lit(True).alias(f"at_{unit}"))
        x = x.join(at, F.col("source").eqNullSafe(F.col("ls")) & (F.col(unit) == F.col("lv")), "left").drop("ls", "lv")
    uses, begun = F.coalesce("w_n", F.lit(0)), F.coalesce("begun", F.lit(0))
    part = (begun > 0) & (uses < KNOWN * begun)
    # a name is judged by the names that follow the same word, as most names are rare themselves
    name = F.col("token").rlike(r"^\p{Lu}") & (F.coalesce("c_n", F.lit(0)) > 0)
    rate = F.when(name, F.col("c_m") / F.col("c_n")).when(uses > 0, F.col("w_m") / uses).otherwise(F.lit(0.0))
    either = F.coalesce("at_chars", F.lit(False)) | F.coalesce("at_octets", F.lit(False))
    return x.select("doc_id", "source", "broken", "dots", (F.col("own") | F.coalesce("closer", F.lit(False))).alias("own"), (F.col("token").isNotNull() & part).alias("part"), either.alias("at_limit"), (F.col("token").isNotNull() & (rate < F.when(F.col("dots"), CLOSES).otherwise(CLOSES_BARE))).alias("goes_on"))


def cut_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, source) of the texts of ``docs(doc_id, text, source)`` that were cut, one row each."""
    speaks = F.when(F.col("own"), F.col("part") | (F.col("at_limit") & F.col("goes_on"))).otherwise(F.col("part") | F.col("at_limit") | F.col("goes_on"))
    return evidence(docs).where(F.col("broken") | speaks).select("doc_id", "source").distinct()


def p10_found(spark: SparkSession, base: str) -> DataFrame:
    return cut_texts(table(spark, base, "documents")).select("doc_id").distinct()


def p10_rates(spark: SparkSession, base: str) -> DataFrame:
    """For each source: texts that are not blank, cut texts, and the share."""
    docs = table(spark, base, "documents")
    full = docs.where(r"text rlike '\\S'").groupBy("source").agg(F.countDistinct("doc_id").alias("n_texts"))
    n_cut = cut_texts(docs).groupBy("source").agg(F.countDistinct("doc_id").alias("n_cut"))
    out = full.join(n_cut.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select("source", "n_texts", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), F.round(F.coalesce("n_cut", F.lit(0)) / F.col("n_texts"), 6).alias("share"))
