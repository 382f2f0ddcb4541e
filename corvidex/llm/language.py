"""Problem 3: the language of each text and of each stretch in another language.

Method: multilingual mixture inference.  Letter trigrams and words give every
word a likelihood in each language.  For one text expectation-maximisation
estimates the proportions of its languages from the likelihoods of its clauses;
languages enter the text's set one by one as long as the likelihood gained
exceeds a penalty.  Within the set the best path over the clauses gives the
stretches; a stretch's confidence is the mean posterior of its clauses.

The likelihoods are fitted on a bounded sample of labelled rows: about
TRAIN_TEXTS texts of each language and table, chosen by a hash of their id; a
few wrong labels among them do not matter.  Everything else runs on all rows
and whole texts.

Defined cases: null and empty texts have no stretch; texts of fewer than
MIN_WORDS words are not reported; a missing or meaningless label names no
language; repeated rows count once; with no labelled row there is no language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunk_texts, table
from .lookalike import plain

LANGUAGES = ("es", "en", "pt", "fr", "ru")
MIN_WORDS = 20
TRAIN_TEXTS = 1500
#: Nats a language must gain to enter a text's set, and nats of a change of language between clauses.
PENALTY, CHANGE = 12.0, 6.0
#: Greatest disadvantage one word can bring to a language.
CLIP = 5.0
KNOWN_WORD = 3
#: Texts handled at once.
BLOCK = 2000

# Ways in which labels write the languages.
LABELS = {
    "es": "es spa esp spanish español espanol castellano castilian".split(),
    "en": "en eng ing english inglés ingles anglais".split(),
    "pt": "pt por portuguese português portugues portugais".split(),
    "fr": "fr fra fre french français francais francés frances".split(),
    "ru": "ru rus russian русский ruso russe".split(),
}
_OF_LABEL = {w: k for k, ws in LABELS.items() for w in ws}
_WORD = re.compile(r"[^\W_]+")
#: Words, and runs of what parts clauses.
_TOKEN = re.compile(r"[^\W_]+|[.!?…;:,()«»\"“”\[\]|\n—–]+")


def named(label: str | None) -> str | None:
    """The language a label names in any notation; None if it names none."""
    if not label:
        return None
    low = label.strip().lower()
    return _OF_LABEL.get(low) or _OF_LABEL.get(re.split(r"[^\w]|_", low)[0])


def trigrams(word: str) -> list[str]:
    w = f" {word} "
    return [w[i : i + 3] for i in range(len(w) - 2)]


# ---- fitting ----------------------------------------------------------------


def fit(rows: DataFrame) -> "Model":
    """Model from rows(id, text, label): counts of trigrams and words of a hash sample, added by Spark."""
    label = F.lower(F.trim("label"))
    known = F.create_map(*[F.lit(x) for kv in _OF_LABEL.items() for x in kv])
    lang = F.coalesce(F.element_at(known, label), F.element_at(known, F.regexp_extract(label, r"^(\p{L}+)", 1)))
    x = rows.select("id", "text", lang.alias("lang")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in x.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # five rows at most
    share = F.lit(0.0)
    for k, n in sizes.items():
        share = F.when(F.col("lang") == k, TRAIN_TEXTS / n).otherwise(share)
    sample = x.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = {k: Counter() for k in LANGUAGES}
        for b in batches:
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words[k].update(w for w in _WORD.findall(plain(t).lower()) if not w[0].isdigit())
        rows = []
        for k, c in words.items():
            grams: Counter = Counter()
            for w, n in c.items():
                for g in trigrams(w):
                    grams[g] += n
            rows += [(k, "g", g, n) for g, n in grams.items()] + [(k, "w", w, n) for w, n in c.items()]
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())], names=["lang", "kind", "key", "n"])

    counted = sample.mapInArrow(count, "lang string, kind string, key string, n bigint").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    return Model.from_counts(counted.where(f"kind = 'g' or n >= {KNOWN_WORD}").toPandas())  # bounded by the sample


class Model:
    """Log likelihood of words in each language."""

    def __init__(self, grams: dict[str, np.ndarray], words: dict[str, np.ndarray], floor: np.ndarray):
        self.grams, self.words, self.floor = grams, words, floor

    @staticmethod
    def from_counts(pdf) -> "Model":
        at = {k: i for i, k in enumerate(LANGUAGES)}
        tables: dict[str, dict[str, np.ndarray]] = {"g": {}, "w": {}}
        totals = {"g": np.zeros(len(LANGUAGES)), "w": np.zeros(len(LANGUAGES))}
        for lang, kind, key, n in zip(pdf["lang"], pdf["kind"], pdf["key"], pdf["n"]):
            v = tables[kind].setdefault(key, np.zeros(len(LANGUAGES)))
            v[at[lang]] += n
            totals[kind][at[lang]] += n
        size = max(len(tables["g"]), 1)
        floor = np.log(0.5 / (totals["g"] + 0.5 * size))
        grams = {k: np.log((v + 0.5) / (totals["g"] + 0.5 * size)) for k, v in tables["g"].items()}
        vocab = max(len(tables["w"]), 1)
        words = {k: np.log((v + 0.5) / (totals["w"] + 0.5 * vocab)) for k, v in tables["w"].items()}
        dead = totals["g"] == 0
        if dead.any():
            for t in (grams, words):
                for v in t.values():
                    v[dead] = -60.0
            floor = np.where(dead, -60.0, floor)
        return Model(grams, words, floor)

    def word(self, w: str) -> np.ndarray:
        """Disadvantage (0 or less) of each language for one lower-case word; digits say nothing."""
        if not any(c.isalpha() for c in w):
            return np.zeros(len(LANGUAGES), np.float32)
        v = self.words.get(w)
        if v is None:
            gs = trigrams(w)
            v = sum((self.grams.get(g, self.floor) for g in gs), np.zeros(len(LANGUAGES))) * min(1.0, 3.0 / len(gs))
        return np.maximum(v - v.max(), -CLIP).astype(np.float32)


class Scores(dict):
    """Memo token -> row of a growing score table; row 0 stands for what parts clauses."""

    def __init__(self, model: Model, most: int = 500_000):
        super().__init__()
        self.model, self.most = model, most
        self.table = np.zeros((1024, len(LANGUAGES)), np.float32)
        self.used = 1

    def __missing__(self, token: str) -> int:
        if not (token[0].isalnum()):
            self[token] = 0
            return 0
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        n = self[token] = self.used
        self.table[n] = self.model.word(token)
        self.used += 1
        return n

    def trim(self) -> None:
        """Forgets everything between batches once it is too large (speed only)."""
        if self.used > self.most:
            self.clear()
            self.used = 1


# ---- one text ----------------------------------------------------------------


def mixture(units: np.ndarray, steps: int = 8) -> tuple[list[int], np.ndarray]:
    """(language set, proportions) of a text's clauses (clauses x languages log
    likelihoods): languages enter while the likelihood gained exceeds PENALTY."""
    chosen = [int(units.sum(axis=0).argmax())]
    like = units[:, chosen[0]].sum()
    pi = np.ones(1)
    while len(chosen) < units.shape[1]:
        best = None
        for k in range(units.shape[1]):
            # a mixture gains no more than taking the better language clause by clause
            if k in chosen or np.maximum(units[:, k] - units[:, chosen].max(axis=1), 0).sum() < PENALTY:
                continue
            cols = units[:, [*chosen, k]]
            top = cols.max(axis=1, keepdims=True)
            e = np.exp(cols - top)
            p = np.full(len(chosen) + 1, 1.0 / (len(chosen) + 1))
            for _ in range(steps):
                r = e * p
                s = r.sum(axis=1, keepdims=True)
                p = (r / s).mean(axis=0)
            now = float(np.log((e * p).sum(axis=1)).sum() + top.sum())
            if best is None or now > best[0]:
                best = (now, k, p)
        if best is None or best[0] - like < PENALTY:
            break
        like, k, pi = best
        chosen.append(k)
    return chosen, pi


def path(units: np.ndarray, chosen: list[int], pi: np.ndarray) -> np.ndarray:
    """Best language of each clause, changes costing CHANGE."""
    x = units[:, chosen].astype(float) + np.log(np.maximum(pi, 1e-3)) * 0.1
    back = np.zeros(x.shape, int)
    score = x[0].copy()
    for t in range(1, len(x)):
        j = int(score.argmax())
        stay = score >= score[j] - CHANGE
        back[t] = np.where(stay, np.arange(len(chosen)), j)
        score = np.where(stay, score, score[j] - CHANGE) + x[t]
    out = np.zeros(len(x), int)
    out[-1] = int(score.argmax())
    for t in range(len(x) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return np.array(chosen)[out]


def segments_of(units: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(language, first word, words, confidence) of a text's stretches."""
    chosen, pi = mixture(units)
    lang = path(units, chosen, pi) if len(chosen) > 1 else np.full(len(units), chosen[0])
    e = np.exp(np.clip(units - units.max(axis=1, keepdims=True), -50, 0))
    post = e / e.sum(axis=1, keepdims=True)
    starts = np.r_[0, np.flatnonzero(np.diff(lang)) + 1]
    first = np.r_[0, np.cumsum(sizes)]
    out = []
    for a, b in zip(starts, np.r_[starts[1:], len(lang)]):
        n = int(sizes[a:b].sum())
        out.append((int(lang[a]), int(first[a]), n, float((post[a:b, lang[a]] * sizes[a:b]).sum() / max(n, 1))))
    return out


def analyse(tokens: list[list[str]], memo: Scores) -> tuple[np.ndarray, ...]:
    """Stretches of many texts as columns: text, words of the text, language,
    first word, words, confidence.  Clause likelihoods of all texts are summed at
    once; a text whose clauses cannot gain PENALTY from any second language has
    one stretch, and only the others are worked through one by one."""
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ids = np.fromiter(map(memo.__getitem__, chain.from_iterable(tokens)), np.int64, int(n.sum()))
    who = np.repeat(np.arange(len(tokens)), n)
    word = ids > 0
    if not word.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none.astype(float)
    clause = np.cumsum(np.r_[True, ~word[:-1] | (who[1:] != who[:-1])])[word]
    w, who = ids[word], who[word]
    first = np.flatnonzero(np.r_[True, clause[1:] != clause[:-1]])
    units = np.add.reduceat(memo.table[w], first, axis=0)
    sizes = np.diff(first, append=len(w))
    owner = who[first]
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    stop = np.r_[start[1:], len(owner)]
    total = np.add.reduceat(sizes, start)
    main = np.add.reduceat(units, start, axis=0).argmax(axis=1)
    lead = np.repeat(main, stop - start)
    gain = np.add.reduceat(np.maximum(units - np.take_along_axis(units, lead[:, None], 1), 0), start, axis=0).max(axis=1)
    e = np.exp(units - units.max(axis=1, keepdims=True))
    post = np.take_along_axis(e, lead[:, None], 1)[:, 0] / e.sum(axis=1)
    sure = np.add.reduceat(post * sizes, start) / total
    one = gain < PENALTY
    out = [[owner[start][one]], [total[one]], [main[one]], [np.zeros(int(one.sum()), np.int64)], [total[one]], [sure[one]]]
    for t in np.flatnonzero(~one):
        rows = segments_of(units[start[t] : stop[t]], sizes[start[t] : stop[t]])
        lang, at, k, conf = map(np.array, zip(*rows))
        for col, v in zip(out, (np.full(len(rows), owner[start[t]]), np.full(len(rows), total[t]), lang, at, k, conf)):
            col.append(v)
    return tuple(np.concatenate(c) for c in out)


# ---- all texts ----------------------------------------------------------------


def stretches(rows: DataFrame, model: Model) -> DataFrame:
    """(src, id, label, words, lang, first_word, n_words, confidence) for every
    stretch of rows(src, id, text, label); a narrow map."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = "src string, id bigint, label string, words int, lang string, first_word int, n_words int, confidence double"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Scores(sent.value)
        for b in batches:
            memo.trim()
            texts = b.column(2).to_pylist()
            for at in range(0, len(texts), BLOCK):
                found = analyse([_TOKEN.findall(plain(t).lower()) for t in texts[at : at + BLOCK]], memo)
                who = pa.array(found[0] + at)
                cols = [b.column(0).take(who), b.column(1).take(who), b.column(3).take(who), pa.array(found[1], pa.int32()), pa.array(np.array(LANGUAGES, object)[found[2]], pa.string())]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(found[3], pa.int32()), pa.array(found[4], pa.int32()), pa.array(found[5], pa.float64())], names=names)

    return rows.select("src", "id", "text", "label").mapInArrow(run, schema)


def _rows(spark: SparkSession, base: str) -> DataFrame:
    d = table(spark, base, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    c = chunk_texts(spark, base, "idioma").select(F.lit("chunks").alias("src"), F.col("chunk_id").alias("id"), F.col("texto").alias("text"), F.col("idioma").alias("label"))
    return d.unionByName(c).where("text is not null and text <> ''")


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    rows = _rows(spark, base)
    s = stretches(rows, fit(rows)).where(f"words >= {MIN_WORDS} and n_words >= {MIN_WORDS}")
    known = F.create_map(*[F.lit(x) for kv in _OF_LABEL.items() for x in kv])
    label = F.lower(F.trim("label"))
    names = F.coalesce(F.element_at(known, label), F.element_at(known, F.regexp_extract(label, r"^(\p{L}+)", 1)))
    return s.where(names.isNull() | (names != F.col("lang"))).select("src", F.col("id").alias("rec_id"), F.col("lang").alias("found_lang")).distinct()


def p3_segments(spark: SparkSession, base: str) -> DataFrame:
    """Every stretch with its language and confidence; the longest gives the text's language."""
    rows = _rows(spark, base)
    s = stretches(rows, fit(rows)).distinct()
    return s.select("src", F.col("id").alias("rec_id"), "first_word", "n_words", F.col("lang").alias("found_lang"), F.round("confidence", 4).alias("confidence"))
