"""Text scalars as Column expressions (JVM side, inside whole-stage codegen).

Null in, null out, unless said otherwise; empty text gives empty results.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no topic (es, en, pt), as the retrieval semantics define them.
STOPWORDS = tuple(
    dict.fromkeys(
        """
de la que el en y a los del se las por un para con no una su al lo como mas
pero sus le ya o este si porque esta entre cuando muy sin sobre tambien me
hasta hay donde quien desde todo nos durante todos uno les ni contra otros
ese eso ante ellos e esto mi antes algunos qué unos yo otro otras otra él
tanto esa estos mucho quienes nada muchos cual sea poco ella estar haber
estas estaba estamos algunas algo nosotros
son ser sido siendo esta estan estos estas fue fueron era eran han ha hemos
cuales cuál cual como cuando donde cuanto cuantos quienes cuyo cuya cuyos
que qué segun asi tal tales cada mismo misma mismos mismas dentro fuera
puede pueden podria podrian debe deben hace hacen tiene tienen
the of and to in a is for on that with as by at from or an be are this it
was were which has have had not but their its can will more other such
o e do da em para com no na os as um uma dos das ao pelo pela por mais como
mas ou se que nao ser sao foi ate entre sobre
""".split()
    )
)

# One key for names written in several ways.
ENTITY_ALIASES = {
    "u s": "united states", "us": "united states", "usa": "united states", "u s a": "united states", "eeuu": "united states", "ee uu": "united states", "estados unidos": "united states",
    "uk": "united kingdom", "u k": "united kingdom", "reino unido": "united kingdom",
    "eu": "european union", "ue": "european union", "union europea": "european union",
    "un": "united nations", "onu": "united nations", "naciones unidas": "united nations",
    "nato": "north atlantic treaty organization", "otan": "north atlantic treaty organization",
    "mapp oea": "mapp/oea", "mappoea": "mapp/oea",
    "russia": "rusia", "russian": "rusia", "chinese": "china", "republica popular china": "china", "germany": "alemania",
}

# The verb between two mentions names their relation; first match wins.
RELATIONS = (
    (r"\b(opera|operan|operando)\b", "opera_en"),
    (r"\b(controla|controlan|control de)\b", "controla"),
    (r"\b(financia|financian|financiamiento)\b", "financia"),
    (r"\b(desarrolla|desarrollan|desarrollo de)\b", "desarrolla"),
    (r"\b(firma|firmaron|acuerdo|convenio|tratado)\b", "acuerda_con"),
    (r"\b(ataca|atacaron|enfrenta|enfrentamiento|disputa)\b", "confronta"),
    (r"\b(regula|regulan|prohibe|prohiben|norma)\b", "regula"),
    (r"\b(coopera|cooperan|colabora|alianza)\b", "coopera_con"),
    (r"\b(produce|producen|exporta|exportan|suministra)\b", "provee"),
)
CHARS_PER_TOKEN = 2.8
RELATION_SPAN = 220


@lru_cache(maxsize=1)
def accent_map() -> tuple[str, str]:
    """Every precomposed character of the basic plane with its base character, by rule of decomposition."""
    src, dst = [], []
    for cp in range(0xC0, min(sys.maxunicode, 0xFFFF)):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        d = unicodedata.normalize("NFD", chr(cp))
        base = [c for c in d if unicodedata.category(c) != "Mn"]
        if len(d) > 1 and len(base) == 1 and base[0] != chr(cp):
            src.append(chr(cp))
            dst.append(base[0])
    return "".join(src), "".join(dst)


def strip_accents(c: Column) -> Column:
    """Letters without accents: precomposed letters are mapped, loose marks dropped."""
    src, dst = accent_map()
    return F.regexp_replace(F.translate(c, src, dst), r"\p{Mn}+", "")


def sanitize(c: Column) -> Column:
    """Invisible line separators to spaces."""
    return F.translate(c, "\u0085  ", "   ")


def word_line(c: Column, accents: bool = False) -> Column:
    """The words of ``all_words`` in one line, with a space between each two."""
    return F.regexp_replace(F.lower(c) if accents else strip_accents(F.lower(c)), r"[^\p{L}\p{N}_]+", " ")


def all_words(c: Column, accents: bool = False) -> Column:
    """Lower-case words (letters, digits, underscore) in order, without accents unless ``accents``."""
    return F.filter(F.split(word_line(c, accents), " "), lambda w: w != "")


def tokenize(c: Column) -> Column:
    """Retrieval tokens: words of two characters or more that are no stopword."""
    return F.filter(all_words(c), lambda w: (F.length(w) > 1) & ~w.isin(*STOPWORDS))


def once(value: Column, f) -> Column:
    """f(value) with value computed once a row: bound as a lambda's variable, so
    that lambdas inside f do not compute it again for every element."""
    return F.transform(F.array(value), f)[0]


def grams(words: Column, n: int) -> Column:
    """Distinct n-grams of a word array; fewer words make one gram, no words none."""

    def of(w: Column) -> Column:
        many = F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, n), " ")))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(many)

    return once(words, of)


def shingles(c: Column, n: int = 8) -> Column:
    return grams(all_words(c), n)


def norm_text(c: Column) -> Column:
    """Evaluation form: lower case, punctuation to spaces, accents kept."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " "))


def norm_grams(c: Column, n: int = 8) -> Column:
    return grams(all_words(c, accents=True), n)


def containment(a: Column, b: Column) -> Column:
    """Shared grams over the shorter of two gram arrays; 0 if either is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def clean(c: Column) -> Column:
    """White-space hygiene in the order that matters: control characters, words
    split at line ends, blank lines, lone line breaks, space runs, line edges."""
    t = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ")
    t = F.regexp_replace(t, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, r"(?<!\n)\n(?!\n)", " ")
    t = F.regexp_replace(t, r"[ \t   ]+", " ")
    t = F.regexp_replace(t, r" *\n *", "\n")
    return F.trim(F.regexp_replace(t, r"^\s+|\s+$", ""))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.translate(path, "\\", "/"), "/"), -1)


def suffix(path: Column) -> Column:
    """Lower-case extension without the dot, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def guess_title(text: Column, name: Column) -> Column:
    """First line of 11 to 149 characters, else the file stem with separators as spaces."""
    first = F.trim(F.split(F.regexp_replace(text, r"^\s+", ""), "\n")[0])
    return F.when(F.length(first).between(11, 149), first).otherwise(F.trim(F.regexp_replace(stem(name), r"[_\-]+", " ")))


def norm_doc(c: Column) -> Column:
    """Document name for matching: base name, lower case, no separators."""
    return F.regexp_replace(F.lower(file_name(c)), r"[_\-\s]+", "")


def norm_name(c: Column) -> Column:
    """Inventory name: trimmed, lower case, separators as dashes."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[_\s]+", "-")


def norm_entity(c: Column) -> Column:
    """Entity key: folded, punctuation as spaces, aliases resolved."""
    key = F.trim(F.regexp_replace(strip_accents(F.lower(F.trim(c))), r"[^\p{L}\p{N}_]+", " "))
    aliases = F.create_map(*[F.lit(x) for kv in ENTITY_ALIASES.items() for x in kv])
    return F.coalesce(F.element_at(aliases, key), key)


def estimate_tokens(c: Column) -> Column:
    return (F.floor(F.length(c) / F.lit(CHARS_PER_TOKEN)) + 2).cast("int")


def embedding_text(title: Column, context: Column, text: Column) -> Column:
    """title — context. text, missing parts left out."""
    body = F.concat_ws(". ", F.when(context != "", context), text)
    return F.concat_ws(" — ", F.when(title != "", title), body)


def relation_type(between: Column) -> Column:
    """Label of the text between two mentions; null beyond RELATION_SPAN characters."""
    low = F.lower(between)
    out = F.when(F.length(low) > RELATION_SPAN, F.lit(None).cast("string"))
    for pattern, label in RELATIONS:
        out = out.when(low.rlike(pattern), F.lit(label))
    return out.otherwise(F.lit("coocurre_con"))


def is_stat_number(c: Column) -> Column:
    return F.trim(c).rlike(r"^[\$€£]?\s*[\d.,]+\s*[%kKmMbB+]?$")


def is_useful(text: Column, kind: Column, min_words: int = 4) -> Column:
    """Whether a unit can support retrieval: it holds more than figures and marks and,
    unless it is a callout or heading, ``min_words`` words and at most half digits.
    Null and blank texts cannot."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    words = F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    digits = F.length(F.regexp_replace(t, r"\P{Nd}", ""))
    bare = t.rlike(r"^[\s\d.,:;|/\\\-–—•·()\[\]]*$")
    return F.coalesce(~bare & (kind.isin("callout", "heading") | ((words >= min_words) & (digits <= 0.5 * F.length(t)))), F.lit(False))


def windows(text: Column, size: int = 300, overlap: int = 40) -> Column:
    """array<struct<start_word, text>>: overlapping word windows; a text within one window is one."""
    step = max(1, size - overlap)

    def of(w: Column) -> Column:
        last = F.greatest(F.ceil((F.size(w) - size) / F.lit(step)).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.struct((k * step).alias("start_word"), F.array_join(F.slice(w, k * step + 1, size), " ").alias("text")))

    return once(F.filter(F.split(text, r"\s+"), lambda x: x != ""), of)


def html_text(html: Column) -> Column:
    """Visible text of a page: non-content elements dropped, tags as line breaks, entities decoded."""
    t = F.regexp_replace(html, r"(?is)<!--.*?-->", "")
    for tag in ("script", "style", "nav", "footer", "header", "aside", "noscript"):
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", "\n")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return clean(t)
