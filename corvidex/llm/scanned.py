"""Problem 2: noise in text from scanned pages.

Method: a hidden Markov model labels each line as body, header, page number or
break from layout features (repeated within the text or alike its title, a
number pattern, whether it interrupts a sentence, punctuation at its end,
letter case, separators, place).  Its parameters start from fixed tables and
are re-estimated by Viterbi training on the feature sequences of all texts that
hold a line in question.  Paragraphs are reassembled from body lines: words
split by a mark at a line end are joined, header and page lines drop out, and
misread words are replaced.  A line counts as repeated only where its neighbours
differ from one place to the next, as a running line's do: a passage that stands
twice in a text is body, and so is a line that ends in a split word.

A word is misread if a substitution of letters of like shape (CONFUSIONS) turns
it into a word of the corpus vocabulary that is RATIO times as frequent.  A
Cyrillic word may hold a quote or a bar (CYRILLIC); a mark or figure inside it is
evidence by itself, so there the right word only has to be as frequent.  The
vocabulary is counted in the scan that makes the features; misread words are sent
to the workers up to SENT, and beyond it words meet them in a join.

Defined cases: null and empty texts have no noise; plain line breaks are none;
compounds that the corpus also writes with a hyphen inside a line are no split
words; repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import big, materialise, small, table

# What recognition writes, and what stood on the page.
CONFUSIONS = (("c", "e"), ("l", "i"), ("0", "o"), ("0", "ó"), ("5", "s"), ("f", "t"), ("ii", "u"), ("cl", "d"), ("1", "l"), ("rn", "m"), ("m", "rn"), ("9", "g"), ("6", "ó"), ("6", "b"), ("li", "h"))
CYRILLIC = (
    ("a1", "а"), ("а1", "а"), ("п'", "п"), ("щ|", "ш"), ("'", ""), ("|", ""), ("1", ""), ("ь1", "ы"), ("ь|", "ы"), ("ьl", "ы"), ("ьі", "ы"), ("0", "о"), ("3", "з"), ("6", "б"), ("4", "ч"),
    ("и", "н"), ("н", "и"), ("п", "л"), ("л", "п"), ("п", "н"), ("н", "п"), ("ш", "щ"), ("щ", "ш"), ("ц", "и"), ("и", "ц"), ("с", "е"), ("е", "с"), ("о", "с"), ("с", "о"), ("з", "э"), ("э", "з"), ("ь", "ъ"), ("ъ", "ь"), ("ж", "х"), ("х", "ж"),
)
#: The right word is at least so many times as frequent, and stands so often.
RATIO, RIGHT = 20, 10
#: Misread words are sent to the workers for repairing texts only up to so many; beyond, each text is joined with its own.
SENT = 400_000

MARKS = "-\u2010\u00ad\u00ac"
_MARK = f"[{MARKS}]"
_SPLIT = re.compile(rf"([^\W\d_]+)({_MARK})[ \t]*\n[ \t]*([^\W\d_]+)")
_JOIN = re.compile(rf"(?<=[^\W\d_]){_MARK}[ \t]*\n[ \t]*(?=[^\W\d_])")
_MARK_AT_END = re.compile(rf"{_MARK}[ \t]*\n")
_WORD = re.compile(r"[^\W_]+")
#: A word with the quotes and bars that stand between Cyrillic letters.
_TOKEN = re.compile(r"[^\W_]+(?:(?<=[\u0400-\u04ff])['|](?=[\u0400-\u04ff])[^\W_]+)*")
_CYRILLIC = re.compile(r"[\u0400-\u04ff]")
#: No word is written so: a mark, or a figure before the last letters.
_BROKEN = re.compile(r"[\u0400-\u04ff](?:['|]|[aа]1|\d(?=[\u0400-\u04ff]))")
_PAGE = re.compile(r"^[\W_]*(?:p[áa]g(?:ina)?\.?|page|p\.|стр\.?|страница|seite|hoja|folio)?[\W_]*\d{1,4}(?:\s*(?:/|de|of|из|sur)\s*\d{1,4})?[\W_]*$", re.IGNORECASE)
_PAGE_ON_LINE = re.compile(r"(?:\s{2,}|\t|\[)\s*[-–—|]?\s*(?:p[áa]g(?:ina)?\.?|page|p\.|стр\.?)?\s*\d{1,4}(?:\s*/\s*\d{1,4})?\s*[\])]?\s*[-–—|]?\s*$|(?:p[áa]g(?:ina)?\.?|page|стр\.?)\s*\d{1,4}\s*\W*$|^\s*\[?\d{1,4}\]?(?:\s*/\s*\d{1,4})?\s*(?:\s{2,}|[|–—]\s)", re.IGNORECASE)
_SEPARATED = re.compile(r"\s[|:/–—-]\s|^\s*[—–|]|[—–|]\s*$")
_ENDS = re.compile(r"[.!?…:;][\"'»”)\]]*\s*$")
_ENDINGS, _CLOSERS = frozenset(".!?…:;"), "\"'»”)]"
_DIGIT = re.compile(r"\d")
_NO_LETTER = re.compile(r"[\W\d_]+")
_COMPOUND = re.compile(r"[^\W\d_]+-[^\W\d_]+")
_DIGIT_AT_EDGE = re.compile(r"^\W*\d|\d\W*$|\d[\W_]*[a-z]{1,3}[\W_]*\d")


# ---- hidden Markov model of lines ---------------------------------------------

BODY, HEADER, PAGE, BREAK = range(4)
#: Features of a line, one bit each.
BLANK, NUMBER, REPEATED, TITLE, INTERRUPTS, NUMBERED, SEPARATED, CAPITALS, OPEN, EDGE, SPLIT = (1 << k for k in range(11))
N_CODES = 1 << 11

# Fixed start of training: chance of each feature in each state (body, header, page, break).
_START = {
    BLANK: (0.001, 0.001, 0.001, 0.999),
    NUMBER: (0.002, 0.002, 0.98, 0.001),
    REPEATED: (0.01, 0.75, 0.20, 0.001),
    TITLE: (0.001, 0.70, 0.005, 0.001),
    INTERRUPTS: (0.04, 0.70, 0.70, 0.10),
    NUMBERED: (0.01, 0.45, 0.10, 0.001),
    SEPARATED: (0.04, 0.60, 0.30, 0.001),
    CAPITALS: (0.01, 0.30, 0.02, 0.001),
    OPEN: (0.60, 0.97, 0.97, 0.50),
    EDGE: (0.10, 0.05, 0.05, 0.01),
    SPLIT: (0.10, 1e-6, 1e-6, 1e-6),
}
_MOVE = np.log(np.array([[0.76, 0.06, 0.06, 0.12], [0.70, 0.01, 0.12, 0.17], [0.55, 0.25, 0.01, 0.19], [0.85, 0.06, 0.06, 0.03]]))


def start_emissions() -> np.ndarray:
    """log P(code | state) from independent features."""
    codes = np.arange(N_CODES)[:, None]
    out = np.zeros((N_CODES, 4))
    for bit, p in _START.items():
        q = np.array(p)
        out += np.where(codes & bit, np.log(q), np.log(1 - q))
    return out


def viterbi(codes: list[int], emit: np.ndarray, move: np.ndarray = _MOVE) -> np.ndarray:
    """Most likely labels of a text's lines."""
    e = emit[codes]
    score, back = e[0] + np.log([0.9, 0.03, 0.03, 0.04]), np.zeros((len(codes), 4), int)
    for t in range(1, len(codes)):
        s = score[:, None] + move
        back[t] = s.argmax(axis=0)
        score = s.max(axis=0) + e[t]
    out = np.empty(len(codes), int)
    out[-1] = score.argmax()
    for t in range(len(codes) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def skeleton(line: str) -> str:
    """Letters of a line, for telling repeated lines."""
    return _NO_LETTER.sub("", line).lower()


def near(a: str, b: set[str]) -> bool:
    """Whether most words of a line stand in the title (misread letters aside)."""
    ws = [w for w in _WORD.findall(a.lower()) if not w.isdigit() and len(w) > 2]
    return len(ws) >= 2 and len(b & set(ws)) * 5 >= len(set(ws)) * 3


def alike(w: str, kind: str) -> bool:
    """Whether a word is another one, one letter aside."""
    return len(w) == len(kind) and sum(a != b for a, b in zip(w, kind)) <= 1


def in_list(stripped: list[str], filled: list[int], p: int) -> bool:
    """Whether a figure follows a short entry that no punctuation closes and no
    sentence goes on after: a figure in a list."""
    if p == 0:
        return False
    above = stripped[filled[p - 1]]
    below = stripped[filled[p + 1]] if p + 1 < len(filled) else ""
    short = len(_WORD.findall(above)) < 3 and not _ENDS.search(above) and above[-1].isalpha()
    return short and not below[:1].islower()


def outer_letters(line: str) -> tuple[str, str]:
    """First and last letter of a line: lines of one skeleton have the same."""
    first = line[0] if line[0].isalpha() else next((c for c in line if c.isalpha()), "")
    last = line[-1] if line[-1].isalpha() else next((c for c in reversed(line) if c.isalpha()), "")
    return first.lower(), last.lower()


def skeletons(text: list[str]) -> list[str | int]:
    """Skeleton of each line, or its place if no other line can have the same."""
    ends = [outer_letters(x) for x in text]
    if len(set(ends)) == len(ends):
        return list(range(len(text)))
    often = Counter(ends)
    return [skeleton(x) if often[e] > 1 else p for p, (x, e) in enumerate(zip(text, ends))]


def running(shapes: list[str | int], page: list[bool]) -> set[int]:
    """Places of lines that stand again in the text with other lines around them, page lines aside."""
    places: dict[str, list[int]] = {}
    for p, x in enumerate(shapes):
        if isinstance(x, str) and len(x) > 3:
            places.setdefault(x, []).append(p)
    if all(len(at) < 2 for at in places.values()):
        return set()
    order = [p for p in range(len(shapes)) if not page[p]]
    rank = {p: k for k, p in enumerate(order)}
    side = lambda p, step: shapes[order[rank[p] + step]] if p in rank and 0 <= rank[p] + step < len(order) else None
    out: set[int] = set()
    for at in places.values():
        if len(at) > 1 and len({side(p, -1) for p in at}) > 1 and len({side(p, 1) for p in at}) > 1:
            out.update(at)
    return out


def features(lines: list[str], title: str | None, openers: frozenset[str] = frozenset()) -> list[int]:
    """Feature code of every line; empty if no line is in question."""
    stripped = [x.strip() for x in lines]
    filled = [k for k, x in enumerate(stripped) if x]
    n = len(filled)
    if n < 2:
        return []
    text = [stripped[k] for k in filled]
    digit = [_DIGIT.search(x) is not None for x in text]
    edged = [d and _DIGIT_AT_EDGE.search(x) is not None for d, x in zip(digit, text)]
    pageish = [e and len(x) <= 40 and _PAGE.match(x) is not None for e, x in zip(edged, text)]
    ended = [x.rstrip(_CLOSERS)[-1:] in _ENDINGS and not page for x, page in zip(text, pageish)]  # a number's point ends no sentence
    shapes = skeletons(text)
    again = running(shapes, pageish)
    titled = [w for w in _WORD.findall((title or "").lower()) if not w.isdigit()]
    words, kind = {w for w in titled if len(w) > 2}, titled[0] if titled else ""
    split = [x[-1] in MARKS and p + 1 < n and x[-2:-1].isalpha() for p, x in enumerate(text)]
    # the nearest line above that is no page line, and below it also has another shape
    above, last = [-1] * n, -1
    for p in range(n):
        above[p] = last
        if not pageish[p]:
            last = p
    below, nxt = [n] * n, n
    for p in range(n - 1, -1, -1):
        below[p] = nxt if nxt == n or shapes[nxt] != shapes[p] else below[nxt]
        if not pageish[p]:
            nxt = p
    out = [BLANK] * len(lines)
    doubt = False
    for p, (k, x) in enumerate(zip(filled, text)):
        c = OPEN * (not ended[p]) | EDGE * (p == 0 or p == n - 1) | SPLIT * split[p]
        c |= NUMBER * (pageish[p] and not in_list(stripped, filled, p))
        c |= REPEATED * (p in again)
        first = _WORD.search(x)
        opener = first is not None and first[0][0].isupper() and first[0].lower() in openers and len(skeleton(x)) > len(first[0]) + 5
        c |= TITLE * (opener or (bool(words) and first is not None and alike(first[0].lower(), kind) and near(x, words)))
        if not ended[p] or c & (NUMBER | REPEATED | TITLE) or edged[p]:
            c |= NUMBERED * (edged[p] and not pageish[p] and _PAGE_ON_LINE.search(lines[k]) is not None)
            c |= SEPARATED * (_SEPARATED.search(x) is not None)
            c |= CAPITALS * (x.upper() == x and len(skeleton(x)) > 5)
            a = above[p]
            if a >= 0 and not ended[a] and below[p] < n:
                after = text[below[p]]
                c |= INTERRUPTS * (after[0].islower() or after[0].isdigit() or text[a][-1] in MARKS)
        out[k] = c
        doubt |= bool(c & (NUMBER | REPEATED | NUMBERED)) or bool(c & TITLE and not c & EDGE) or bool(c & INTERRUPTS and c & (SEPARATED | CAPITALS))
    return out if doubt else []


# ---- passes over the texts ------------------------------------------------------

_PASS = pa.schema([("src", pa.string()), ("id", pa.int64()), ("codes", pa.list_(pa.int16())), ("soft", pa.bool_()), ("splits", pa.list_(pa.string())), ("numbered", pa.list_(pa.int32())), ("kind", pa.string()), ("key", pa.string()), ("n", pa.int64())])
_PASS_DDL = "src string, id bigint, codes array<smallint>, soft boolean, splits array<string>, numbered array<int>, kind string, key string, n bigint"
#: Runs without spaces counted in a task before the counts are sent on.
HELD_RUNS = 300_000


def _loose() -> re.Pattern:
    """Marks and characters without a glyph: they part no word."""
    loose = [c for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) in ("Mn", "Cf")]
    ranges: list[list[int]] = []
    for c in loose:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]+")


_LOOSE = _loose()


def raw_words(text: str) -> list[str]:
    """Lower-case runs without spaces, words split at line ends joined."""
    return (_JOIN.sub("", text) if _MARK_AT_END.search(text) else text).lower().split()


def words_in(run: str) -> list[str]:
    """The words of a run without spaces."""
    if run.isascii():
        return _WORD.findall(run)
    run = _LOOSE.sub("", run)
    return _TOKEN.findall(run) if ("'" in run or "|" in run) else _WORD.findall(run)


def title_openers(rows: DataFrame, share: float = 0.005) -> frozenset[str]:
    """First words of at least ``share`` of all titles: at most 1 / share words."""
    w = F.lower(F.regexp_extract("title", r"^[^\p{L}]*(\p{L}+)", 1))
    counts = rows.where("title is not null").groupBy(w.alias("w")).agg(F.count("*").alias("n")).where("w <> ''")
    total = counts.agg(F.sum("n").alias("t"))
    return frozenset(r["w"] for r in counts.crossJoin(F.broadcast(total)).where(F.col("n") >= share * F.col("t")).where("n >= 3").select("w").collect())


def counted(runs: Counter) -> pa.RecordBatch:
    """Partial counts of words and compounds as rows; the counter of runs is emptied."""
    words: Counter = Counter()
    compounds: Counter = Counter()
    for run, n in runs.items():
        for w in words_in(run):
            words[w] += n
        if "-" in run:
            for w in _COMPOUND.findall(run):
                compounds[w] += n
    runs.clear()
    kinds, keys, n = ["word"] * len(words) + ["compound"] * len(compounds), [*words, *compounds], [*words.values(), *compounds.values()]
    cols = [pa.nulls(len(n), f.type) for f in _PASS][:6] + [pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(cols, schema=_PASS)


def first_pass(rows: DataFrame, openers: frozenset[str] = frozenset()) -> DataFrame:
    """One scan of rows(src, id, text, title): for texts with anything in question
    their feature codes and split words; partial counts of all words (kind word)
    and of compounds written inside a line (kind compound)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: Counter = Counter()
        for b in batches:
            got: dict[str, list] = {f: [] for f in _PASS.names[:6]}
            for src, i, raw, title in zip(*(b.column(k).to_pylist() for k in range(4))):
                runs.update(raw_words(raw))
                soft, splits = False, []
                if "\n" not in raw:
                    continue
                if _MARK_AT_END.search(raw):
                    for x, mark, y in _SPLIT.findall(raw):
                        if mark == "-":
                            splits.append(f"{x.lower()}-{y.lower()}")
                        elif y[0].islower():
                            soft = True
                codes = features(raw.split("\n"), title, openers)
                if codes or soft or splits:
                    for f, v in zip(got, (src, i, codes, soft, splits, [k for k, c in enumerate(codes) if c & NUMBERED])):
                        got[f].append(v)
            if len(runs) > HELD_RUNS:
                yield counted(runs)
            none = [None] * len(got["id"])
            yield pa.RecordBatch.from_pydict({**got, "kind": none, "key": none, "n": none}, schema=_PASS)
        yield counted(runs)

    return rows.select("src", "id", "text", "title").mapInArrow(run, _PASS_DDL)


def corrections(word: str) -> set[str]:
    """Words a misread word may stand for: one confusion undone, at one place or at all."""
    out = set()
    for seen, true in CONFUSIONS:
        if seen not in word or (not seen.isdigit() and len(word) < 4):
            continue
        out.add(word.replace(seen, true))
        k = word.find(seen)
        while k >= 0:
            out.add(word[:k] + true + word[k + len(seen) :])
            k = word.find(seen, k + 1)
    if _CYRILLIC.search(word):
        for seen, true in CYRILLIC:
            if seen not in word or len(word) < (3 if seen in ("a1", "а1") else 4):
                continue
            if true:
                out.add(word.replace(seen, true))
            k = word.find(seen, 1 - bool(true))
            while k >= 0:
                if true or k + len(seen) < len(word):  # what was added stands inside
                    out.add(word[:k] + true + word[k + len(seen) :])
                k = word.find(seen, k + 1)
            if not true:
                out.add(word[0] + word[1:-1].replace(seen, "") + word[-1])
    return {w for w in out if w != word and not any(c.isdigit() or c in "'|" for c in w)}


def misread_words(vocab: DataFrame) -> DataFrame:
    """(word, right): vocabulary words that undo to a word RATIO times as frequent, or as frequent if no word is written so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, c, n, e = [], [], [], []
            for word, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if any(ch.isalpha() for ch in word) and len(word) <= 40:
                    for r in corrections(word):
                        w.append(word), c.append(r), n.append(k), e.append(_BROKEN.search(word) is not None)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(c, pa.string()), pa.array(n, pa.int64()), pa.array(e, pa.bool_())], names=["word", "right", "n", "broken"])

    tried = vocab.mapInArrow(run, "word string, right string, n bigint, broken boolean")
    ok = tried.join(vocab.select(F.col("key").alias("right"), F.col("n").alias("right_n")), "right").where(((F.col("right_n") >= RIGHT) & (F.col("right_n") >= RATIO * F.col("n"))) | (F.col("broken") & (F.col("right_n") >= F.col("n"))))
    return ok.groupBy("word").agg(F.max_by("right", F.struct("right_n", "right")).alias("right"))


class Holds(dict):
    """Whether a run without spaces holds a word of a set; remembered up to HELD_RUNS runs."""

    def __init__(self, wanted: frozenset[str]):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, run: str) -> bool:
        if len(self) >= HELD_RUNS:
            self.clear()
        got = self[run] = not self.wanted.isdisjoint(words_in(run))
        return got


def texts_with(rows: DataFrame, misread: DataFrame) -> DataFrame:
    """(src, id) of rows whose text holds a word of the written table
    ``misread(word, right)``: sent to the workers up to SENT words, joined beyond."""
    schema = "src string, id bigint"
    if misread.count() <= SENT:
        sent = rows.sparkSession.sparkContext.broadcast(frozenset(r["word"] for r in misread.select("word").collect()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            holds = Holds(sent.value)
            for b in batches:
                yield b.select([0, 1]).filter(pa.array([any(map(holds.__getitem__, raw_words(t))) for t in b.column(2).to_pylist()], pa.bool_()))

        return rows.select("src", "id", "text").mapInArrow(run, schema).distinct()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [list({w for r in set(raw_words(t)) for w in words_in(r)}) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], names=["src", "id", "words"])

    each = rows.select("src", "id", "text").mapInArrow(words, schema + ", words array<string>").select("src", "id", F.explode("words").alias("word"))
    return each.join(small(misread.select("word")), "word", "left_semi").select("src", "id").distinct()


def trained(codes: DataFrame, rounds: int = 2, weight: float = 200.0) -> np.ndarray:
    """Emissions by Viterbi training over all code sequences: equal sequences are
    counted once, each round sends back 4 x N_CODES counts at most."""
    seqs = materialise(codes.groupBy("codes").agg(F.count("*").alias("n")), "sequences")
    start = emit = start_emissions()
    for _ in range(rounds):
        sent = codes.sparkSession.sparkContext.broadcast(emit)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros((N_CODES, 4), np.int64)
            for b in batches:
                for seq, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    np.add.at(total, (seq, viterbi(seq, sent.value)), n)
            code, state = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(state, pa.int64()), pa.array(total[code, state])], names=["code", "state", "n"])

        got = seqs.select("codes", "n").mapInArrow(run, "code bigint, state bigint, n bigint").groupBy("code", "state").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros((N_CODES, 4))
        for r in got:
            counts[r["code"], r["state"]] = r["n"]
        # the start tables keep a fixed weight, so rare codes cannot change sides
        prior = np.exp(start) * weight
        scale = np.minimum(1.0, 50 * weight / np.maximum(counts.sum(axis=0), 1))
        emit = np.log(prior + counts * scale) - np.log((prior + counts * scale).sum(axis=0))
    return emit


def labelled(facts: DataFrame, emit: np.ndarray) -> DataFrame:
    """(src, id, header, pagenum) of texts with codes."""
    sent = facts.sparkSession.sparkContext.broadcast(emit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            head, page = [], []
            for seq, num in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                lab = viterbi(seq, sent.value)
                head.append(bool((lab == HEADER).any()))
                page.append(bool((lab == PAGE).any()) or any(lab[k] == HEADER for k in num))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(head), pa.array(page)], names=["src", "id", "header", "pagenum"])

    return facts.select("src", "id", "codes", "numbered").mapInArrow(run, "src string, id bigint, header boolean, pagenum boolean")


class Noise:
    """Facts, misread words and the line model of one set of texts, each made once."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.openers = title_openers(rows)
        scan = materialise(first_pass(rows, self.openers), "scan")
        self.facts = scan.where("kind is null")
        count = lambda kind: scan.where(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("n"))
        self.compounds = count("compound")
        self.vocab = materialise(count("word"), "vocab")
        self.misread = materialise(misread_words(self.vocab), "misread")
        self.coded = self.facts.where("size(codes) > 0").select("src", "id", "codes", "numbered").distinct()
        self.emit = trained(self.coded)

    def split_words(self) -> DataFrame:
        """(src, id) of texts with a word split by a mark.  A hyphen is no split if the
        corpus writes the compound with it more often than the joined word."""
        t = self.facts
        soft = t.where("soft").select("src", "id")
        one = t.select("src", "id", F.explode(F.array_distinct("splits")).alias("key")).distinct()
        keys = materialise(one.select("key").distinct(), "splits")
        comp = self.compounds.join(small(keys), "key", "left_semi").select("key", F.col("n").alias("with_n"))
        joined = keys.withColumn("word", F.replace("key", F.lit("-"), F.lit("")))
        joined = joined.join(self.vocab.select(F.col("key").alias("word"), F.col("n").alias("join_n")), "word", "left").join(comp, "key", "left")
        real = joined.where(F.coalesce("with_n", F.lit(0)) < F.coalesce("join_n", F.lit(0))).select("key")
        return soft.unionByName(one.join(real, "key", "left_semi").select("src", "id")).distinct()

    def found(self) -> DataFrame:
        mark = lambda df, kind: df.select("src", F.col("id").alias("rec_id"), F.lit(kind).alias("noise"))
        lab = materialise(labelled(self.coded, self.emit), "labelled")
        out = mark(self.split_words(), "hyphen").unionByName(mark(texts_with(self.rows, self.misread), "chars"))
        return out.unionByName(mark(lab.where("header"), "header")).unionByName(mark(lab.where("pagenum"), "pagenum")).distinct()


def paragraphs(text: str, title: str | None, emit: np.ndarray, openers: frozenset[str] = frozenset()) -> str:
    """Continuous paragraphs of one text, words as they stand."""
    lines = text.split("\n")
    codes = features(lines, title, openers) if len(lines) > 1 else []
    if codes:
        lab = viterbi(codes, emit)
        drop = {k for k, s in enumerate(lab) if s in (HEADER, PAGE)}
        kept: list[str] = []
        gap = False  # whether a line was dropped since the last one kept
        for k, x in enumerate(lines):
            open_end = bool(kept) and not _ENDS.search(kept[-1])
            # a break only between a dropped line and the middle of a sentence is no paragraph's end
            if k in drop or (not x.strip() and (k - 1 in drop or k + 1 in drop) and open_end):
                gap = gap or k in drop
                continue
            if gap and open_end and kept[-1].strip() and x.strip() and not _MARK_AT_END.search(kept[-1] + "\n"):
                kept[-1] = f"{kept[-1].rstrip()} {x.lstrip()}"  # the sentence a dropped line stood in
            else:
                kept.append(x)
            gap = False
        text = "\n".join(kept)
    text = _JOIN.sub("", text)
    return re.sub(r"(?<![\n.!?…:;])[ \t]*\n(?=[^\W\d_A-ZÁÉÍÓÚÑ])", " ", text)


def corrected(text: str, right: dict[str, str]) -> str:
    """The text with its misread words replaced."""

    def fix(m: re.Match) -> str:
        w = m[0]
        r = right.get(w.lower())
        return w if r is None else r.upper() if w.isupper() and len(w) > 1 else r.capitalize() if w[0].isupper() else r

    return _TOKEN.sub(fix, text)


def reassemble(text: str, title: str | None, emit: np.ndarray, right: dict[str, str], openers: frozenset[str] = frozenset()) -> str:
    """Continuous paragraphs of one text, misread words replaced."""
    return corrected(paragraphs(text, title, emit, openers), right)


def corrected_by_join(texts: DataFrame, misread: DataFrame) -> DataFrame:
    """(src, rec_id, text) of the written texts(src, rec_id, text), corrected: their
    words meet the written table of misread words, and a row gets its own map."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted({w.lower() for w in _TOKEN.findall(t)}) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], names=["src", "rec_id", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [corrected(t, dict(zip(w or (), r or ()))) for t, w, r in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["src", "rec_id", "text"])

    schema = "src string, rec_id bigint, "
    seen = texts.mapInArrow(words, schema + "words array<string>").select("src", "rec_id", F.explode("words").alias("word"))
    own = seen.join(small(misread), "word").distinct().groupBy("src", "rec_id").agg(F.collect_list(F.struct("word", "right")).alias("own"))
    both = texts.join(own, ["src", "rec_id"], "left").select("src", "rec_id", "text", "own.word", "own.right")
    return both.mapInArrow(run, schema + "text string")


def _rows(spark: SparkSession, base: str) -> DataFrame:
    d = table(spark, base, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text", "title")
    c = table(spark, base, "chunks").select(F.lit("chunks").alias("src"), big("chunk_id").alias("id"), F.col("texto").alias("text"), F.col("titulo").alias("title"))
    return d.unionByName(c).where("id is not null and text is not null and text <> ''")


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return Noise(_rows(spark, base)).found()


def p2_repaired(spark: SparkSession, base: str) -> DataFrame:
    """(src, rec_id, text): the repaired text of every row that had noise."""
    rows = _rows(spark, base)
    noise = Noise(rows)
    bad = materialise(noise.found().select("src", F.col("rec_id").alias("id")).distinct(), "noisy")
    here = noise.misread.count() <= SENT
    right = {r["word"]: r["right"] for r in noise.misread.collect()} if here else {}
    sent = spark.sparkContext.broadcast((noise.emit, right, noise.openers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, known, openers = sent.value
        for b in batches:
            out = [corrected(paragraphs(t, title, emit, openers), known) for t, title in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["src", "rec_id", "text"])

    out = rows.join(small(bad), ["src", "id"], "left_semi").select("src", "id", "text", "title").mapInArrow(run, "src string, rec_id bigint, text string").distinct()
    return out if here else corrected_by_join(materialise(out, "paragraphs"), noise.misread).distinct()
