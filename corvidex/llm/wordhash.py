"""Words and word shingles as 64-bit hashes, a batch of texts at a time.

A text's words go through a memo (raw word -> hash of its compared form), so
folding is done once a distinct word and not once a character; shingles of a
whole batch are computed in one go and those that cross a text's end are
masked out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

from .common import mix64
from .lookalike import plain, token_repairs

_WORD = re.compile(r"[^\W_]+")
MEMO_WORDS = 1_000_000
#: Words handled at once.
BLOCK_WORDS = 400_000


def fold(word: str) -> str:
    """A word without accents."""
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


class Words(dict):
    """Memo of word hashes; ``accents`` keeps them apart."""

    def __init__(self, accents: bool):
        super().__init__()
        self.accents = accents

    def __missing__(self, word: str) -> int:
        import xxhash

        w = word
        if not w.isascii():
            for t, r in token_repairs(w):
                if t == w:
                    w = r.lower()
            if not self.accents:
                w = fold(w)
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(w)
        return h


def split(text: str) -> list[str]:
    """Lower-case words of a text in its consistent form."""
    return _WORD.findall(plain(text).lower())


def flat(texts: Iterable[list[str]], memo: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of the text it stands in)."""
    lists = list(texts)
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    h = np.fromiter(map(memo.__getitem__, chain.from_iterable(lists)), np.uint64, int(n.sum()))
    return h, np.repeat(np.arange(len(lists)), n)


class Runs(dict):
    """Memo of runs without spaces: the hash of a run's word (even), or for a run of
    no word or several an odd number that leads to their hashes."""

    def __init__(self, words: Words):
        super().__init__()
        self.words = words
        self.several: list[np.ndarray] = []

    def __missing__(self, run: str) -> int:
        hs = [self.words[w] & ~1 for w in split(run)]
        if len(hs) == 1:
            code = hs[0]
        else:
            code = 2 * len(self.several) + 1
            self.several.append(np.array(hs, np.uint64))
        self[run] = code
        return code


def flat_runs(texts: list[list[str]], memo: Runs) -> tuple[np.ndarray, np.ndarray]:
    """As ``flat``, of texts split at spaces only: words are found once a distinct run."""
    if len(memo) > MEMO_WORDS:
        memo.clear(), memo.several.clear()
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.fromiter(map(memo.__getitem__, chain.from_iterable(texts)), np.uint64, int(n.sum()))
    who = np.repeat(np.arange(len(texts)), n)
    odd = np.flatnonzero(h & np.uint64(1))
    if not len(odd):
        return h, who
    parts = [memo.several[c >> 1] for c in h[odd].tolist()]
    sizes = np.ones(len(h), np.int64)
    sizes[odd] = inner = np.fromiter(map(len, parts), np.int64, len(parts))
    first = np.cumsum(sizes) - sizes
    out = np.repeat(h, sizes)
    out[np.repeat(first[odd] - (np.cumsum(inner) - inner), inner) + np.arange(inner.sum())] = np.concatenate(parts)
    return out, np.repeat(who, sizes)


def blocks(lists: list[list[str]]) -> Iterator[tuple[int, list[list[str]]]]:
    """Runs of texts of about BLOCK_WORDS words with the number of the first."""
    start, words = 0, 0
    for i, ws in enumerate(lists):
        words += len(ws)
        if words >= BLOCK_WORDS:
            yield start, lists[start : i + 1]
            start, words = i + 1, 0
    if start < len(lists):
        yield start, lists[start:]


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, in order."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            s = s * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
    return mix64(s)


def shingles_of(h: np.ndarray, who: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stay within one text, with the text's number."""
    s = shingles(h, n)
    inside = who[: len(s)] == who[n - 1 : n - 1 + len(s)]
    return s[inside], who[: len(s)][inside]


def running_min(s: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every window of ``span`` values."""
    if len(s) < span:
        return s[:0]
    m = s[: len(s) - span + 1].copy()
    for i in range(1, span):
        np.minimum(m, s[i : len(s) - span + 1 + i], out=m)
    return m
