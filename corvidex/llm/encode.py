"""Problem 8: encode every text with a public byte-level BPE vocabulary.

Method: forced-boundary splitting.  A byte pair that occurs inside no
vocabulary token can never be merged over, so a text may be cut there, its
fragments encoded on their own and the ids concatenated.  Cuts are made where
such a pair is also a boundary of the pre-tokeniser (before ASCII white space
that follows other text, and inside long runs of ASCII letters), so the
fragments' ids are exactly those of the whole text.  Fragments repeat heavily
(words with their leading space), so each worker encodes a fragment once.

Defined cases: null and empty texts give an empty list; blank texts are
encoded like any other; special-token strings are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FOLDER = "/opt/tokenizers"
#: Pre-tokeniser pattern of the byte-level vocabulary (fixed value of the public format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fragments a worker keeps encoded; beyond it the memo is emptied (speed only, never results).
MEMO_ENTRIES = 400_000

_PIECES = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_LETTERS = re.compile(r"[A-Za-z]{48,}")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def pairs_inside_tokens(ranks: dict[bytes, int]) -> np.ndarray:
    """256 x 256 booleans: whether byte a directly before byte b occurs in any token."""
    seen = np.zeros((256, 256), dtype=bool)
    for t in ranks:
        if len(t) > 1:
            b = np.frombuffer(t, dtype=np.uint8)
            seen[b[:-1], b[1:]] = True
    return seen


def crossing_chars(ranks: dict[bytes, int], space: str) -> tuple[set[str], bool]:
    """Characters that some token holds directly before ``space``; True if a
    token begins inside such a character, so that it cannot be named."""
    chars: set[str] = set()
    unknown = False
    white = b" \t\n\r"
    for t in ranks:
        for j in range(1, len(t)):
            if t[j] == ord(space) and t[j - 1] not in white:
                k = j - 1
                while k > 0 and 0x80 <= t[k] < 0xC0:
                    k -= 1
                try:
                    chars.add(t[k:j].decode()[-1])
                except UnicodeDecodeError:
                    unknown = True
    return chars, unknown


class Memo(dict):
    """Fragment -> ids; a missing fragment is encoded once."""

    def __init__(self, bpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> list[int]:
        ids = self.bpe.encode_ordinary(piece)
        if len(piece) <= 64:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Worker-side encoder: vocabulary, cut table and fragment memo."""

    def __init__(self, path: str):
        import tiktoken

        ranks = read_ranks(path)
        self.inside = pairs_inside_tokens(ranks)
        self.bpe = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo = Memo(self.bpe)
        soft: list[str] = []
        for c in " \t\n\r":
            before = self.inside[:, ord(c)].copy()
            before[[ord(w) for w in " \t\n\r"]] = False
            if before.any():  # some token holds the pair: the cut is certain only after other characters
                chars, unknown = crossing_chars(ranks, c)
                soft.append(f"(?s:.){re.escape(c)}" if unknown else f"[{''.join(map(re.escape, sorted(chars)))}]{re.escape(c)}")
        self.uncertain = re.compile("|".join(soft)) if soft else None

    def fragments(self, text: str) -> list[str]:
        pieces = _PIECES.findall(text)
        if self.uncertain is not None and self.uncertain.search(text):
            pieces = self._rejoin(pieces)
        if len(text) > 64 * len(pieces) or max(map(len, pieces)) > 256:
            pieces = [q for p in pieces for q in self._letter_cuts(p)]
        return pieces

    def _rejoin(self, pieces: list[str]) -> list[str]:
        out: list[str] = []
        for p in pieces:
            if out and p[0] in " \t\n\r" and self.inside[out[-1].encode()[-1], ord(p[0])]:
                out[-1] += p
            else:
                out.append(p)
        return out

    def _letter_cuts(self, piece: str) -> list[str]:
        """Cut long letter runs where the pair is in no token, so no fragment grows with the text."""
        cuts = [0]
        for m in _LETTERS.finditer(piece):
            b = np.frombuffer(m[0].encode(), dtype=np.uint8)
            # the first four letters may belong to a contraction such as 'll
            cuts += [m.start() + 1 + int(i) for i in np.flatnonzero(~self.inside[b[:-1], b[1:]]) if i >= 4]
        return [piece[a:b] for a, b in zip(cuts, [*cuts[1:], len(piece)])]

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, self.fragments(text)))) if text else []


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = DEFAULT_FOLDER, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(id_col, ids) for every row of ``df``.  A narrow map: one scan of two columns, no shuffle."""
    path = os.path.join(folder, vocabulary)
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            flat: list[np.ndarray] = []
            ends = np.zeros(batch.num_rows + 1, dtype=np.int32)
            n = 0
            for i, t in enumerate(batch.column(1).to_pylist(), 1):
                ids = enc.encode(t)
                n += len(ids)
                ends[i] = n
                flat.append(np.array(ids, dtype=np.int32))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], names=[id_col, "ids"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(ids: list[int], folder: str = DEFAULT_FOLDER, vocabulary: str = "byte_bpe_50k.tiktoken") -> str:
    """Inverse of the encoding, for round-trip tests."""
    return encoder(os.path.join(folder, vocabulary)).bpe.decode(ids)
