"""Token counts: Viterbi over a unigram vocabulary that keeps only scores and counts.

An Aho-Corasick automaton of the vocabulary enumerates, for each place where a match ends, all
pieces that end there.  The dynamic programme carries the best score and its piece count for each
place of the word; no path is stored.  Ties are settled as the tokenizers library settles them:
pieces are held against a place in the order of their beginnings, and a later one wins only with a
strictly greater score, so of equal scores the longest last piece stays.  A character that
no single-character piece matches is an unknown piece, at the lowest score of the vocabulary less
10; neighbouring unknown characters count as one piece (``fuse_unk``), or as their UTF-8 bytes if the
vocabulary has all byte pieces (``byte_fallback``).

Before that a text is cut as the library's Metaspace step does: each space becomes U+2581, the
first word gets one too, and each word begins with one.  Words are scored apart, so a task
remembers the counts of words it has seen (``CACHE_WORDS`` at most, then it starts anew).

The vocabulary is a file of a public tokenizer, read where it lies; nothing is trained.  Null or
empty text: no pieces.
"""

from __future__ import annotations

import functools
import math
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from turnstile.llm.rows import map_texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task keeps: bounds its memory.
CACHE_WORDS = 300_000
#: A longer word isn't kept.
CACHE_CHARS = 64

FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("n_unknown", T.LongType()), T.StructField("score", T.DoubleType())]


@functools.lru_cache(2)
def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Unigram:
    """Counts pieces of words; equal to the tokenizers library's Unigram model on each of them."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.scores = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.scores.add_word(piece, (len(piece), score))
        self.scores.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        pieces = {piece for piece, _ in vocabulary}
        self.single = {piece for piece in pieces if len(piece) == 1}
        self.bytes = all(f"<0x{i:02X}>" in pieces for i in range(256))
        self.cache: dict[str, tuple[int, int, float]] = {}

    def word(self, word: str) -> tuple[int, int, float]:
        """(pieces, unknown pieces or their bytes, score) of one word."""
        if not self.single.issuperset(word):
            return self._with_unknown(word)
        # every character is a piece, so every place is reached by known pieces alone
        best, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for end, (length, score) in self.scores.iter(word):  # by end, longest first
            end += 1
            value = score + best[end - length]
            if value > best[end]:
                best[end], count[end] = value, count[end - length] + 1
        return count[-1], 0, best[-1]

    def _with_unknown(self, word: str) -> tuple[int, int, float]:
        size = len(word)
        best: list[float | None] = [None] * (size + 1)
        count, last_unknown, unknown = [0] * (size + 1), [False] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        ends: list = [()] * size
        for end, found in self.scores.iter(word):
            ends[end] = (*ends[end], found)
        for end in range(size):
            single = False
            top, at, is_unknown = None, 0, False
            for length, score in sorted(ends[end], reverse=True) if len(ends[end]) > 1 else ends[end]:
                single |= length == 1
                value = score + best[end + 1 - length]
                if top is None or value > top:
                    top, at = value, end + 1 - length
            if not single:
                value = self.unknown + best[end]
                if top is None or value > top:
                    top, at, is_unknown = value, end, True
            best[end + 1] = top
            if not is_unknown:
                count[end + 1], unknown[end + 1] = count[at] + 1, unknown[at]
            elif self.bytes:
                n = len(word[end].encode())
                count[end + 1], unknown[end + 1] = count[at] + n, unknown[at] + n
            else:
                n = 0 if last_unknown[at] else 1
                count[end + 1], unknown[end + 1] = count[at] + n, unknown[at] + n
            last_unknown[end + 1] = is_unknown
        return count[size], unknown[size], best[size]

    def text(self, text: str) -> tuple[int, int, float]:
        n = u = 0
        score = 0.0
        if not text:
            return n, u, score
        cache = self.cache
        # split at spaces and at U+2581 alike: the library can't tell them apart after the change
        for part in re.split("[ ▁]", text)[text[0] in " ▁":]:
            got = cache.get(part)
            if got is None:
                got = self.word(SPACE + part)
                if len(part) <= CACHE_CHARS:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[part] = got
            n += got[0]
            u += got[1]
            score += got[2]
        return n, u, score


@functools.lru_cache(2)
def _model(path: str) -> Unigram:
    return Unigram(read_vocabulary(path))


def _count(texts: pa.Array, model: Unigram) -> list:
    rows = [model.text(t or "") for t in texts.to_pylist()]
    return [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.float64())]


def count_tokens(docs: DataFrame, vocabulary_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) plus n_tokens, n_unknown and the best path's score.

    Columns with these three names are replaced.
    """
    return map_texts(docs, FIELDS, _count, keep=docs.columns if keep is None else keep, text_col=text_col,
                     setup=lambda: _model(vocabulary_path))
