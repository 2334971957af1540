"""Periodic runs of words: block convolution at dyadic scales.

A run is a stretch of words with smallest period q (words q apart are the same), of ``EXPONENT`` q words or more, and of ``SHORTEST`` or
more, that no neighbouring word extends.  At scale B (1, 2, 4, ...) the periods B <= q < 2B are found:

* The words are cut into blocks of B.  A run of period q has three periods or more that are followed by their repeat, so it holds
  whole blocks whose next occurrence at distance q lies in the window of 2B words that follows the block.
* With words as distinct numbers, block P occurs at distance d of window T where sum (P[i] - T[d + i])^2 is zero.  That sum is sum P^2 +
  sum T^2 - 2 sum P T, and the last is a convolution, taken for all d at once by a number-theoretic transform:
  whole numbers modulo a prime, no rounding.  Many blocks are transformed together.
* Blocks in a row with the same distance make a chain.  A chain long enough for a run is extended word by word at both ends,
  and the words of what results are compared one by one (a sum that is a multiple of the prime by chance ends there).

Two exact shortcuts come first: a block one of whose words doesn't occur again B to 2B words later has no occurrence, and one whose
window lies inside a run of a shorter period has only occurrences that repeat that run (its period divides them).

Runs are found slice by slice, many texts in one row of numbers; a run never crosses texts.  Work grows with n log^2 n of a text's words.

Defined cases: a null or empty text has no words and no runs, and its collapsed text is empty.  Equal rows are all
kept.  Columns of the input named as a result are replaced, other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from turnstile.llm.rows import Words, flags, map_texts

EXPONENT = 4
SHORTEST = 6
#: The prime 119 * 2^23 + 1 and a generator: transforms of up to 2^23 numbers.
PRIME, ROOT, ROOT_BITS = 998244353, 3, 23
#: Numbers transformed at once.
TRANSFORM = 1 << 17
#: Words of a block looked up before it is transformed.
LOOKED_UP = 8

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RESULT = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]

_TWISTS: dict[tuple[int, bool], np.ndarray] = {}


def _twists(half: int, back: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half, or of its inverse."""
    if (half, back) not in _TWISTS:
        root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if back else root
        out = np.ones(half, np.int64)
        size = 1
        while size < half:
            out[size:2 * size] = out[:size] * pow(root, size, PRIME) % PRIME
            size *= 2
        _TWISTS[half, back] = out
    return _TWISTS[half, back]


def transform(x: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row (a power of two long), its result in bit-reversed order."""
    rows, size = x.shape
    half = size // 2
    while half:
        y = x.reshape(rows, -1, 2, half)
        a, b = y[:, :, 0], y[:, :, 1]
        x = np.stack(((a + b) % PRIME, (a - b) * _twists(half, False) % PRIME), axis=2)
        half //= 2
    return x.reshape(rows, size)


def back_transform(x: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    rows, size = x.shape
    half = 1
    while half < size:
        y = x.reshape(rows, -1, 2, half)
        a, b = y[:, :, 0], y[:, :, 1] * _twists(half, True) % PRIME
        x = np.stack(((a + b) % PRIME, (a - b) % PRIME), axis=2)
        half *= 2
    return x.reshape(rows, size) * pow(size, -1, PRIME) % PRIME


def mismatch_sums(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, sum (blocks[i] - windows[d + i])^2 modulo the prime, for d = 0 .. B - 1 (windows are 2B long)."""
    rows, size = blocks.shape
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, 2 * size - 1:size:-1] = blocks[:, 1:]
    cross = back_transform(transform(turned) * transform(windows) % PRIME)[:, :size]
    squares = np.concatenate((np.zeros((rows, 1), np.int64), np.cumsum(windows * windows % PRIME, axis=1)), axis=1)
    own = (blocks * blocks % PRIME).sum(axis=1, keepdims=True)
    return (own + squares[:, size:2 * size] - squares[:, :size] - 2 * cross) % PRIME


class _Recurrence:
    """Whether a word occurs again within given distances."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids) + 1
        order = np.argsort(ids, kind="stable")
        self.keys = np.append(ids[order] * self.n + order, np.iinfo(np.int64).max)

    def within(self, at: np.ndarray, least: int, end: int) -> np.ndarray:
        base = self.ids[at] * self.n + at
        return self.keys[np.searchsorted(self.keys, base + least)] < base + end


def _seeds(values: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) where the block of ``size`` words at a place occurs ``size`` to 2 * size - 1 words later."""
    padded = np.concatenate((values, np.zeros(3 * size, np.int64)))
    block, window = np.arange(size), size + np.arange(2 * size)
    places, distances = [], []
    step = max(1, TRANSFORM // (2 * size))
    for k in range(0, len(at), step):
        rows = at[k:k + step, None]
        row, d = np.nonzero(mismatch_sums(padded[rows + block], padded[rows + window]) == 0)
        places.append(at[k + row])
        distances.append(d + size)
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, distances))


def _extended(ids: np.ndarray, at: np.ndarray, d: np.ndarray, low: np.ndarray, high: np.ndarray, size: int, step: int) -> np.ndarray:
    """How many of up to ``size`` words from each place on (``step`` 1: forwards, -1: backwards) equal the word d after them, inside [low, high)."""
    out = np.zeros(len(at), np.int64)
    rows = max(1, TRANSFORM // size)
    for k in range(0, len(at), rows):
        p = at[k:k + rows, None] + step * np.arange(size)
        q = p + d[k:k + rows, None]
        inside = (p >= low[k:k + rows, None]) & (q < high[k:k + rows, None])
        same = inside & (ids[np.where(inside, p, 0)] == ids[np.where(inside, q, 0)])
        out[k:k + rows] = np.where(same.all(axis=1), size, np.argmin(same, axis=1))
    return out


def _exact(ids: np.ndarray, start: int, end: int, d: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) among the words [start, end), by comparing each word with the one d after it."""
    same = np.concatenate(([False], ids[start:end - d] == ids[start + d:end], [False]))
    turns = np.flatnonzero(same[1:] != same[:-1])
    return [(start + int(a), start + int(b) + d, d) for a, b in zip(turns[::2], turns[1::2], strict=True) if b - a + d >= max(SHORTEST, EXPONENT * d)]


def find_runs(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs of many texts, in rows (start, end, period) by start and period; ``ids``: words as numbers, ``first``: each text's first word, and the total."""
    n = len(ids)
    sizes = np.diff(first)
    low = np.repeat(first[:-1], sizes)
    high = np.repeat(first[1:], sizes)
    values = ids * 738871813 % PRIME  # distinct numbers stay distinct
    again = _Recurrence(ids)
    found: dict[tuple[int, int], int] = {}
    reach = np.zeros(n, np.int64)  # the furthest end of a run that starts here or before
    size = 1
    while EXPONENT * size <= (sizes.max() if n else 0):
        at = np.arange(0, n - 2 * size + 1, size)
        at = at[(at + 2 * size <= high[at]) & (reach[at] < np.minimum(at + 3 * size, high[at]))]
        for k in np.unique(np.linspace(0, size - 1, min(size, LOOKED_UP)).astype(np.int64)):
            at = at[again.within(at + k, size, 2 * size)]
        place, d = _seeds(values, at, size)
        on = (place + d + size <= high[place]) & (reach[place] < place + d + size)
        place, d = place[on], d[on]
        # chains: blocks in a row with the same distance
        order = np.lexsort((place, d))
        place, d = place[order], d[order]
        head = np.ones(len(place), bool)
        head[1:] = (d[1:] != d[:-1]) | (place[1:] != place[:-1] + size) | (low[place[1:]] != low[place[:-1]])
        heads = np.flatnonzero(head)
        blocks = np.diff(np.append(heads, len(place)))
        place, d = place[heads], d[heads]
        long = blocks * size + 2 * (size - 1) >= (EXPONENT - 1) * d
        place, d, end = place[long], d[long], (place + blocks * size)[long]
        left = _extended(ids, place - 1, d, low[place], high[place], size, -1)
        right = _extended(ids, end, d, low[place], high[place], size, 1)
        new = []
        for a, b, q in zip((place - left).tolist(), (end + right + d).tolist(), d.tolist(), strict=True):
            if b - a >= max(SHORTEST, EXPONENT * q):
                new += _exact(ids, a, b, q)
        for a, b, q in new:
            found[a, b] = min(q, found.get((a, b), q))  # the same words with a multiple of their period
            reach[a] = max(reach[a], b)
        np.maximum.accumulate(reach, out=reach)
        size *= 2
    return np.array(sorted((a, b, q) for (a, b), q in found.items()), np.int64).reshape(-1, 3)


def _slice_runs(texts: pa.Array) -> list:
    words = Words(texts, flags(space_split=True), lower=False)
    n, begin, end = len(words.begin), words.begin, words.end
    if n:
        both = np.stack((begin, end), axis=1).ravel().astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(both) - 1, [None, pa.py_buffer(both), pa.py_buffer(words.data)])
        ids = parts.take(pa.array(np.arange(0, len(both) - 1, 2))).dictionary_encode().indices.to_numpy().astype(np.int64)
    else:
        ids = np.zeros(0, np.int64)
    first = words.first.astype(np.int64)
    runs = find_runs(ids, first)
    text = np.searchsorted(first, runs[:, 0], side="right") - 1
    # words after the first period of a run go
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
    marks = np.zeros(len(words.data) + 1, np.int8)
    marks[begin[kept]] = 1
    marks[end[kept] + 1] -= 1  # each word with the space after it
    on = np.cumsum(marks[:-1], dtype=np.int8) > 0
    of = np.searchsorted(first, kept, side="right") - 1
    on[end[kept[np.append(of[1:] != of[:-1], True)]] if len(kept) else []] = False  # but a text's last
    at = np.concatenate(([0], np.cumsum(on)))[np.append(words.text_at[:len(texts)], len(words.data))].astype(np.int64)
    collapsed = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(words.data[on]))).cast(pa.string())
    fields = [pa.array(x) for x in (runs[:, 0] - first[text], runs[:, 1] - runs[:, 0], runs[:, 2])]
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()),
                                     pa.StructArray.from_arrays(fields, names=RUN.names))
    return [pa.array(words.counts, pa.int64()), lists, collapsed]


def periodic_runs(df: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all, unless given) plus n_words, runs (by start, then period; words are numbered from 0) and collapsed.

    collapsed: the words, joined by one space, without those that any run holds after its first period.
    """
    return map_texts(df, RESULT, _slice_runs, keep=list(df.columns if keep is None else keep), text_col=text_col)
