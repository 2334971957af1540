"""Arrow batches of texts: bounded slices, and the words of many texts as byte positions.

A text operator maps a column of texts to columns of results.  ``map_texts`` runs such a mapping
over every row, in slices of a bounded number of bytes, so that memory doesn't depend on how
Spark cuts its batches; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that one slice holds, beyond its first row.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, text_at: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of text, each of one row at least."""
    if not batch.num_rows:
        return
    n = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(n, dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = at[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(at, before + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def map_texts(df: DataFrame, fields: list[T.StructField], fn: Callable, keep: list[str],
              text_col: str = "text", setup: Callable | None = None) -> DataFrame:
    """``keep`` columns of ``df`` plus ``fields``, which ``fn`` computes from a slice of the texts.

    ``fn(texts)``, or ``fn(texts, setup())`` with one ``setup()`` a task, returns one array for each
    field.  An input column whose name is also a field's is replaced by the field.
    """
    names = {f.name.lower() for f in fields}
    keep = [c for c in keep if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    shared = text_col in keep and isinstance(df.schema[text_col].dataType, T.StringType)
    at, n = keep.index(text_col) if shared else len(keep), len(keep)

    def run(batches):
        state = (setup(),) if setup else ()
        for batch in batches:
            for part in slices(batch, at):
                made = fn(part.column(at), *state)
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n)] + made, names=schema.names)

    rows = df.select(*keep) if shared else df.select(*keep, df[text_col].cast("string").alias("_text_" + "_".join(keep)))
    return rows.mapInArrow(run, schema)


def joined(texts: pa.Array, end: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, each followed by ``end``, and where each begins (plus the total)."""
    kind = pa.large_string()
    whole = pc.binary_join_element_wise(pc.fill_null(texts.cast(kind), ""), pa.scalar("", kind), pa.scalar(end, kind))
    at = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, offset=8 * whole.offset)
    data = np.frombuffer(whole.buffers()[2], np.uint8) if whole.buffers()[2] else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


class Words:
    """Words of many texts: runs of the bytes in ``chars`` (a table of 256 flags).

    ``data`` holds all words with A-Z in lower case if ``lower``, one space after each word and one
    more after each text; ``begin``/``end`` are the words' places there; ``first`` has the index of
    each text's first word (plus the total).  No run of words crosses two texts, since the second
    space parts them.
    """

    def __init__(self, texts: pa.Array, chars: np.ndarray, lower: bool):
        raw, at = joined(texts, "\n\n")
        inside = chars[raw]
        last = np.zeros(len(raw), bool)
        last[1:] = inside[:-1] & ~inside[1:]  # the byte after each word
        kept = inside | last
        kept[at[1:] - 1] = True
        table = np.where(chars, np.arange(256), 32).astype(np.uint8)
        if lower:
            table[65:91] = np.where(chars[65:91], np.arange(97, 123), 32)
        self.data = table[raw[kept]]
        flags = np.concatenate(([False], inside[kept], [False]))
        turns = np.flatnonzero(flags[1:] != flags[:-1])
        self.begin, self.end = turns[::2], turns[1::2]
        before = np.concatenate(([0], np.cumsum(kept)))
        self.text_at = before[at]  # where each text begins in data
        self.first = np.searchsorted(self.begin, self.text_at)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def flags(*, space_split: bool) -> np.ndarray:
    """Word bytes: all but ASCII white space, or ASCII letters and digits and every byte over 0x7F."""
    out = np.zeros(256, bool)
    if space_split:
        out[:] = True
        out[[32, *range(9, 14)]] = False
    else:
        out[48:58] = out[97:123] = out[65:91] = True
        out[128:] = True
    return out


_BYTES = np.random.default_rng(7).integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
# Odd multipliers of the two hashes, and their inverses modulo 2^64.
_STEPS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BACK = tuple(pow(x, -1, 1 << 64) for x in _STEPS)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1), kept for the next slice."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, SLICE_BYTES), base, np.uint64)
        kept[:1] = 1
        kept = _POWERS[base] = np.cumprod(kept, dtype=np.uint64)
    return kept[:n]


class SpanHashes:
    """64-bit hashes of any spans of bytes, whatever their place; ``which``: one of two independent ones."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.which = which
        terms = _BYTES[which][data]
        terms *= _powers(_STEPS[which], len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def _mixed(self, h: np.ndarray, back: np.ndarray) -> np.ndarray:
        h *= back
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed(self.sums[end] - self.sums[begin], _powers(_BACK[self.which], len(self.sums))[begin])

    def rolling(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes from each place on."""
        h = self.sums[size:] - self.sums[:-size]
        return self._mixed(h, _powers(_BACK[self.which], len(h)))


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return SpanHashes(data, which).of(begin, end)
