"""Phrase collocations, counted by top-order marginalisation.

Only the longest windows are counted: a word and the words that follow it in its piece, in lead columns ``w1 .. w4``, padded with
the empty string where the piece ends.  Every shorter phrase is a prefix of the windows that begin at it, so one Spark
``ROLLUP`` over the counted windows sums all shorter lengths and each language's words, with no n-gram explosion per length.

A candidate needs ``min_count`` occurrences, and so does every part of it.  First, places are counted by 32 bits of a hash of the next two words,
then of the next three (up to ``MASKED``): words whose bucket has fewer than ``min_count`` places are surely rare, and a window ends (is padded)
before them.  That leaves every phrase with ``min_count`` occurrences its full count and spares the windows that can't
matter.  What is sent to the tasks is a mask of ``2**MASK_BITS`` bits (4 MB) a length, whatever the input; in a corpus so large that the
masks fill up, more windows stay long, and results are the same.

Windows of a slice of texts are counted in the task (numpy), merged per task and then by key over all tasks by Spark, so frequent
words, pairs or passages reach the shuffle as few rows.  The counts of candidates' parts are looked up by joins; one-word parts, of which very many
candidates may hold the same, are spread over ``SALTS`` keys.

Defined cases: a null text has no words; a null language is ``und``.  Equal rows count as often as they
occur.  A very long text is taken whole.  No rows, or no phrase frequent enough: an empty result.  Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.rows import joined, slices, span_hashes
from turnstile.operators.store import top_k_per_group
from turnstile.session import materialize

#: Bytes of text whose windows are counted at once in a task.
COUNT_BYTES = 2 << 20
#: Bits of a mask of words that may be frequent, and the longest phrases that get one.
MASK_BITS = 25
MASKED = 3
#: Keys over which candidates that share a one-word part are spread.
SALTS = 16

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_INSIDE = ~_ENDS
_INSIDE[[32, 9]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Slice:
    """Words of a slice as numbers: ``ids`` into ``words``, ``lang`` of each, and whether the next word follows in the same piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        raw, at = joined(texts, "\n")
        raw = _LOWER[raw]
        flags = np.concatenate(([False], _INSIDE[raw], [False]))
        turns = np.flatnonzero(flags[1:] != flags[:-1])
        begin = turns[::2]
        if len(begin):
            # words at even places, what parts them at odd ones
            both = pa.LargeStringArray.from_buffers(len(turns) - 1, pa.py_buffer(turns.astype(np.int64)), pa.py_buffer(raw))
            coded = both.take(pa.array(np.arange(0, len(turns) - 1, 2))).dictionary_encode()
            self.words, self.ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        else:
            self.words, self.ids = pa.array([], pa.large_string()), np.zeros(0, np.int64)
        piece = np.cumsum(_ENDS[raw], dtype=np.int64)[begin]
        self.linked = np.concatenate((piece[1:] == piece[:-1], [False])) if len(begin) else np.zeros(0, bool)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        text = np.searchsorted(at, begin, side="right") - 1
        self.lang = coded.indices.to_numpy().astype(np.int64)[text]

        data, ends = joined(self.words, "")
        self.hashes = span_hashes(data, ends[:-1], ends[1:])[self.ids]

    def buckets(self, at: np.ndarray, m: int) -> np.ndarray:
        """32 bits of a hash of the language and the ``m`` words from each place on."""
        h = np.array([zlib.crc32(x.encode()) for x in self.langs], np.uint64)[self.lang[at]]
        for k in range(m):
            h = h * np.uint64(0x9E3779B97F4A7C15) + self.hashes[at + k]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(32)).astype(np.int64)

    def may(self, masks: list[np.ndarray], size: int) -> list[np.ndarray]:
        """For 2 .. ``size`` words, at each place: whether that many follow in the piece and no mask says that they, or words of theirs, are rare."""
        out, may = [], self.linked
        for m in range(2, size + 1):
            if m > 2:
                may = may & np.concatenate((may[1:], [False]))[:len(may)]
            if m - 2 < len(masks):
                at = np.flatnonzero(may)
                mask = masks[m - 2]
                bit = (self.buckets(at, m) & (64 * len(mask) - 1)).astype(np.uint64)
                may = may.copy()
                may[at] = (mask[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
            out.append(may)
        return out


def _slices(batches):
    for batch in batches:
        for part in slices(batch, 1, COUNT_BYTES):
            yield _Slice(part.column(1), part.column(0))


def _mask(texts: DataFrame, sent, m: int, min_count: int) -> np.ndarray:
    """One bit for each bucket of ``m`` words, modulo 2**MASK_BITS: set if ``min_count`` places or more fall into the bucket."""
    def count(batches):
        for part in _slices(batches):
            may = part.may(sent.value if sent else [], m)[-1]
            bucket, n = np.unique(part.buckets(np.flatnonzero(may), m), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(n, pa.int64())], names=["bucket", "n"])

    often = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    bit = F.pmod(F.col("bucket"), F.lit(1 << MASK_BITS))
    words = (often.groupBy(F.shiftright(bit, 6).alias("at"))
                  .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(bucket, {1 << MASK_BITS}) % 64 as int))")).alias("bits")).toArrow())
    mask = np.zeros(1 << (MASK_BITS - 6), np.uint64)
    mask[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return mask


def lead_windows(texts: DataFrame, size: int, min_count: int) -> DataFrame:
    """lang, w1 .. w<size> (padded with the empty string) and n: windows of ``texts`` (lang, text), counted a slice at a time."""
    sc = texts.sparkSession.sparkContext
    sent, masks = None, []
    for m in range(2, min(size, MASKED) + 1):
        masks.append(_mask(texts, sent, m, min_count))
        sent = sc.broadcast(list(masks))
    schema = T.StructType([T.StructField("lang", T.StringType()), *[T.StructField(f"w{k + 1}", T.StringType()) for k in range(size)],
                           T.StructField("n", T.LongType())])

    def count(batches):
        for part in _slices(batches):
            pad = len(part.words)
            ids = np.concatenate((part.ids, np.full(size, pad)))
            columns = [part.ids] + [np.where(may, ids[k:k + len(may)], pad) for k, may in enumerate(part.may(sent.value, size), 1)]
            key = part.lang * pad + columns[0]
            for column in columns[1:]:
                _, key = np.unique(key * (pad + 1) + column, return_inverse=True)
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            words = pa.concat_arrays([part.words, pa.array([""], pa.large_string())]).cast(pa.string())
            made = [pa.array(part.langs, pa.string()).take(pa.array(part.lang[first]))]
            made += [words.take(pa.array(c[first])) for c in columns]
            yield pa.RecordBatch.from_arrays([*made, pa.array(n, pa.int64())], names=schema.names)

    return texts.mapInArrow(count, schema)


def phrase_counts(texts: DataFrame, size: int, min_count: int) -> DataFrame:
    """lang, words and f of every phrase of up to ``size`` words with ``min_count`` occurrences, and with no words: each language's total."""
    names = [f"w{k + 1}" for k in range(size)]
    counted = lead_windows(texts, size, min_count).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    rolled = counted.rollup("lang", *names).agg(F.sum("n").alias("f"))
    words = F.filter(F.array(*names), lambda w: w.isNotNull())
    # rolled-up columns are null; a prefix that ends in padding is a shorter phrase once more
    return (rolled.select("lang", words.alias("words"), "f")
                  .where(F.col("lang").isNotNull() & ((F.size("words") == 0) | ((F.element_at("words", -1) != "") & (F.col("f") >= min_count)))))


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def _big(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = 4, min_count: int = 30,
                 inside_percent: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``size`` words.

    a: the phrase's occurrences; l, r: those of its parts at the lowest-scoring cut; n: the language's words;
    score: floor(2000000 * a / (l + r)).  A phrase inside a longer one that occurs ``inside_percent`` percent as often, or more, is left out.
    """
    texts = df.select(F.coalesce(df[lang_col].cast("string"), F.lit("und")).alias("lang"), df[text_col].cast("string").alias("text"))
    found = materialize(phrase_counts(texts, size, min_count), "phrases")
    totals = found.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    found = found.where(F.size("words") > 0)
    length = F.size("words")

    parts = found.where(length < size).select(
        "lang", _joined(F.col("words")).alias("part"), F.col("f"),
        F.explode(F.when(length == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = (found.where(length > 1)
                 .select("lang", "words", _joined(F.col("words")).alias("phrase"), F.col("f").alias("a"), length.alias("m"),
                         F.explode(F.sequence(F.lit(1), length - 1)).alias("k"))
                 .select("lang", "phrase", "a", "k", _joined(F.expr("slice(words, 1, k)")).alias("first"),
                         _joined(F.expr("slice(words, k + 1, m - k)")).alias("rest"),
                         F.when(F.col("k") == 1, salt).otherwise(0).alias("s1"), F.when(F.col("k") == F.col("m") - 1, salt).otherwise(0).alias("s2")))
    left = parts.select("lang", F.col("part").alias("first"), F.col("salt").alias("s1"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("salt").alias("s2"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first", "s1"]).join(right, ["lang", "rest", "s2"])
    both = both.withColumn("_a", _big(F.col("a")) * F.lit(2000000).cast("decimal(7,0)")).withColumn("_lr", _big(F.col("l")) + _big(F.col("r")))
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("_a div _lr").alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.filter(F.flatten(F.transform(F.sequence(F.lit(2), length - 1), lambda m: F.transform(
        F.sequence(F.lit(1), length - m + 1), lambda i: F.slice("words", i, m)))), lambda w: F.size(w) > 1)
    inside = (found.where(length > 2).select("lang", F.explode(inner).alias("w"), "f").select("lang", _joined(F.col("w")).alias("phrase"), "f")
                   .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(inside, ["lang", "phrase"], "left")
                  .where(F.col("longer").isNull() | (100 * _big(F.col("longer")) < inside_percent * _big(F.col("a"))))
                  .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best = top_k_per_group(kept, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "phrase")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                            F.col("score").cast("long").alias("score"))
