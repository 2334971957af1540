"""Benchmark decontamination: Wu-Manber search for the word windows of test items.

Words are runs of ASCII letters, digits and bytes over 0x7F, with A-Z in lower case.  A document
becomes its words with one space after each, so a window of words occurs in it where the bytes
" w1 w2 ... wn " do.  The windows of ``window`` consecutive words of every item (all words of a
shorter item) are the patterns, searched as Wu and Manber do:

* a shift table by the hash of a block of bytes tells how far a search window whose last bytes are
  that block can move on; text that no pattern resembles is skipped nearly a whole pattern at a time;
* at shift 0, the block's bucket has the patterns that end in it within the shortest length;
* a candidate's first bytes are compared, then all its bytes directly.

Patterns go to classes by length, each with tables of its own, so that one short item doesn't
shorten every skip.  Many places of the text move on at once (numpy).

The test items are a stated query set held against all rows.  They are taken in blocks of
``BLOCK_BYTES`` of text at most (or one item), each sent to the tasks, so memory is bounded
whatever their number; documents are never shuffled.  With more than one block the documents
are written between them.

Defined cases: a null text has no words.  Items without words, or with a null id, are left out.
Rows with equal ids are all kept; items with equal texts are all listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.rows import Words, flags, map_texts
from turnstile.session import materialize

WINDOW = 13
#: Bytes of item text searched for at once: bounds what is sent to a task, and its tables.
BLOCK_BYTES = 4 << 20
#: Pattern length classes: lower ends, in bytes.
CLASSES = (3, 8, 24, 48)
TABLE_BITS = 18
LANE = 512

HITS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType(), False)),
        T.StructField("hits", T.ArrayType(T.LongType(), False))]


class WuManber:
    """All occurrences of a set of byte patterns, each at least three bytes long."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        size = np.array([len(p) for p in patterns], np.int64)
        kind = np.searchsorted(CLASSES, size, side="right") - 1
        self.classes = [self._tables(np.flatnonzero(kind == k)) for k in np.unique(kind)]

    def _tables(self, ids: np.ndarray) -> tuple:
        m = min(len(self.patterns[i]) for i in ids)
        block = min(8, max(3, m // 3))
        mask = np.uint64((1 << 8 * block) - 1)
        heads = np.array([list(self.patterns[i][:m]) for i in ids], np.uint64)
        shift = np.full(1 << TABLE_BITS, m - block + 1, np.int64)
        ends = None
        for end in range(block, m + 1):
            value = np.zeros(len(ids), np.uint64)
            for k in range(block):
                value |= heads[:, end - block + k] << np.uint64(8 * k)
            ends = self._hash(value)
            np.minimum.at(shift, ends, m - end)
        order = np.argsort(ends, kind="stable")
        first = np.zeros(len(ids), np.uint64)
        for k in range(min(8, m)):
            first |= heads[:, k] << np.uint64(8 * k)
        prefix = np.uint64((1 << 8 * min(8, m)) - 1)
        return m, block, mask, shift, ends[order], first[order], prefix, ids[order]

    @staticmethod
    def _hash(value: np.ndarray) -> np.ndarray:
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, pattern numbers) of all occurrences in ``data``."""
        text = np.concatenate((data, np.zeros(8, np.uint8)))
        eight = np.lib.stride_tricks.sliding_window_view(text, 8)
        whole = data.tobytes()
        places, found = [], []
        for m, block, mask, shift, ends, first, prefix, ids in self.classes:
            last = len(data) - m + 1
            if last <= 0:
                continue
            at = np.arange(0, last, LANE)
            stop = np.minimum(at + LANE, last)
            while len(at):
                value = eight[at + (m - block)].view("<u8").ravel() & mask
                h = self._hash(value)
                step = shift[h]
                hit = np.flatnonzero(step == 0)
                if len(hit):
                    self._confirm(at[hit], h[hit], eight, whole, ends, first, prefix, ids, places, found)
                    step[hit] = 1
                at = at + step
                on = at < stop
                at, stop = at[on], stop[on]
        return np.array(places, np.int64), np.array(found, np.int64)

    def _confirm(self, at, h, eight, whole, ends, first, prefix, ids, places, found) -> None:
        low, high = np.searchsorted(ends, h, "left"), np.searchsorted(ends, h, "right")
        n = high - low
        who = np.repeat(np.arange(len(at)), n)
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        head = eight[at].view("<u8").ravel() & prefix
        same = head[who] == first[entry]
        for p, i in zip(at[who[same]].tolist(), ids[entry[same]].tolist(), strict=True):
            pattern = self.patterns[i]
            if whole[p:p + len(pattern)] == pattern:
                places.append(p)
                found.append(i)


class ItemIndex:
    """The patterns of a block of items, and which items each belongs to."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        by_pattern: dict[bytes, set[str]] = {}
        if items:
            words = Words(pa.array([text for _, text in items], pa.string()), flags(space_split=False), lower=True)
            data = words.data.tobytes()
            for k, (item, _) in enumerate(items):
                a, b = int(words.first[k]), int(words.first[k + 1])
                for i in range(a, max(b - window + 1, min(a + 1, b))):
                    j = min(i + window, b) - 1
                    pattern = b" " + data[words.begin[i]:words.end[j] + 1]
                    by_pattern.setdefault(pattern, set()).add(item)
        self.patterns = list(by_pattern)
        self.items = [sorted(v) for v in by_pattern.values()]
        self.n_words = np.array([p.count(b" ") - 1 for p in self.patterns], np.int64)
        self.search = WuManber(self.patterns).search if self.patterns else None


def _scan(texts: pa.Array, index: ItemIndex) -> list:
    words = Words(texts, flags(space_split=False), lower=True)
    n = len(texts)
    items: list[set] = [set() for _ in range(n)]
    hits: list[list] = [[] for _ in range(n)]
    n_hit = np.zeros(n, np.int64)
    if index.search:
        # a space in front lets the first word match as the others do
        place, found = index.search(np.concatenate((np.array([32], np.uint8), words.data)))
        first = np.searchsorted(words.begin, place)
        text = np.searchsorted(words.first, first, side="right") - 1
        if len(place):
            cover = np.zeros(len(words.begin) + 1, np.int64)
            np.add.at(cover, first, 1)
            np.add.at(cover, first + index.n_words[found], -1)
            hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
            of = np.searchsorted(words.first, hit, side="right") - 1
            n_hit += np.bincount(of, minlength=n)
            for t, w in zip(of.tolist(), (hit - words.first[of]).tolist(), strict=True):
                hits[t].append(w)
            for t, i in {*zip(text.tolist(), found.tolist(), strict=True)}:
                items[t].update(index.items[i])
    return [pa.array(words.counts, pa.int64()), pa.array(n_hit, pa.int64()),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(hits, pa.list_(pa.int64()))]


def _blocks(items: DataFrame, block_bytes: int):
    """Items in blocks of bounded size, one at the driver at a time."""
    block, size = [], 0
    for item, text in items.toLocalIterator():
        n = len(text.encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += n
    yield block


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus n_words, n_hit, items (ids as sorted strings) and hits (numbers of the words hit).

    ``items`` has item_id and text.  Columns of ``docs`` with these four names, in any case, are replaced.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c.lower() not in {f.name for f in HITS}]
    fresh_name = "_new" + "_" * max(map(len, docs.columns))  # longer than any name here
    chosen = (items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
                   .select(F.col("item_id").cast("string"), F.col("text").cast("string")))
    made = None
    for block in _blocks(chosen, block_bytes):
        sent = spark.sparkContext.broadcast(block)
        fresh = map_texts(docs if made is None else made, [T.StructField(fresh_name + f.name, f.dataType) for f in HITS], _scan,
                          keep=keep if made is None else made.columns, text_col=text_col,
                          setup=lambda sent=sent: ItemIndex(sent.value, window))
        if made is None:
            made = fresh.select(*keep, *[F.col(fresh_name + f.name).alias(f.name) for f in HITS])
            continue
        made = materialize(fresh, "decontaminate")
        both = {"n_words": F.col("n_words"), "items": F.array_sort(F.array_union("items", fresh_name + "items")),
                "hits": F.array_sort(F.array_union("hits", fresh_name + "hits"))}
        made = made.select(*keep, *[both.get(c, F.size(both["hits"]).cast("long")).alias(c) for c in ("n_words", "n_hit", "items", "hits")])
    return made


def contaminated() -> "F.Column":
    """At least one word hit, and at least one word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
