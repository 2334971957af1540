"""Suffix-array dedup: bytes of long strings that start more than once in the corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same text or
another; strings don't cross texts and are judged on the input.

Prefix-free parsing.  A rolling hash (Karp and Rabin's, over ``GRAM`` bytes) triggers where phrases begin.
A window (a string of ``LENGTH`` bytes) belongs to the first trigger among its first ``REACH`` bytes; where
there is none, to the first of a denser set of triggers, and else to its own first byte.  This anchor
depends on the window's bytes alone, so equal windows have equal anchors at equal places.  From its
anchor on a window has at least ``LENGTH - REACH`` bytes, its phrase.

1. Dictionary.  Every block of texts gives the names (hashes) of its phrases, each once.  Phrases that
   occur once in the corpus end here: no window with such a phrase can be repeated.  A name shared by
   chance only means a needless look in the next step.
2. Parse.  Consecutive windows with one anchor are a run: at most ``HALF`` windows, with a key of
   ``LENGTH - HALF`` bytes that all of them hold.  Of runs with repeated phrases the names of run and key
   are gathered by key.  A run that occurs again, as copies do, is repeated as a whole.  A key with one run
   alone ends here.  For the others one block is asked for the bytes of each distinct run.
   Hot phrases, which many distinct runs hold (as around a passage that a third of all texts quote, each between
   other words), would bring all these runs to one bucket.  Their windows are settled one by one: a block
   gives each window's name once, to the bucket of that name; of windows whose name occurs again it then
   sends the bytes, each once, and those are compared.  A sample of the runs' names tells which phrases
   are hot, at most ``SAMPLED`` a phrase and block; both ways give the same windows.
3. Corpus order.  A bucket of keys holds all distinct suffixes of the corpus that begin with its keys, left by up
   to ``HALF`` bytes.  It sorts what follows the anchors (the parse's suffix order) with the longest common
   prefixes of neighbours, then takes in the bytes before the anchors one by one (the dictionary's
   suffixes): rows with the same bytes before, in the order of what follows, are neighbours in the
   corpus order.  A window is repeated if and only if a neighbour shares ``LENGTH`` bytes with it.  This
   compares real bytes, no hashes.

Two runs count as equal if their keys' names and their own names are, two 64-bit hashes of which one covers
all bytes; only runs with one key are ever compared so.  A block is told of its repeated windows by name.

So the one suffix array of a whole corpus becomes sorted pieces of it, one a bucket, cut to the depth that
matters.  A passage that a third of all texts hold is one name a block and one row of bytes, so it doesn't
weigh on its bucket; keys near a varied place are many.

Texts are written once, with their blocks, and read by each step; blocks take what they need of the
bucket's answers from a table in the shared folder, one folder a block, so texts are never shuffled.

Defined cases: null text: empty.  Rows with equal ids or texts are all kept, and repeat one another.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.rows import SpanHashes, joined, slices
from turnstile.llm.token_files import _file_system
from turnstile.session import materialize, scratch_path

LENGTH = 200
GRAM, REACH, HALF = 16, 100, 50
#: One byte in so many begins a phrase, and one in so many of the denser triggers: powers of two.
EVERY, DENSE = 32, 8
#: Rows of a block: a power of two.
BLOCK_BITS = 13
#: Bytes of text for each bucket, beyond the session's number of shuffle partitions.
BUCKET_BYTES = 16 << 20
#: A phrase is hot if SAMPLED distinct runs of one in 2^SAMPLE_BITS hold it: about 4,096 in all.
SAMPLE_BITS, SAMPLED = 6, 64
#: Bytes that a task gathers from a block before it hands them on.
HELD_BYTES = 32 << 20


class Runs:
    """Runs of windows of many texts, in order: ``first`` window, number ``n`` of windows, ``anchor``, ``phrase``.

    ``origin`` is where the phrase begins.  In the farther half of a trigger's reach the anchor lies half a
    reach before it, so that an anchor is always less than half a reach after a window's begin.
    """

    def __init__(self, data: np.ndarray, text_at: np.ndarray, length: int):
        self.data, self.length = data, length
        self.half = half = length * HALF // LENGTH
        reach, gram = length * REACH // LENGTH, max(1, length * GRAM // LENGTH)
        self.first = self.n = self.anchor = self.origin = np.zeros(0, np.int64)
        self.phrase = np.zeros(0, np.uint64)
        self.hashes: list[SpanHashes] = []
        windows = np.maximum(np.diff(text_at) - length, 0)  # a byte that is no part of it ends each text
        some = windows > 0
        if not some.any():
            return
        live = np.zeros(len(data) + 1, np.int8)
        live[text_at[:-1][some]] += 1
        live[(text_at[:-1] + windows)[some]] -= 1
        at = np.flatnonzero(np.cumsum(live[:-1], dtype=np.int8))
        self.hashes = [SpanHashes(data, k) for k in (0, 1)]
        h = self.hashes[0].rolling(gram) >> np.uint64(40)
        anchor = at.copy()
        todo = np.arange(len(at))
        for every in (EVERY, DENSE):
            flag = h & np.uint64(every - 1) == 0
            marks = np.append(np.flatnonzero(flag), 1 << 60)
            own = at[todo]
            after = marks[np.cumsum(flag)[own] - flag[own]]  # as many marks lie before
            near = after - own < reach
            anchor[todo[near]] = after[near]
            todo = todo[~near]
        # a new run begins where the anchor changes, or its nearer half
        far = anchor - at >= half
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (far[1:] != far[:-1])
        begin = np.flatnonzero(new)
        self.first, self.n, self.origin = at[begin], np.diff(np.append(begin, len(at))), anchor[begin]
        self.anchor = self.origin - np.where(far[begin], half, 0)
        self.phrase = self.hashes[1].of(self.origin, self.origin + length - reach)

    def keys(self, which: np.ndarray) -> np.ndarray:
        """Names of what all windows of a run hold."""
        return self.hashes[1].of(self.anchor[which], self.anchor[which] + self.length - self.half)

    def names(self, which: np.ndarray) -> np.ndarray:
        """Names of whole runs: their bytes, and where the anchor is."""
        if not len(which):
            return np.zeros(0, np.uint64)
        h = self.hashes[0].of(self.first[which], self.first[which] + self.n[which] + self.length - 1)
        return h ^ ((self.anchor - self.first)[which].astype(np.uint64) * np.uint64(0x94D049BB133111EB))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and name of each window of some runs."""
        n = self.n[which]
        if not len(n):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        begin = np.repeat(self.first[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return begin, self.hashes[0].of(begin, begin + self.length)


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, the place of the first of each, and whether there are more."""
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(fresh)
    return ordered[begin], order[begin], np.diff(np.append(begin, len(ordered))) > 1


def _member(sorted_names: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The place of each name among sorted ones, or -1."""
    if not len(sorted_names):
        return np.full(len(names), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_names, names), len(sorted_names) - 1)
    return np.where(sorted_names[at] == names, at, -1)


def _by_block(batches, length: int):
    """(block, batch slice, runs) for each slice of rows (_block, ..., _text); no slice has two blocks."""
    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for part in slices(batch.slice(a, b - a), batch.num_columns - 1) if b > a else ():
                yield int(block[a]), part, Runs(*joined(part.column(batch.num_columns - 1)), length)


def _bucket(names: np.ndarray, n: int) -> np.ndarray:
    return (names >> np.uint64(33)).astype(np.int64) % n


def _blobs(block: int, bucket: np.ndarray, columns: list[np.ndarray], texts=None):
    """A row for each bucket: bucket, block, each column's bytes (of the bucket's entries, in order)."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(order) else np.zeros(0, int)
    ends = np.append(begin[1:], len(order))[:len(begin)]
    made = [[c[order[a:b]].tobytes() for a, b in zip(begin, ends, strict=True)] for c in columns]
    if texts is not None:
        made.append([b"".join(texts[i] for i in order[a:b]) for a, b in zip(begin, ends, strict=True)])
    return [pa.array(ordered[begin], pa.int32()), pa.array(np.full(len(begin), block), pa.int64()), *[pa.array(m, pa.binary()) for m in made]]


def _batch(arrays: list, names: list[str], every: list[str]) -> pa.RecordBatch:
    """A batch of all columns, those not given without entries."""
    given = dict(zip(names, arrays, strict=True))
    blank = pa.array([b""] * len(arrays[0]), pa.binary())
    return pa.RecordBatch.from_arrays([given.get(c, blank) for c in every], names=every)


class Answers:
    """What buckets answered to a block: binary columns of the rows in the block's folder, joined."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns
        self.block, self.found = None, None

    def of(self, block: int) -> list[np.ndarray]:
        if block != self.block:
            import pyarrow.parquet as pq
            from pyarrow import fs

            system, path = _file_system(f"{self.path}/block={block}")
            held: dict[str, list[bytes]] = {c: [] for c in self.columns}
            files = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            for f in sorted(x.path for x in files if x.base_name.endswith(".parquet")):
                table = pq.read_table(system.open_input_file(f), columns=self.columns)
                for c in self.columns:
                    held[c] += table.column(c).to_pylist()
            arrays = [np.frombuffer(b"".join(held[c]), np.uint64) for c in self.columns]
            order = np.argsort(arrays[0], kind="stable")
            self.block, self.found = block, [a[order] for a in arrays]
        return self.found


def _write_answers(rows: DataFrame, spark, name: str) -> str:
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    rows.repartition("block").write.partitionBy("block").parquet(path)
    return path


_PHRASES = ["bucket", "block", "names", "more", "held", "runs"]


def _phrases(batches, length: int, n: int, sample: tuple[int, int]):
    """Distinct phrase names of each block, by bucket, with flags of those it has more than once; and of a
    sample (1 in 2^bits) of the distinct runs that hold each phrase the first few names."""
    bits, most = sample
    held: list[list] = [[], [], []]
    block, size = None, 0

    def flush():
        names, _, more = _distinct(np.concatenate(held[0]))
        yield _batch(_blobs(block, _bucket(names, n), [names, more]), _PHRASES[:4], _PHRASES)
        phrase, run = _first_runs(np.concatenate(held[1]), np.concatenate(held[2]), most)
        yield _batch(_blobs(block, _bucket(phrase, n), [phrase, run]), [*_PHRASES[:2], *_PHRASES[4:]], _PHRASES)

    for at, _, runs in _by_block(batches, length):
        if held[0] and (at != block or size > HELD_BYTES):
            yield from flush()
            held, size = [[], [], []], 0
        block = at
        if len(runs.phrase):
            kept = np.ones(len(runs.phrase), bool)
            kept[1:] = runs.origin[1:] != runs.origin[:-1]  # both halves have one phrase
            held[0].append(runs.phrase[kept])
            names = runs.names(np.arange(len(runs.first)))
            some = names & np.uint64((1 << bits) - 1) == 0
            held[1].append(runs.phrase[some])
            held[2].append(names[some])
            size += held[0][-1].nbytes + 2 * held[1][-1].nbytes
    if held[0]:
        yield from flush()


def _first_runs(phrase: np.ndarray, run: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order, ``most`` a phrase."""
    order = np.lexsort((run, phrase))
    phrase, run = phrase[order], run[order]
    fresh = np.ones(len(phrase), bool)
    fresh[1:] = (phrase[1:] != phrase[:-1]) | (run[1:] != run[:-1])
    phrase, run = phrase[fresh], run[fresh]
    near = np.arange(len(phrase)) - np.searchsorted(phrase, phrase) < most
    return phrase[near], run[near]


def _joined_column(table: pa.Table, column: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of blobs, and which row each is from."""
    parts = [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]
    return np.concatenate([np.zeros(0, kind), *parts]), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _again(names: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Flags of names that occur twice or more in all."""
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    again = more.copy()
    again[order[1:][same]] = again[order[:-1][same]] = True
    return again


def _repeated_phrases(table: pa.Table, most: int) -> pa.Table:
    """For each block its names that occur twice or more in all, and which of them are hot."""
    names, row = _joined_column(table, "names", np.uint64)
    more, _ = _joined_column(table, "more", bool)
    phrase, _ = _joined_column(table, "held", np.uint64)
    run, _ = _joined_column(table, "runs", np.uint64)
    several, count = np.unique(_first_runs(phrase, run, most)[0], return_counts=True)
    hot = _member(several[count >= most], names) >= 0
    return _answer(table, row, [names, hot.astype(np.uint64)], _again(names, more), ["names", "hot"])


def _answer(table: pa.Table, row, columns, kept, names, every=None) -> pa.Table:
    which = np.flatnonzero(kept)
    begin = np.searchsorted(row[which], np.arange(table.num_rows + 1))
    some = np.flatnonzero(begin[1:] > begin[:-1])
    made = [pa.array([c[which[begin[k]:begin[k + 1]]].tobytes() for k in some.tolist()], pa.binary()) for c in columns]
    block = pa.array(table.column("block").to_numpy()[some], pa.int64())
    return pa.Table.from_batches([_batch([block, *made], ["block", *names], ["block", *(every or names)])])


def _repeated_runs(runs: Runs, answer: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Runs with repeated phrases: those whose phrases are not hot, and the hot ones."""
    known, hot = answer
    place = _member(known, runs.phrase)
    which = np.flatnonzero(place >= 0)
    warm = hot[place[which]] > 0
    return which[~warm], which[warm]


_PARSE = ["bucket", "block", "names", "keys", "more", "windows", "often"]


def _parse(batches, length: int, n: int, phrases: str):
    """Names and keys of the distinct runs of each block whose phrases are repeated, by bucket of their keys;
    for hot phrases names of the distinct windows, by bucket of these."""
    answers = Answers(phrases, ["names", "hot"])
    held: list[list] = [[], [], []]
    block, size = None, 0

    def flush():
        names, first, more = _distinct(np.concatenate(held[0]))
        keys = np.concatenate(held[1])[first]
        yield _batch(_blobs(block, _bucket(keys, n), [names, keys, more]), _PARSE[:5], _PARSE)
        names, _, more = _distinct(np.concatenate(held[2]))
        yield _batch(_blobs(block, _bucket(names, n), [names, more]), [*_PARSE[:2], *_PARSE[5:]], _PARSE)

    for at, _, runs in _by_block(batches, length):
        if held[0] and (at != block or size > HELD_BYTES):
            yield from flush()
            held, size = [[], [], []], 0
        block = at
        which, hot = _repeated_runs(runs, answers.of(block))
        if len(which) or len(hot):
            held[0].append(runs.names(which))
            held[1].append(runs.keys(which) if len(which) else np.zeros(0, np.uint64))
            held[2].append(runs.windows(hot)[1])
            size += 16 * len(which) + 8 * len(held[2][-1])
    if held[0]:
        yield from flush()


#: What a block is told of a run: it occurs again as a whole; its bytes are asked for; both.
WHOLE, ASKED = 1, 2


def _equal_runs(table: pa.Table) -> pa.Table:
    """For each block what it should know of its runs, and its windows of hot phrases whose names occur again."""
    every = ["names", "told", "windows"]
    windows, own = _joined_column(table, "windows", np.uint64)
    often, _ = _joined_column(table, "often", bool)
    hot = _answer(table, own, [windows], _again(windows, often), ["windows"], every)
    names, row = _joined_column(table, "names", np.uint64)
    keys, _ = _joined_column(table, "keys", np.uint64)
    more, _ = _joined_column(table, "more", bool)
    order = np.lexsort((row, names, keys))
    k, r = keys[order], names[order]
    new_key = np.ones(len(order), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_run = new_key.copy()
    new_run[1:] |= r[1:] != r[:-1]
    run_at = np.flatnonzero(new_run)
    key_of, run_of = np.cumsum(new_key) - 1, np.cumsum(new_run) - 1
    several = np.add.reduceat(1 + more[order], run_at) > 1 if len(run_at) else np.zeros(0, bool)
    runs_of_key = np.bincount(key_of[run_at], minlength=1)
    told = np.where(several[run_of], WHOLE, 0)
    told[run_at] += np.where(runs_of_key[key_of[run_at]] > 1, ASKED, 0)  # the first block that has it
    out = np.zeros(len(order), np.uint64)
    out[order] = told
    return pa.concat_tables([hot, _answer(table, row, [names, out], out > 0, ["names", "told"], every)])


def _distinct_windows(data: np.ndarray, begin: np.ndarray, names: np.ndarray, length: int) -> dict[tuple[int, bytes], bool]:
    """Names and bytes of the distinct windows, and whether there are more of one."""
    own, first, more = _distinct(names)
    like = first[np.searchsorted(own, names)]
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    other = np.concatenate([np.zeros(0, np.int64)] + [a + np.flatnonzero((view[begin[a:a + 8192]] != view[begin[like[a:a + 8192]]]).any(axis=1))
                                                      for a in range(0, len(begin), 8192)])
    more &= np.bincount(np.searchsorted(own, np.delete(names, other)), minlength=len(own)) > 1
    found = {(x, view[at].tobytes()): m for x, at, m in zip(own.tolist(), begin[first].tolist(), more.tolist(), strict=True)}
    for i in other.tolist():  # another window of that name
        x = int(names[i]), view[begin[i]].tobytes()
        found[x] = x in found
    return found


_BYTES = ["bucket", "block", "names", "lead", "windows", "more", "texts", "hot", "often", "strings"]


def _bytes_of_runs(batches, length: int, n: int, phrases: str, told: str):
    """The bytes of the runs that a block is asked for, by bucket of their keys; and of the windows, by bucket of their names."""
    answers, warm, again = Answers(told, ["names", "told"]), Answers(phrases, ["names", "hot"]), Answers(told, ["windows"])
    held: list[list] = [[], [], [], [], [], []]
    strings: dict[tuple[int, bytes], bool] = {}
    block, size = None, 0

    def flush():
        if strings:
            names = np.array([x for x, _ in strings], np.uint64)
            yield _batch(_blobs(block, _bucket(names, n), [names, np.array(list(strings.values()))], [x for _, x in strings]), [*_BYTES[:2], *_BYTES[7:]], _BYTES)
        if not held[0]:
            return
        names, first, _ = _distinct(np.concatenate(held[0]))
        keys, lead, windows, more = (np.concatenate(x)[first] for x in held[1:5])
        texts = [held[5][i] for i in first.tolist()]
        yield _batch(_blobs(block, _bucket(keys, n), [names, lead, windows, more], texts), _BYTES[:7], _BYTES)

    sent = np.zeros(0, np.uint64)
    for at, _, runs in _by_block(batches, length):
        if (held[0] or strings) and (at != block or size > HELD_BYTES):
            yield from flush()
            held, strings, size = [[], [], [], [], [], []], {}, 0
        if at != block:
            known, what = answers.of(at)
            sent = np.zeros(len(known), bool)
        block = at
        names = runs.names(np.arange(len(runs.first)))
        place = _member(known, names)
        which = np.flatnonzero(place >= 0)
        place = place[which]
        asked = (what[place] >= ASKED) & ~sent[place]
        which, place = which[asked], place[asked]
        place, once = np.unique(place, return_index=True)
        which = which[once]
        if len(which):
            sent[place] = True
            whole = runs.data.tobytes()
            first, m = runs.first[which], runs.n[which]
            held[0].append(names[which])
            held[1].append(runs.keys(which))
            held[2].append((runs.anchor[which] - first).astype(np.uint8))
            held[3].append(m.astype(np.uint8))
            held[4].append(what[place] & np.uint64(WHOLE) > 0)
            held[5] += [whole[a:b] for a, b in zip(first.tolist(), (first + m + length - 1).tolist(), strict=True)]
            size += int(m.sum()) + length * len(m)
        begin, names = runs.windows(_repeated_runs(runs, warm.of(at))[1])
        some = _member(again.of(at)[0], names) >= 0
        if some.any():
            for x, more in _distinct_windows(runs.data, begin[some], names[some], length).items():
                size += 0 if x in strings else length
                strings[x] = more or x in strings
    if held[0] or strings:
        yield from flush()


def repeated_windows(lead: np.ndarray, windows: np.ndarray, more: np.ndarray, text: np.ndarray, length: int, half: int) -> np.ndarray:
    """Bits of each row's windows that are repeated: bit k for the window that begins k bytes before the anchor.

    Row r has ``windows[r]`` windows, the first ``lead[r]`` bytes before its anchor; ``text`` has the rows'
    bytes one after the other; ``more`` flags rows that stand for several.
    """
    n = len(lead)
    if not n:
        return np.zeros(0, np.uint64)
    lead, windows = lead.astype(np.int64), windows.astype(np.int64)
    low = lead - windows + 1  # the last window begins so many bytes before the anchor
    size = windows + length - 1
    begin = np.cumsum(size) - size
    after = size - lead  # bytes from the anchor on
    whole = ((np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)) << low.astype(np.uint64)
    # the order of what follows the anchors; of two where one begins the other, the shorter is first
    right = np.lib.stride_tricks.sliding_window_view(np.concatenate((text, np.zeros(length, np.uint8))), length)[begin + lead]
    right[np.arange(length)[None, :] >= after[:, None]] = 0
    order = np.argsort(after, kind="stable")
    order = order[np.argsort(right[order].view(f"S{length}").ravel(), kind="stable")]
    right, lead, low, begin, after = right[order], lead[order], low[order], begin[order], after[order]
    differ = right[1:] != right[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    common = np.minimum(common, np.minimum(after[1:], after[:-1]))
    del right, differ
    # least[j][i]: the least common prefix of neighbours i - 1 and i, ..., over 2^j of them
    least = [np.concatenate(([0], common)).astype(np.int16)]
    for j in range(1, max(1, (n - 1).bit_length())):
        step = 1 << (j - 1)
        last = least[-1].copy()
        last[:-step] = np.minimum(last[:-step], least[-1][step:])
        least.append(last)
    table = np.array(least)
    kind = np.concatenate(([0], np.cumsum(common < length - half)))  # rows that share less share no window
    found = np.zeros(n, np.uint64)
    active = np.arange(n)
    for k in range(half):
        if k:  # take in the byte k before the anchor
            active = active[lead[active] >= k]
            byte = text[begin[active] + lead[active] - k]
            kind[active] = np.unique(kind[active] * 256 + byte, return_inverse=True)[1]
        if not len(active):
            break
        here = active[low[active] <= k]
        here = here[np.argsort(kind[here], kind="stable")]  # by the bytes before, then by what follows
        a, b = here[:-1], here[1:]
        level = np.frexp(np.maximum(b - a, 1).astype(float))[1] - 1
        shared = np.minimum(table[level, np.minimum(a + 1, n - 1)], table[level, np.maximum(b - (1 << level) + 1, 0)])
        same = (kind[a] == kind[b]) & (shared >= length - k)
        bit = np.uint64(1 << k)
        found[a[same]] |= bit
        found[b[same]] |= bit
    bits = np.zeros(n, np.uint64)
    bits[order] = found
    return np.where(more, whole, bits)


def _resolve(table: pa.Table, length: int) -> pa.Table:
    """For each block the names and bits of its runs with repeated windows, and the names of repeated windows of hot phrases."""
    every = ["names", "bits", "windows"]
    hot, own = _joined_column(table, "hot", np.uint64)
    often, _ = _joined_column(table, "often", bool)
    strings, _ = _joined_column(table, "strings", np.uint8)
    strings = np.column_stack((strings.reshape(-1, length), np.ones(len(hot), np.uint8)))  # no zero at the end, which would not count
    order = np.argsort(strings.view(f"S{length + 1}").ravel(), kind="stable")
    same = (strings[order[1:]] == strings[order[:-1]]).all(axis=1)
    often[order[1:][same]] = often[order[:-1][same]] = True
    settled = _answer(table, own, [hot], often, ["windows"], every)
    names, row = _joined_column(table, "names", np.uint64)
    lead, _ = _joined_column(table, "lead", np.uint8)
    windows, _ = _joined_column(table, "windows", np.uint8)
    more, _ = _joined_column(table, "more", bool)
    text, _ = _joined_column(table, "texts", np.uint8)
    bits = repeated_windows(lead, windows, more, text, length, length * HALF // LENGTH)
    return pa.concat_tables([settled, _answer(table, row, [names, bits], (bits > 0) & ~more, ["names", "bits"], every)])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _apply(batches, length: int, phrases: str, told: str, found: str, schema_names: list[str]):
    """The rows with their spans and the bytes that stay."""
    whole, partly = Answers(told, ["names", "told"]), Answers(found, ["names", "bits"])
    warm, settled = Answers(phrases, ["names", "hot"]), Answers(found, ["windows"])
    for block, part, runs in _by_block(batches, length):
        texts = part.column(part.num_columns - 1)
        data, text_at = joined(texts)
        cover = np.zeros(len(data) + 1, np.int32)
        names = runs.names(np.arange(len(runs.first)))
        known, what = whole.of(block)
        place = _member(known, names)
        full = (place >= 0) & (what[place] & np.uint64(WHOLE) > 0) if len(known) else np.zeros(len(names), bool)
        np.add.at(cover, runs.first[full], 1)
        np.add.at(cover, runs.first[full] + runs.n[full] + length - 1, -1)
        known, bits = partly.of(block)
        place = _member(known, names)
        own, anchor = bits[place[place >= 0]], runs.anchor[place >= 0]
        for k in range(runs.half if len(own) else 0):
            begin = anchor[(own >> np.uint64(k)) & np.uint64(1) > 0] - k
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + length, -1)
        begin, names = runs.windows(_repeated_runs(runs, warm.of(block))[1])
        begin = begin[_member(settled.of(block)[0], names) >= 0]
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + length, -1)
        gone = np.cumsum(cover[:-1]) > 0  # no byte that ends a text is covered
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        start, end = edge[::2], edge[1::2]
        of = np.searchsorted(text_at, start, side="right") - 1
        spans = pa.StructArray.from_arrays([pa.array(start - text_at[of]), pa.array(end - text_at[of])], names=["start", "end"])
        at = np.searchsorted(of, np.arange(part.num_rows + 1))
        kept = data[~gone].tobytes()
        stays = np.concatenate(([0], np.cumsum(~gone)))[text_at]
        made = [pa.array(np.diff(text_at) - 1, pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans).cast(_SPANS),
                pa.array([kept[a:b - 1] for a, b in zip(stays[:-1].tolist(), stays[1:].tolist(), strict=True)], pa.binary())]
        yield pa.RecordBatch.from_arrays([part.column(i) for i in range(1, part.num_columns - 1)] + made, names=schema_names)


def remove_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text by default) plus n_bytes, spans (removed bytes: array of start,
    end) and kept (the bytes that stay: binary, as a cut may fall within a character).

    Columns with these three names are replaced.  ``length``: 20 to 250 bytes.
    """
    spark = docs.sparkSession
    fields = [T.StructField("n_bytes", T.LongType()),
              T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
              T.StructField("kept", T.BinaryType())]
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    keep = [c for c in keep if c.lower() not in {f.name for f in fields}]
    inner = [f"_c{i}" for i in range(len(keep))]
    rows = docs.select(F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("_block"),
                       *[F.col(c).alias(x) for c, x in zip(keep, inner, strict=True)], F.col(text_col).cast("string").alias("_text"))
    rows = materialize(rows, "repeats-texts")
    texts = rows.select("_block", "_text")
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))

    def by_bucket(made: DataFrame, fn, schema: str) -> DataFrame:
        return made.repartition(n, "bucket").groupBy("bucket").applyInArrow(fn, schema)

    def columns(names: list[str]) -> str:
        return ", ".join(f"{c} {dict(bucket='int', block='long').get(c, 'binary')}" for c in names)

    sample = SAMPLE_BITS, SAMPLED
    made = texts.mapInArrow(lambda batches: _phrases(batches, length, n, sample), columns(_PHRASES))
    phrases = _write_answers(by_bucket(made, lambda table: _repeated_phrases(table, sample[1]), columns(["block", "names", "hot"])), spark, "repeats-phrases")
    made = texts.mapInArrow(lambda batches: _parse(batches, length, n, phrases), columns(_PARSE))
    told = _write_answers(by_bucket(made, _equal_runs, columns(["block", "names", "told", "windows"])), spark, "repeats-told")
    made = texts.mapInArrow(lambda batches: _bytes_of_runs(batches, length, n, phrases, told), columns(_BYTES))
    found = _write_answers(by_bucket(made, lambda table: _resolve(table, length), columns(["block", "names", "bits", "windows"])), spark, "repeats-runs")
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep] + fields)
    return rows.mapInArrow(lambda batches: _apply(batches, length, phrases, told, found, schema.names), schema)
