"""URL filters: glob rules simulated all at once by a bit-parallel wildcard automaton.

A rule has a verdict and globs over the canonical URL, which is its host (A-Z in lower case) followed by its
path.  In a glob ``*`` stands for any run of characters without ``/``, ``**`` for any run, ``?`` for one character
but ``/``, and ``\\`` makes the next character an ordinary one.  A glob must fit the whole canonical URL.

All globs are packed into one row of bits: a glob of m symbols has m + 1 states, state j says "the first j symbols
fit what was read".  For every byte there are two masks over all states, several machine words wide: ``step`` (states that
this byte leads into) and ``stay`` (states in front of a wildcard, which keep this byte).  Reading a byte is Shift-And:

    D = ((D << 1) & step[byte]) | (D & stay[byte])

so the work a byte is a few operations on the words, whatever the number of globs, and nothing is ever backtracked.
Many URLs advance together (numpy rows); the few that are much longer than all others go on one by one, as
Python integers with the same masks.  Rules are packed in blocks of ``BLOCK_WORDS`` words, which bounds the masks and states held
at once; URLs are never shuffled.

Rules come in tiers.  The first tier with a fitting rule decides; within it the rule with the longest name, ties to the
one listed first.

Defined cases: a null URL, or one without ``://``, has an empty host and path (and is judged by the globs that
fit the empty text).  Equal rows are all kept.  Columns of the input named as a result are replaced, other
columns are kept.  No rules: the default verdict for every row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.rows import joined, map_texts

#: Machine words of states simulated at once.
BLOCK_WORDS = 64
#: URLs that advance together.
LANES = 16384
#: From so few URLs left on, each goes on alone.
FEW = 8

RESULT = [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("tier", T.IntegerType()),
          T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]


class Rule(NamedTuple):
    """``name`` is what results say of it, and its length is its weight."""

    name: str
    verdict: str
    globs: tuple[str, ...]


def escaped(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains, where the URL's path starts with ``path``."""
    rest = escaped(host) + escaped(path) + "**"
    return Rule(host + path, verdict, (rest, "*." + rest))


def host_words(word: str, verdict: str) -> Rule:
    """Fits every host that holds ``word``, whatever the path."""
    inside = f"*{escaped(word)}*"
    return Rule(inside, verdict, (inside, inside + "/**"))


def _symbols(glob: str) -> tuple[list[int], list[int]]:
    """Symbols (bytes, or -1 for ``?``) and, for each state, the wildcard in front of the next one (0, 1: ``*``, 2: ``**``)."""
    symbols: list[int] = []
    stars = [0]
    at = 0
    while at < len(glob):
        c = glob[at]
        at += 1
        if c == "*":
            wide = glob[at:at + 1] == "*"
            at += wide
            stars[-1] = max(stars[-1], 2 if wide else 1)
            continue
        if c == "\\" and at < len(glob):
            c = glob[at]
            at += 1
            made = list(c.encode())
        else:
            made = [-1] if c == "?" else list(c.encode())
        symbols += made
        stars += [0] * len(made)
    return symbols, stars


class GlobAutomaton:
    """A block of globs as masks; ``owner`` tells which rule each glob belongs to."""

    def __init__(self, globs: Sequence[tuple[str, int]]):
        parsed = [_symbols(g) for g, _ in globs]
        self.owner = [rule for _, rule in globs]
        self.width = -(-sum(len(s) + 1 for s, _ in parsed) // 64)
        step = np.zeros((256, 64 * self.width), bool)
        stay = np.zeros((256, 64 * self.width), bool)
        start = np.zeros(64 * self.width, bool)
        follow = np.zeros(256, bool)
        follow[0x80:0xC0] = True  # the later bytes of a character
        one = ~follow
        one[ord("/")] = False
        segment = np.ones(256, bool)
        segment[ord("/")] = False
        at, self.accept = 0, []
        for symbols, stars in parsed:
            start[at] = True
            for j, star in enumerate(stars):
                if star:
                    stay[:, at + j] |= segment if star == 1 else True
            for j, symbol in enumerate(symbols, 1):
                if symbol >= 0:
                    step[symbol, at + j] = True
                else:
                    step[:, at + j] = one
                    stay[:, at + j] |= follow
            at += len(symbols) + 1
            self.accept.append(at - 1)
        self.start = np.packbits(start, bitorder="little").view("<u8")
        self.step, self.stay = (np.packbits(m, axis=1, bitorder="little").view("<u8") for m in (step, stay))
        self._numbers: tuple[list[int], list[int]] | None = None

    def _alone(self, state: np.ndarray, text: bytes) -> np.ndarray:
        if self._numbers is None:
            self._numbers = tuple([int.from_bytes(row.tobytes(), "little") for row in m] for m in (self.step, self.stay))
        step, stay = self._numbers
        d = int.from_bytes(state.tobytes(), "little")
        for c in text:
            d = ((d << 1) & step[c]) | (d & stay[c])
        return np.frombuffer(d.to_bytes(8 * self.width, "little"), "<u8")

    def states(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The final states of the texts, longest first (``size`` must fall)."""
        d = np.tile(self.start, (len(begin), 1))
        done, rising = 0, -size
        while (n := int(np.searchsorted(rising, -done, "left"))) > FEW:
            c = data[begin[:n] + done]
            now = d[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.step[c]
            now &= self.stay[c]
            now |= moved
            done += 1
        for i in range(n):
            d[i] = self._alone(d[i], data[begin[i] + done:begin[i] + size[i]].tobytes())
        return d


class RuleSet:
    """Tiers of rules, packed; the rule that decides each text."""

    def __init__(self, tiers: Sequence[Sequence[Rule]]):
        self.rules = [(k, r) for k, tier in enumerate(tiers) for r in sorted(tier, key=lambda r: -len(r.name))]
        self.blocks = [GlobAutomaton(b) for b in _blocks([(g, i) for i, (_, r) in enumerate(self.rules) for g in r.globs])]

    def first(self, texts: pa.Array) -> np.ndarray:
        """For each text the number of the first rule that fits, or the number of rules."""
        data, at = joined(texts, "")
        size = np.diff(at)
        best = np.full(len(size), len(self.rules), np.int64)
        order = np.argsort(-size, kind="stable")
        for k in range(0, len(order), LANES):
            rows = order[k:k + LANES]
            for block in self.blocks:
                d = block.states(data, at[rows], size[rows])
                for rule, bit in zip(block.owner, block.accept, strict=True):
                    fits = rows[(d[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1) > 0]
                    best[fits] = np.minimum(best[fits], rule)
        return best


def _blocks(globs: list[tuple[str, int]]) -> Iterator[list[tuple[str, int]]]:
    """Globs in blocks of about ``BLOCK_WORDS`` words of states; one glob at least."""
    block, bits = [], 0
    for glob in globs:
        n = len(_symbols(glob[0])[0]) + 1
        if block and bits + n > 64 * BLOCK_WORDS:
            yield block
            block, bits = [], 0
        block.append(glob)
        bits += n
    if block:
        yield block


#: What comes before the host, the host, the path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    found = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(found, _PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(found, _PARTS, 2)


def judge_urls(df: DataFrame, tiers: Sequence[Sequence[Rule]], default: str = "allow", url_col: str = "url",
               keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all, unless given) plus host, path, tier and rule that decided (null: none), and verdict."""
    names = {f.name for f in RESULT}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    host, path = host_and_path(df[url_col])
    key = "_key_" + "_".join(keep)
    rows = df.select(*[df[c] for c in keep], host.alias("host"), path.alias("path")).withColumn(key, F.concat("host", "path"))

    def judge(texts, rules):
        first = rules.first(texts)
        table = [*[(k, r.name, r.verdict) for k, r in rules.rules], (None, None, default)]
        return [pa.array(list(c), kind).take(pa.array(first))
                for c, kind in zip(zip(*table, strict=True), (pa.int32(), pa.string(), pa.string()), strict=True)]

    return map_texts(rows, RESULT[2:], judge, keep=[*keep, "host", "path"], text_col=key, setup=lambda: RuleSet(tiers))
