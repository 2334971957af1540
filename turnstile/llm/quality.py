"""Quality rules: text statistics, and a decision list learned from labelled ones.

Statistics are counted over every whole text.  Words are runs of bytes other than ASCII white space.

The decision list is learned by sequential covering, as RIPPER's rule growing does: a rule to reject
is a conjunction of thresholds on statistics, grown condition by condition by FOIL's gain on two thirds
of the labelled rows until it covers no good row there, then pruned back to the prefix that does
best on the last third; rows it covers leave, and the next rule is grown.  Rules that aren't precise
enough on the rows held back end the search.  The result is plain Spark: an ordered ``CASE WHEN``
expression of the statistics.

Learning uses ``MAX_LABELLED`` labelled rows at most (those with the smallest hashes of their ids), so
the driver holds that many rows of statistics; everything else covers all rows.

Defined cases: null text: no words.  Labels that are null, not 0/1 or contradictory for one id
are left out.  Without labels of both classes the list is empty and only the base rule rejects.
Input columns with the names of statistics are replaced.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.rows import Words, flags, map_texts, span_hashes

#: Labelled rows that learning uses at most.
MAX_LABELLED = 20_000
#: Cut points tried for each statistic.
CUTS = 64
#: A rule must be right on this share of the rows it covers among those held back, and cover so many.
LEAST_PRECISION, LEAST_COVER = 0.9, 3
MAX_CONDITIONS = 4

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r "

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct", "n_mark_words"]
FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS]
#: What rules test: one count over another. Length alone is left to the base rule.
FEATURES = {
    "chars_per_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"), "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"), "marks_per_char": ("n_marks", "word_chars"), "distinct_share": ("n_distinct", "n_words"),
    "mark_word_share": ("n_mark_words", "n_words"), "words_per_line": ("n_words", "n_lines"),
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(SYMBOLS)
_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(bytes(range(48, 58)))
_MARK = _table(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_CHAR = np.array([b & 0xC0 != 0x80 for b in range(256)])  # not a continuation byte
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _repeated(words: Words, h: np.ndarray, window: int) -> np.ndarray:
    """Flags of the words within windows that their own text has twice or more."""
    n = len(h)
    cover = np.zeros(n + 1, np.int64)
    if n >= window:
        text = np.repeat(np.arange(len(words.counts)), words.counts)
        at = np.flatnonzero(text[:n - window + 1] == text[window - 1:])
        key = text[at].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        for k in range(window):
            key = (key ^ h[at + k]) * _STEP
            key ^= key >> np.uint64(31)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        np.add.at(cover, at[again], 1)
        np.add.at(cover, at[again] + window, -1)
    return np.cumsum(cover)[:n] > 0


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    seen, n, again = set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
            again += 1
        elif line.strip(WHITE):
            n += 1
            seen.add(line)
    return n, again


def _statistics(texts: pa.Array, window: int = 5) -> list:
    words = Words(texts, flags(space_split=True), lower=False)
    counts, first = words.counts, words.first
    n = len(texts)
    white = words.data == 32
    at = words.text_at

    def by_text(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flag)))[at])

    def by_word(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flag)))[first])

    h = span_hashes(words.data, words.begin, words.end)
    marks = np.concatenate(([0], np.cumsum(_MARK[words.data])))
    mark_words = (marks[words.end] - marks[words.begin]) >= 2
    text = np.repeat(np.arange(n), counts)
    order = np.lexsort((h, text))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][fresh], minlength=n)
    lines = [_lines(x) if x else (0, 0) for x in texts.to_pylist()]
    made = {
        "n_words": counts, "word_chars": by_text(_CHAR[words.data] & ~white), "n_symbols": by_text(_SYMBOL[words.data]),
        "n_dup_lines": [b for _, b in lines], "n_repeat_words": by_word(_repeated(words, h, window)), "n_lines": [a for a, _ in lines],
        "n_upper": by_text(_UPPER[words.data]), "n_digits": by_text(_DIGIT[words.data]), "n_marks": by_text(_MARK[words.data]),
        "n_distinct": distinct, "n_mark_words": by_word(mark_words),
    }
    return [pa.array(made[c], pa.int64()) for c in COUNTS]


def text_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) plus the counts in ``COUNTS``."""
    return map_texts(docs, FIELDS, _statistics, keep=docs.columns if keep is None else keep, text_col=text_col)


@dataclasses.dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.cut if self.above else x[self.feature] < self.cut

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= F.lit(self.cut) if self.above else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut:g}"


Rule = tuple[Condition, ...]


def feature(name: str) -> Column:
    over, under = FEATURES[name]
    return F.when(F.col(under) > 0, F.col(over).cast("double") / F.col(under)).otherwise(F.lit(0.0))


def _covers(rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray, covered: np.ndarray) -> Condition | None:
    """The condition with the largest FOIL gain on the covered rows."""
    p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
    before = np.log2(p / (p + n))
    best, found = 1e-9, None
    for name, values in x.items():
        cuts = np.unique(np.quantile(values[covered], np.linspace(0, 1, CUTS + 1), method="nearest"))
        cuts = (cuts[1:] + cuts[:-1]) / 2
        if not len(cuts):
            continue
        side = np.searchsorted(cuts, values, side="right")  # so many cuts are <= the value
        for above in (True, False):
            # rows at or above cut k have side > k
            pos = np.bincount(side[covered & bad], minlength=len(cuts) + 1)
            neg = np.bincount(side[covered & ~bad], minlength=len(cuts) + 1)
            below_p, below_n = np.cumsum(pos)[:-1], np.cumsum(neg)[:-1]
            cp, cn = (p - below_p, n - below_n) if above else (below_p, below_n)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(cp > 0, cp * (np.log2(cp / (cp + cn)) - before), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = float(gain[k]), Condition(name, above, float(cuts[k]))
    return found


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray) -> list[Rule]:
    """Ordered rules that tell ``bad`` rows; ``held`` rows are kept back for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while True:
        grow, prune = left & ~held, left & held
        rule: list[Condition] = []
        covered = grow.copy()
        while (covered & bad).any() and (covered & ~bad).any() and len(rule) < MAX_CONDITIONS:
            c = _best_condition(x, bad, covered)
            if c is None:
                break
            rule.append(c)
            covered &= c.holds(x)
        if not rule:
            return rules
        worth = []
        for k in range(1, len(rule) + 1):
            on = prune & _covers(rule[:k], x, len(bad))
            p, n = int((on & bad).sum()), int((on & ~bad).sum())
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
        value, k, p, n = max(worth)
        if p + n < LEAST_COVER or p < LEAST_PRECISION * (p + n):
            return rules
        rules.append(tuple(rule[:-k]))
        left &= ~_covers(rules[-1], x, len(bad))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = MAX_LABELLED,
        id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """A decision list from the labelled documents (1: good, 0: to reject)."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
                    .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_low"), F.max(label_col).alias("_label"))
                    .where("_low = _label").select("_id", "_label")
                    .orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
                .join(F.broadcast(chosen), "_id")
                # many copies of one id count once
                .groupBy("_id", "_label").agg(F.max("_text").alias("_text")))
    made = text_statistics(rows, "_text", keep=["_id", "_label"])
    got = made.select("_id", F.col("_label").cast("int").alias("_label"), F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(3)).alias("_third"),
                      *[feature(f).alias(f"f_{f}") for f in FEATURES]).toPandas().sort_values("_id")
    bad = (got["_label"] == 0).to_numpy()
    if not bad.any() or bad.all():
        return []
    return learn_rules({f: got[f"f_{f}"].to_numpy(float) for f in FEATURES}, bad, (got["_third"] == 0).to_numpy())


def verdict(rules: list[Rule]) -> Column:
    """True unless a rule rejects; the rules in order, as one conditional expression."""
    out = None
    for rule in rules:
        held = rule[0].column()
        for c in rule[1:]:
            held &= c.column()
        out = F.when(held, F.lit(False)) if out is None else out.when(held, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    """Fewer than ten words, or over a fifth of them in repeated five-word windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", keep: list[str] | None = None, **fitting) -> DataFrame:
    """``keep`` columns plus counts, base_failed and kept."""
    rules = fit(docs, labels, text_col=text_col, **fitting)
    made = text_statistics(docs, text_col, keep)
    made = made.drop(*[c for c in made.columns if c.lower() in ("base_failed", "kept")])
    return made.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
