"""Collocations against a count of every phrase by brute force, and defined cases."""

import re
from collections import Counter

import pytest
from llm_fixtures import empty, table, texts

from turnstile.llm import collocations


def brute(rows, size, min_count, inside, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, size + 1):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = {}
    for (lang, w), a in cand.items():
        longer = [b for (g, v), b in cand.items() if g == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= inside * a for b in longer):
            continue
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, got in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(got)[:top]))


def some_rows():
    some = texts(n=120) + ["tick\ttock Tick tock. new york, new york! new york city " * 12, "É é É é É é;É é", "x\x0by\x0cz\rx y z x y z x y z"]
    return [(i, t, [None, "en", "und", "fr", ""][i % 5 if i < 40 else 1]) for i, t in enumerate(some + some[60:90])]


@pytest.mark.parametrize(("size", "min_count", "inside", "top", "bits"), [(4, 5, 80, 2000, 25), (4, 3, 50, 7, 7), (3, 2, 100, 40, 9), (2, 8, 80, 5, 25)])
def test_against_brute_force(spark, monkeypatch, size, min_count, inside, top, bits):
    monkeypatch.setattr(collocations, "MASK_BITS", bits)  # few bits: the mask fills up, and no result changes
    rows = some_rows()
    df = spark.createDataFrame([(i, t, g, "mine") for i, t, g in rows], "doc_id long, text string, lang string, n string").repartition(5)
    got = collocations.collocations(df, size=size, min_count=min_count, inside_percent=inside, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute([(g, t) for _, t, g in rows], size, min_count, inside, top)
    assert len(want) > 5
    assert sorted(tuple(r) for r in got.collect()) == want


def test_windows_are_counted_once(spark):
    df = spark.createDataFrame([("en", "a b a b a b a b c")] * 3, "lang string, text string")
    made = collocations.lead_windows(df, 4, 3).groupBy("w1", "w2", "w3", "w4").sum("n").collect()
    assert {tuple(r)[:4]: r[4] for r in made} == {("a", "b", "a", "b"): 9, ("b", "a", "b", "a"): 6, ("b", "a", "b", "c"): 3, ("a", "b", "c", ""): 3, ("b", "c", "", ""): 3,
                                                  ("c", "", "", ""): 3}


def test_small_tables(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(table(spark, [None, "", "one two"])).count() == 0
    one = collocations.collocations(table(spark, ["a b."] * 29 + ["a b"], ("rank", "phrase"))).collect()
    assert [tuple(r) for r in one] == [("en", 1, "a b", 30, 30, 30, 60, 1000000)]
