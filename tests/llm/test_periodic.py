"""Periodic runs against brute force, and the transform against plain sums."""

import hashlib
import random
import re
import zlib

import numpy as np
from llm_fixtures import DOCS, empty, table, texts

from turnstile.llm import periodic


def brute_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            if w[at] != w[at + q]:
                at += 1
                continue
            start = at
            while at + q < n and w[at] == w[at + q]:
                at += 1
            if at + q - start >= max(6, 4 * q):
                out.setdefault((start, at + q), q)  # the smallest period comes first
    return sorted((a, b - a, q) for (a, b), q in out.items())


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periodic_texts(seed, count):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        w = []
        for _ in range(rng.randint(1, 7)):
            letters = rng.choice(["ab", "abc", "abcdefghij"])
            piece = [rng.choice(letters) for _ in range(rng.randint(1, rng.choice([3, 9, 60])))]
            if rng.random() < 0.3:
                piece = piece * rng.randint(2, 6)  # runs within runs
            n = rng.randint(1, 9) * len(piece) + rng.randint(0, len(piece))
            w += (piece * 10)[:n]
        out.append(" ".join(w))
    return out


def test_transform():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, periodic.PRIME, (5, size)), rng.integers(0, periodic.PRIME, (5, 2 * size))
        windows[2, size // 2:size // 2 + size] = blocks[2]
        got = periodic.mismatch_sums(blocks, windows)
        want = [[sum((int(b[i]) - int(t[d + i])) ** 2 for i in range(size)) % periodic.PRIME for d in range(size)] for b, t in zip(blocks, windows)]
        assert got.tolist() == want and got[2, size // 2] == 0
        assert (periodic.back_transform(periodic.transform(windows)) == windows).all()


def test_runs_of_many_texts():
    for seed in range(30):
        some = [split(t) for t in periodic_texts(seed, 40)]
        code = {w: i for i, w in enumerate(sorted({w for t in some for w in t}))}
        first = np.concatenate(([0], np.cumsum([len(t) for t in some])))
        runs = periodic.find_runs(np.array([code[w] for t in some for w in t], np.int64), first)
        want = [(a + s, a + s + n, q) for a, t in zip(first.tolist(), some) for s, n, q in brute_runs(t)]
        assert [tuple(r) for r in runs.tolist()] == sorted(want)


def test_long_repetitive_texts():
    for w in (["a"] * 30000, (["a"] * 3000 + ["b"]) * 9, ["a"] * 9000 + ["b"] + ["a"] * 9000, list("abcab") * 5000):
        code = np.array([ord(x) for x in w], np.int64)
        got = periodic.find_runs(code, np.array([0, len(w)]))
        want = {(s, s + n, q) for s, n, q in brute_runs(w[:400])} if len(set(w[:3000])) > 1 else None
        ends = {tuple(r) for r in got.tolist()}
        if want is None:
            same = [i for i, x in enumerate(w) if x != "a"]
            bounds = [-1, *same, len(w)]
            want = {(a + 1, b, 1) for a, b in zip(bounds, bounds[1:]) if b - a - 1 >= 6}
            if len(same) > 4:
                want.add((0, len(w), 3001))
            assert ends == want
        else:
            assert ends == {(0, len(w), 5)}


def test_operator(spark):
    some = texts(n=20) + periodic_texts(99, 60) + ["é é\té\né é\x0bé É", "x " * 5, "x " * 6]
    got = periodic.periodic_runs(table(spark, some, ("Runs", "other")))
    assert got.columns == [f.name for f in DOCS] + ["other", "n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == len(some) + 2
    for r in rows:
        w = split(r.text)
        runs = brute_runs(w)
        assert r.n_words == len(w) and [tuple(x) for x in r.runs] == runs and r.collapsed == brute_collapsed(w, runs)
    assert sum(len(r.runs) for r in rows) > 50
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_query(spark, tmp_path):
    from turnstile.llm.queries import op13_periodic_runs

    some = texts(n=60) + periodic_texts(5, 60)
    table(spark, some).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_periodic_runs(spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {(r.doc_id, r.collapsed_sha256): r for r in got.collect()}
    planted = 0
    for r in table(spark, some).collect():
        w = split(r.text)
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            planted += 1
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        made = rows[r.doc_id, hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()]
        assert made.n_runs == len(runs)
        assert made.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert (made.start, made.length, made.period) == (best or (None, None, None))
        assert made.exponent_milli == (1000 * best[1] // best[2] if best else None)
    assert planted > 5
