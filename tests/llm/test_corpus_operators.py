"""Near-duplicates, repeated passages, token files, packing, HTML text and the pipeline against brute force."""

import hashlib
import random
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import empty, rows, table, texts
from turnstile.llm import encoding, html_text, packing, repeats, simhash, token_files
from turnstile.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# ---- SimHash

def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash(spark):
    some = texts()
    made = [(i, t) for i, t, *_ in rows(some)] + [(None, "one two"), (None, "alone here for once in a while")]
    df = spark.createDataFrame(made, "doc_id long, text string").withColumn("fp", F.lit("mine")).withColumn("root", F.lit(1))
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(made)
    fps = [brute_fingerprint(t) for _, t in made]
    group = brute_components(fps, 2)
    least = {}
    for (i, _), g in zip(made, group):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = Counter((i, fp, least[g]) for (i, _), fp, g in zip(made, fps, group))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    stays = simhash.keep_one(table(spark, some, ("fp", "root", "lead")))
    assert stays.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "root", "lead"]
    rows_ = rows(some)
    g2 = brute_components([brute_fingerprint(t) for _, t, *_ in rows_], 2)
    assert sorted(r.doc_id for r in stays.collect()) == sorted(min(r[0] for r, x in zip(rows_, g2) if x == g) for g in set(g2))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components_of_many_fingerprints(spark):
    rng = random.Random(6)
    fps = []
    for _ in range(60):  # chains, whose ends are far apart
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.append(x)
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    fps = list(dict.fromkeys(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    group = brute_components(fps, 2)
    mine = [found.get(x, x) for x in signed]
    assert len(set(zip(mine, group))) == len(set(mine)) == len(set(group))


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    test_components_of_many_fingerprints(spark)


# ---- repeated passages

def brute_cover(some, length):
    raw = [(t or "").encode() for t in some]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        out.append(cover)
    return out


@pytest.mark.parametrize("length,bits", [(200, 13), (20, 3)])
def test_repeats(spark, monkeypatch, length, bits):
    monkeypatch.setattr(repeats, "BLOCK_BITS", bits)
    some = texts() + ["ab" * 300, "ab" * 90, "\0" * 450, "é" * 130, "x\0y" * 40 + "\0", "x\0y" * 40]
    made = rows(some)
    df = spark.createDataFrame([(r[0], r[1], "mine") for r in made], "doc_id long, text string, kept string").repartition(3)
    got = repeats.remove_repeats(df, length).collect()
    want = Counter()
    for r, cover in zip(made, brute_cover([r[1] for r in made], length)):
        raw = (r[1] or "").encode()
        spans = tuple(m.span() for m in re.finditer(rb"\x01+", bytes(cover)))
        want[r[0], len(raw), spans, bytes(b for b, c in zip(raw, cover) if not c)] += 1
    assert Counter((r.doc_id, r.n_bytes, tuple(tuple(s) for s in r.spans), bytes(r.kept)) for r in got) == want
    assert repeats.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("length,bits,sampled", [(200, 13, 1), (200, 3, 4), (20, 3, 2)])
def test_repeats_of_hot_phrases(spark, monkeypatch, length, bits, sampled):
    monkeypatch.setattr(repeats, "SAMPLE_BITS", 0)
    monkeypatch.setattr(repeats, "SAMPLED", sampled)
    test_repeats(spark, monkeypatch, length, bits)


def test_repeats_gather_no_hot_key():
    """A passage between other words in many texts: no bucket gets the bytes of all runs around it."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    passage = word(600)
    some = [word(150) + passage + word(150) for _ in range(12000)]
    blocks = [pa.RecordBatch.from_arrays([pa.array([b] * 2000, pa.int64()), pa.array(some[b * 2000:(b + 1) * 2000])], names=["_block", "_text"]) for b in range(6)]
    sample = repeats.SAMPLE_BITS, repeats.SAMPLED
    told = repeats._repeated_phrases(pa.Table.from_batches(list(repeats._phrases(blocks, 200, 1, sample))), sample[1]).to_pylist()

    class Told:
        def __init__(self, path, columns):
            self.columns = columns

        def of(self, block):
            made = [np.frombuffer(b"".join(r[c] for r in told if r["block"] == block), np.uint64) for c in self.columns]
            return [m[np.argsort(made[0])] for m in made]

    with pytest.MonkeyPatch.context() as m:
        m.setattr(repeats, "Answers", Told)
        parsed = pa.Table.from_batches(list(repeats._parse(blocks, 200, 1, "")))
    keys = Counter(repeats._joined_column(parsed, "keys", np.uint64)[0].tolist())
    assert max(keys.values(), default=0) < 10000
    windows = Counter(repeats._joined_column(parsed, "windows", np.uint64)[0].tolist())
    assert len(windows) > 100000 and max(windows.values()) == 6  # each once a block


def test_repeats_random():
    """The order within a bucket, on random runs of a small alphabet, against direct comparison."""
    from turnstile.llm.rows import joined

    rng = random.Random(0)
    for _ in range(60):
        length = rng.choice([20, 40, 200])
        letters = rng.choice(["ab", "abc\0", "abcdefghij é"])
        parts = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 3 * length))) for _ in range(4)]
        some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 9))]
        runs = repeats.Runs(*joined(pa.array(some, pa.string())), length)
        raw, n = runs.data.tobytes(), len(runs.first)
        own = [raw[a:a + m + length - 1] for a, m in zip(runs.first, runs.n)]
        bits = repeats.repeated_windows(runs.anchor - runs.first, runs.n, np.zeros(n, bool), np.frombuffer(b"".join(own), np.uint8), length, runs.half)
        seen = Counter(x[k:k + length] for x in own for k in range(len(x) - length + 1))
        for x, a, f, m, b in zip(own, runs.anchor, runs.first, runs.n, bits):
            for k in range(m):
                assert (int(b) >> int(a - f - k) & 1) == (seen[x[k:k + length]] > 1)


# ---- encoding, token files, packing

ODD = ["a", "The", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "é", "日本", "'s", "'T", "1", "!!", "'", "ſ", "İ", "Σ",
       "<|endoftext|>", "</w>", "x" * 60, "😀", "\r\n", "ﬁ"]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_encoding_equals_the_library(name, kind):
    rng = random.Random(5)
    e = encoding.Encoder(tokenizer_file(name))
    assert e.kind == kind
    some = texts() + ["".join(rng.choice(ODD) + rng.choice(["", " ", "", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for i in range(0, len(some), 700):
        part = [t or "" for t in some[i:i + 700]]
        ids, at = e.encode(pa.array(some[i:i + 700], pa.string()))
        for k, want in enumerate(e.whole(part)):
            assert ids[at[k]:at[k + 1]].tolist() == want.tolist(), part[k]


def library_ids(name, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file(name))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, tmp_path):
    some = texts()
    df = table(spark, some, ("file", "start"))
    folder = f"file://{tmp_path}/tokens-{uuid.uuid4().hex}"
    index = token_files.write_token_files(df, folder, tokenizer_file("byte_bpe_50k.json"), seq_len=32, file_ids=3000)
    got = sorted(token_files.read_documents(index, folder).collect())
    want, start = [], 0
    for r in sorted(rows(some), key=lambda r: r[0]):
        ids = library_ids("byte_bpe_50k.json", r[1])
        want.append((r[0], start, len(ids), crc(ids)))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    # sequences and masks: each file's ids in order, then padding
    for name, n in index.groupBy("file").agg(F.sum("n_tokens")).collect():
        f = token_files.TokenFile(folder, name)
        whole = f.ids(0, n)
        for i in range(-(-n // 32)):
            ids, mask = f.sequence(i)
            real = min(32, n - 32 * i)
            assert ids[:real].tolist() == whole[32 * i:32 * i + real].tolist() and not ids[real:].any()
            assert mask.to_pylist() == [True] * real + [False] * (32 - real)
        f.close()
    small = token_files.write_token_files(df, folder + "-small", tokenizer_file("byte_bpe_50k.json"), seq_len=32, task_bytes=200)
    assert small.select("file").distinct().count() > index.select("file").distinct().count()
    assert sorted(token_files.read_documents(small, folder + "-small").collect()) == got
    none = token_files.write_token_files(empty(spark), folder + "-none", tokenizer_file("byte_bpe_50k.json"))
    assert token_files.read_documents(none, folder + "-none").count() == 0


def sum_of_squares_plain(sizes, capacity):
    open_, out, used = [], [], []
    for s in sizes:
        best = None
        for gap in [*sorted({g for g in (capacity - u for u in used) if g >= s and g < capacity and g > 0}), capacity]:
            count = Counter(capacity - u for u in used if u < capacity)
            if gap < capacity:
                count[gap] -= 1
            if gap > s:
                count[gap - s] += 1
            value = sum(v * v for v in count.values())
            if best is None or value < best[0]:
                best = (value, gap)
        gap = best[1]
        if gap == capacity:
            used.append(0)
            k = len(used) - 1
        else:
            k = max((i for i, u in enumerate(used) if capacity - u == gap), key=lambda i: order[i]) if (order := {i: n for n, i in enumerate(open_)}) else 0
        out.append(gap)
        used[k] += s
        open_ = [i for i in open_ if i != k] + [k]
    return out


def test_sum_of_squares_rule():
    """The gap that each piece is placed in, against the rule worked out in full."""
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 12) for _ in range(40)]
        where, offset = packing.sum_of_squares(np.array(sizes), 12)
        assert [12 - int(o) for o in offset] == sum_of_squares_plain(sizes, 12)


def test_packing(spark):
    some = texts()
    got = packing.pack_documents(table(spark, some, ("piece", "length", "_group")), tokenizer_file("word_bpe_49k.json"), capacity=128, group=40).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
    n_pieces = 0
    for (i, t, *_), times in Counter(r[:2] for r in rows(some)).items() and [((*k, 0), v) for k, v in Counter(r[:2] for r in rows(some)).items()]:
        ids = library_ids("word_bpe_49k.json", t)
        parts = [ids[a:a + 128] for a in range(0, len(ids), 128)]
        for p, part in enumerate(parts):
            own = by_doc[i, p]
            assert len(own) == times
            assert all((r.start, r.length, r.ids_crc32) == (128 * p, len(part), crc(part)) for r in own)
            n_pieces += times
    assert len(got) == n_pieces
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= 1.15 * sum(r.length for r in got) / 128 + 3
    assert packing.pack_documents(empty(spark), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_packing_with_ids(spark):
    made = packing.pack_documents(table(spark, texts()[:20]), tokenizer_file("word_bpe_49k.json"), with_ids=True).collect()
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in made)


# ---- HTML

ARTICLE = "The first paragraph of it is long enough to count, with commas and so on."
PAGES = {
    f"<html><body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>{ARTICLE}<p>Second\n\t one.</article><footer>f</footer>": f"T & U {ARTICLE} Second one.",
    f'<body class="has-sidebar"><div class="sidebar"><a href=a>a</a></div><div class=post><h1>T</h1><p>{ARTICLE}</p><p>More<br>here &lt;b&gt;</p>'
    f'<form><input><label>x</label></form></div><div id="comments"><p>{ARTICLE} {ARTICLE} by a reader</p></div>': f"T {ARTICLE} More here <b>",
    f"<article><p>{ARTICLE} a<b>b</b>c<script>var t='</p>'</script><style>p{{}}</style></p><div class='ad'>Buy</div></article><article class=comment>{ARTICLE}</article>":
        f"{ARTICLE} abc",
    f"<main><header><h1>Head</h1></header><ul><li>one<li>two</ul><p>{ARTICLE}</p><aside>no</aside><div style='display: none'>no</div></main>": f"Head one two {ARTICLE}",
    "": "", "plain": "plain", "<p></p>": "", "<script>x</script>": "", "<p>a<p>b": "a b", "&nbsp; x &#233;&eacute; ": "x éé",
}


def test_html(spark):
    pages = list(PAGES) + [None, "<div>" * 3000 + "deep", "<<<>>><a<b", "<p>" * 500 + "x"]
    df = spark.createDataFrame([(i, "u", h, "mine") for i, h in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract_text(df, keep=["page_id", "url", "text"]).collect()}
    assert len(got) == len(pages)
    for i, h in enumerate(PAGES):
        assert got[i] == PAGES[h], h[:80]
    assert got[len(PAGES)] == ""
    assert html_text.extract_text(df.limit(0)).count() == 0


def plain_densities(tree, gone):
    """Each node's sums by walking its whole subtree."""
    import math

    n = len(tree.tag)

    def below(i):
        out = []
        for k in range(n):
            j = k
            while j > i:
                j = tree.parent[j]
            if j == i and not gone[k]:
                out.append(k)
        return out

    def chars(nodes):
        return sum(len(" ".join(d.split())) for at, d in tree.texts if at in nodes)

    def linked(k):
        while k > 0 and tree.tag[k] != "a":
            k = tree.parent[k]
        return k > 0

    c0, lc0 = chars(set(below(0))), chars({k for k in below(0) if linked(k)})
    density = []
    for i in range(n):
        nodes = below(i) if not gone[i] else []
        c, lc = chars(set(nodes)), chars({k for k in nodes if linked(k)})
        t, lt = max(len(nodes) - 1, 1), max(sum(tree.tag[k] == "a" for k in nodes if k != i), 1)
        if not c:
            density.append(0.0)
            continue
        inner = math.log(c / max(c - lc, 1) * lc + (lc0 / c0 if c0 else 0) * c + math.e)
        ratio = max(c / max(lc, 1) * t / lt, 1.0)
        density.append(c / t * math.log(ratio) / (math.log(inner) if inner > 1 + 1e-12 else 1.0))
    return density, [sum(density[k] for k in range(1, n) if tree.parent[k] == i) for i in range(n)]


LINKS = "<div>" + "".join(f"<div><a href=x{i}>Some link {i}</a> | </div>" for i in range(30)) + "</div>"
UNNAMED = f"<html><body>{LINKS}<div><h1>T</h1><p>{ARTICLE} {ARTICLE}</p><p>{ARTICLE}</p><p>{ARTICLE}</p></div>{LINKS}</body></html>"


def test_densities_by_walking_every_subtree():
    import random

    from turnstile.llm.html_text import Tree, _never, densities

    rng = random.Random(2)
    pages = [*PAGES, UNNAMED[:900]]
    for _ in range(25):
        parts = [rng.choice(["<div>", "</div>", "<p>", "<a href=x>", "</a>", "<b>", "</b>", "<nav>", "</nav>", "<script>", "</script>", "some words ", ARTICLE]) for _ in range(40)]
        pages.append("".join(parts))
    for page in pages:
        tree = Tree()
        tree.feed(page)
        tree.close()
        gone = _never(tree)
        _, density, sums = densities(tree, gone)
        want, want_sums = plain_densities(tree, gone)
        assert all(abs(a - b) < 1e-9 for a, b in zip(density + sums, want + want_sums)), page[:80]


def test_density_decides_where_nothing_is_named(monkeypatch):
    """Link lists without any class, role or kind of their own go by their density alone."""
    want = f"T {ARTICLE} {ARTICLE} {ARTICLE} {ARTICLE}"
    assert html_text.main_text(UNNAMED) == want
    monkeypatch.setattr(html_text, "_marks", lambda tree, gone: [True] * len(tree.tag))
    assert html_text.main_text(UNNAMED) != want


# ---- pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from turnstile.llm import decontaminate, quality, secrets

    some = texts(n=120)
    some += [f"{t} extra words so that it is new {k}" for k, t in enumerate(some[20:40])]
    some += ['clean words with a token = "0123456789abcdef0123456789ab" and then some more words to be long enough']
    d = f"file://{tmp_path}"
    table(spark, some, ("n_words", "fp", "spans")).write.parquet(f"{d}/documents.parquet")
    bench = [(1, " ".join((some[30] or "").split()[:16])), (2, "nothing of the kind is here")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = [r for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    # stage by stage, by brute force
    from test_text_operators import brute_base, brute_items, brute_statistics

    def failed(t):
        n, *_, again = brute_statistics(t)
        return n < 10 or 100 * again > 20 * n

    left = [r for r in docs if not failed(r.text)]
    group = brute_components([brute_fingerprint(r.text) for r in left], 2)
    least = {g: min(r.doc_id for r, x in zip(left, group) if x == g) for g in set(group)}
    left = list({r.doc_id: r for r, g in zip(left, group) if least[g] == r.doc_id}.values())

    def dirty(t):
        n, hit, _ = brute_items(t, bench, 13)
        return hit and 20 * len(hit) >= n

    left = [r for r in left if not dirty(r.text)]
    final = {r.doc_id: secrets.masked(r.text, [(k, a, b) for k, a, b in brute_base(r.text)]) for r in left}
    want = {i: sum(1 for _ in range(0, len(library_ids("word_bpe_49k.json", t)), 2048)) for i, t in final.items()}
    step = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, step, d).write.parquet(f"{d}/{name}")
        step = spark.read.parquet(f"{d}/{name}")
        assert step.columns == spark.read.parquet(f"{d}/documents.parquet").columns
    assert {r.doc_id: (r.text, r.n_words) for r in step.collect()} == {i: (t, "mine") for i, t in final.items()}
    got = corpus_pipeline.run(spark, d).collect()
    assert Counter(r.doc_id for r in got) == Counter(want)
    assert {r.doc_id: r.ids_crc32 for r in got if want[r.doc_id] == 1} == {i: crc(library_ids("word_bpe_49k.json", t)) for i, t in final.items() if want[i] == 1}


def test_pipeline_empty(spark, tmp_path):
    import corpus_pipeline

    d = f"file://{tmp_path}"
    empty(spark).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
