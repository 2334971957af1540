"""Decontamination, secrets, token counts and quality rules against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import empty, table, texts
from turnstile.llm import decontaminate, quality, secrets, unigram
from turnstile.llm.queries import tokenizer_file

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# ---- decontamination

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_items(text, items, window):
    words = ITEM_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        if item is None or t is None:
            continue
        own = ITEM_WORD.findall(t.translate(LOWER))
        windows = [own] if 0 < len(own) < window else [own[k:k + window] for k in range(len(own) - window + 1)]
        for w in windows:
            for p in range(len(words) - len(w) + 1):
                if words[p:p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    found.add(str(item))
    return len(words), sorted(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_decontamination(spark, block_bytes):
    some = texts()
    rng = random.Random(9)
    items = [(k, " ".join((some[20 + k] or "").split()[3:3 + rng.choice([2, 13, 20])])) for k in range(8)]
    items += [(20, "one"), (21, "one"), (22, ""), (23, "--"), (24, None), (None, "alpha"), (25, "日本 ÉTA")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    made = decontaminate.find_items(table(spark, some, ("n_hit", "hits", "block")), bench, block_bytes=block_bytes)
    got = made.collect()
    assert len(got) == len(some) + 2
    for r in got:
        n, hit, found = brute_items(r.text, items, 13)
        assert (r.n_words, r.n_hit, list(r.hits), list(r["items"])) == (n, len(hit), hit, found)
        assert r.block == "mine"


def test_decontamination_with_clashing_names(spark):
    """Columns named as results in any case are replaced, in one block of items and in many; names like the temporary ones stay."""
    some = texts()[:30]
    bench = spark.createDataFrame([(k, " ".join((some[20 + k] or "").split()[3:23])) for k in range(6)], "item_id long, text string")
    df = table(spark, some, ("Items", "N_HIT", "_new_items", "_newitems"))
    for block_bytes in (decontaminate.BLOCK_BYTES, 60):
        made = decontaminate.find_items(df, bench, block_bytes=block_bytes)
        assert made.columns == [*[c for c in df.columns if c not in ("Items", "N_HIT")], "n_words", "n_hit", "items", "hits"]
        rows = made.select("doc_id", "items", "n_hit", "_new_items", "_newitems").collect()
        assert len(rows) == df.count() and {r["_new_items"] + r["_newitems"] for r in rows} == {"minemine"} and sum(r.n_hit > 0 for r in rows) >= 6


def test_decontamination_empty(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_items(empty(spark), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.find_items(table(spark, texts()), none).collect()} == {0}


def test_wu_manber_overlaps():
    search = decontaminate.WuManber([b"aaa", b"aaaa", b"abcab", b"bca" * 30]).search
    data = b"aaaaabcabcab" + b"bca" * 40
    place, found = search(np.frombuffer(data, np.uint8))
    want = sorted((i, k) for k, p in enumerate([b"aaa", b"aaaa", b"abcab", b"bca" * 30]) for i in range(len(data)) if data.startswith(p, i))
    assert sorted(zip(place.tolist(), found.tolist())) == want


# ---- secrets

def der(tag, content):
    n = len(content)
    head = bytes([n]) if n < 128 else bytes([0x80 | len(b := n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + b
    return bytes([tag]) + head + content


def rsa_key():
    rng = random.Random(4)
    big = [bytes([rng.randrange(1, 128), *(rng.randrange(256) for _ in range(n - 1))]) for n in (128, 3, 127, 64, 63, 64, 63, 62)]
    return der(0x30, der(2, b"\0") + b"".join(der(2, x) for x in big))


def b64(data, url=False):
    import base64

    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def test_structural_secrets():
    key = rsa_key()
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") \
        + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 51, b"q" * 136))
    head, body = b64(b'{"alg":"HS256","typ":"JWT"}', True), b64(b'{"sub":"1"}', True)
    cases = {
        f"x {b64(key)} y": "der", f"é {key.hex()} y": "der", f"x {b64(ssh)} y": "openssh",
        f"-----BEGIN RSA PRIVATE KEY-----\n{b64(key)}\n-----END RSA PRIVATE KEY-----": "pem",
        f"t {head}.{body}.{b64(b's' * 32, True)} u": "jwt", f"t {b64(b'{"alg":"none"}', True)}.{body}. u": "jwt"}
    for text, kind in cases.items():
        found = [s for s in secrets.structural_spans(text) if s[0] == kind]
        assert len(found) == 1, (kind, text[:40])
    for text in (b64(key[:-1]), b64(b"0" * 90), key.hex()[2:], f"{head}.{head[:-2]}.abcdef", "eyJhbGciOi.eyJ.x", b64(ssh + b"z"),
                 f"{b64(b'{"a":1}', True)}.{body}.{b64(b's' * 32, True)}", f"{head}.{body}."):
        assert not secrets.structural_spans(text), text[:40]


def brute_base(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [("assign", *m.span())] if len(m[2]) >= 6 else []
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_structural_secrets_in_context():
    key = rsa_key()
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") \
        + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 51, b"q" * 136))
    head, body, plain = b64(b'{"alg":"HS256","typ":"JWT"}', True), b64(b'{"sub":"1"}', True), b64(b'{"alg":"none"}', True)
    token = f"{head}.{body}.{b64(b's' * 32, True)}"
    for text, part in ((f"use {token}. Then", token), (f"use {token}.", token), (f"use {token}...", token), (f"it ends.{token} u", token),
                       (f"sentences.{token}.", token), (f"sentences.{plain}.{body}.", f"{plain}.{body}.")):
        assert [text[a:b] for k, a, b in secrets.structural_spans(text) if k == "jwt"] == [part], text
    for text in (f"{token}.more", f"{token}.-", f"sentences.{head}.{body}.", f"x{token}"):
        assert not [s for s in secrets.structural_spans(text) if s[0] == "jwt"], text

    def block(headers, data, width=64, end="\n"):
        run = b64(data)
        lines = ["-----BEGIN RSA PRIVATE KEY-----", *headers, *[run[i:i + width] for i in range(0, len(run), width)], "-----END RSA PRIVATE KEY-----"]
        return end.join(lines)

    sealed = bytes(i * 37 % 251 for i in range(608))
    proc, aes, des = "Proc-Type: 4,ENCRYPTED", f"DEK-Info: AES-128-CBC,{'0A' * 16}", f"DEK-Info: DES-EDE3-CBC,{'0A' * 8}"
    for text in (block([proc, aes, ""], sealed), block([proc, des, ""], sealed), block([proc, aes, ""], sealed, end="\r\n"), block([proc, aes, ""], sealed, end="\\n"),
                 block([proc, aes], sealed, end=" "), block([proc, aes, ""], sealed, end="\n    "), block([proc, f"DEK-Info: AES-128-CFB,{'0A' * 16}", ""], sealed[:-3]),
                 block(["Comment: a long", "  comment - it goes on", ""], key), block(["Comment: one \\", "two"], ssh), block([], key)):
        assert secrets.structural_spans(f"é {text} y") == [("pem", 2, 2 + len(text))], text[:90]
        assert secrets.masked(f"é {text} y", secrets.spans_of(f"é {text} y")) == f"é {secrets.MASK} y"
    for text in (block([proc, aes, ""], sealed[:-3]), block([aes, ""], sealed), block([proc, ""], sealed), block([proc, aes, ""], b"ab"), block(["DEK-Info: x", ""], sealed)):
        assert not secrets.structural_spans(text), text[:90]
    for run in (ssh.hex(), ssh.hex().upper()):
        assert secrets.structural_spans(f"x {run} y") == [("openssh", 2, 2 + len(run))]
        assert not secrets.structural_spans(f"x {run}00 y")


def test_secrets_in_disguise():
    """Wrapped, prefixed, colon-separated, doubly encoded keys and pretty-printed tokens; near misses beside them."""
    key = rsa_key()
    run = b64(key)
    lines = [run[i:i + 64] for i in range(0, len(run), 64)]
    assert len(lines[-1]) < 64
    for end in ("\n", "\r\n", "\n    "):
        text = end.join(lines)
        assert secrets.structural_spans(f"é\n{text}\nThe end") == [("der", 2, 2 + len(text))]
    assert not secrets.structural_spans("\n".join([*lines[:3], lines[3][:-1], *lines[4:]]))
    for before in ("path/to/", "a-b_", "/M/MM/", "Mx+"):
        assert secrets.structural_spans(f"x {before}{run} y") == [("der", 2 + len(before), 2 + len(before) + len(run))], before
    assert not secrets.structural_spans(f"x path/to/{run[:-4]} y")
    for sep in (":", ":\n    "):
        colons = sep.join(f"{b:02x}" for b in key)
        assert secrets.structural_spans(f"x {colons} y") == [("der", 2, 2 + len(colons))]
        assert not secrets.structural_spans(f"x {colons[:-2]}zz y")
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(lines) + "\n-----END RSA PRIVATE KEY-----\n"
    twice = b64(pem.encode())
    assert secrets.structural_spans(f"key: {twice} y") == [("pem", 5, 5 + len(twice))]
    assert not secrets.structural_spans(b64(pem.replace("BEGIN RSA", "BEGIN DSA").encode()))
    for space in ("\n  ", " ", "\r\n", "\t"):
        head, body = b64(f'{{{space}"alg": "HS256"}}'.encode(), True), b64(f'{{{space}"sub": "1"}}'.encode(), True)
        token = f"{head}.{body}.{b64(b's' * 32, True)}"
        assert secrets.structural_spans(f"t {token}, u") == [("jwt", 2, 2 + len(token))], space


def test_secret_spans(spark):
    rng = random.Random(2)
    parts = ["token", "PassWord", "ſecret", "api_key", "apikey", "toKen", "=", ":", " ", '"', "'", "abc123", "AKIA", "ABCDEFGHIJ0123456", "0a" * 13, "é", "\n", "."]
    some = texts() + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    got = secrets.find_secrets(table(spark, some, ("spans", "kind"))).collect()
    assert len(got) == len(some) + 2
    for r in got:
        spans = [tuple(s) for s in r.spans]
        assert [s for s in spans if s[0] in secrets.BASE] == brute_base(r.text or "")
        assert spans == sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2])) and r.kind == "mine"
    assert secrets.find_secrets(empty(spark)).count() == 0


def test_masking(spark):
    df = spark.createDataFrame([(1, 'a token = "0123456789abcdef0123456789ab" b'), (2, "clean"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.masked for r in secrets.mask_secrets(df).collect()}
    assert got == {1: 'a [secret]" b', 2: None, 3: None}


# ---- token counts

def library(vocabulary, byte_fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.SPACE, prepend_scheme="always", split=True)
    return t


def test_token_counts_equal_the_library(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    t = library(unigram.read_vocabulary(path), True)
    some = texts() + ["▁", "a▁b", "▁▁a", "😀😀 é", "<0x0A>", "<unk> a</s>", "  a  b "]
    for r in unigram.count_tokens(table(spark, some, ("score",)), path).collect():
        assert r.n_tokens == len(t.encode(r.text or "", add_special_tokens=False).ids)
    assert unigram.count_tokens(empty(spark), path).count() == 0


def test_ties_and_unknown_pieces():
    rng = random.Random(1)
    for trial in range(20):
        pieces = dict.fromkeys(["<unk>", "▁"] + ["".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(30)])
        vocabulary = [(p, -float(rng.randint(1, 4))) for p in pieces]  # few scores: many ties
        t, model = library(vocabulary, False), unigram.Unigram(vocabulary)
        for _ in range(200):
            x = "".join(rng.choice("aabbc xyé") for _ in range(rng.randint(0, 25)))
            assert model.text(x)[0] == len(t.encode(x, add_special_tokens=False).ids), x


# ---- quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = t.split("\n")
    again = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), again, len(cover)


def test_statistics(spark):
    rng = random.Random(8)
    some = texts() + ["".join(rng.choice(["a ", "b ", "é\n", "#$ ", "a\n", "c d e f g ", "\x0b"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for r in quality.text_statistics(table(spark, some, ("n_words", "N_lines"))).collect():
        assert tuple(r[c] for c in quality.COUNTS[:5]) == brute_statistics(r.text)
    assert quality.text_statistics(empty(spark)).count() == 0


def labelled(spark, n=900):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        w = [rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(12, 80))]
        docs.append((i, " ".join(x + "***" if bad else x for x in w)))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    return docs, labels, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_on_held_out_rows(spark):
    docs, _, table_, labels = labelled(spark)
    kept = {r.doc_id: r.kept for r in quality.judge(table_, labels).collect()}
    wrong = sum(kept[i] == ("*" in t) for i, t in docs if not i % 2)  # even ids have no label
    assert wrong <= 0.02 * len(docs)
    rules = quality.fit(table_, labels)
    assert rules and all(1 <= len(r) <= quality.MAX_CONDITIONS for r in rules)
    few = quality.fit(table_, labels, max_labelled=150)
    assert few


def test_rules_without_labels(spark):
    _, _, docs, labels = labelled(spark, 60)
    for none in (labels.limit(0), labels.where("quality = 1"), labels.selectExpr("doc_id", "cast(null as int) as quality")):
        got = quality.judge(docs, none).collect()
        assert all(r.kept == (not r.base_failed) for r in got)
    twice = labels.union(labels.selectExpr("doc_id", "1 - quality", "toxic"))  # contradictory
    assert quality.fit(docs, twice) == []
    assert quality.judge(empty(docs.sparkSession), labels).count() == 0
