"""The URL filter against a plain search with backtracking, and its defined cases."""

import random
import re

from turnstile.llm import url_filters
from turnstile.llm.url_filters import Rule, host_rule, host_words, judge_urls


def brute_regex(glob: str) -> str:
    out, at = "", 0
    while at < len(glob):
        if glob.startswith("**", at):
            out, at = out + ".*", at + 2
        elif glob[at] == "*":
            out, at = out + "[^/]*", at + 1
        elif glob[at] == "?":
            out, at = out + "[^/]", at + 1
        elif glob[at] == "\\" and at + 1 < len(glob):
            out, at = out + re.escape(glob[at + 1]), at + 2
        else:
            out, at = out + re.escape(glob[at]), at + 1
    return out


def brute_judge(url, tiers, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = re.match(r"([^/?#]*)([^?#]*)", rest)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in cut[1])
    for k, tier in enumerate(tiers):
        fits = [(-len(r.name), i, r) for i, r in enumerate(tier) if any(re.fullmatch(brute_regex(g), host + cut[2], re.S) for g in r.globs)]
        if fits:
            r = min(fits)[2]
            return host, cut[2], k, r.name, r.verdict
    return host, cut[2], None, None, default


URLS = [None, "", "://", "no scheme", "http://", "HTTP://EXAMPLE.com", "http://example.com/", "http://a.example.com/en/x?q=/fr/#y", "http://x.net?/es/1",
        "http://x.net#a://b.com/en/", "http://x.net/es/1", "http://notnet/es/", "http://.net/es/", "a://b://c.com/", "http://user@www.Example.com:80/en/",
        "http://www.example.com/en/1", "http://example.com/EN/1", "http://日本.example.com/é/ü", "http://exämple.com/*/?", "https://sub.www.example.com/en/",
        "http://x.org/a.example.com/en/", "http://ÀB.com/\n/x", "http://spam-farm.example.org/", "http://my-casino.example.org"]


def test_against_backtracking(spark):
    rng = random.Random(4)
    alphabet = "ab/.é*"
    urls = URLS + ["x://" + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(400)] + URLS[:5]
    urls += ["http://" + "ab/" * 30000 + "end", "http://" + "a" * 50000]  # very long ones go on alone
    globs = ["".join(rng.choice([*"ab/.é", "*", "**", "?", "\\*", "\\"]) for _ in range(rng.randint(0, 7))) for _ in range(150)]
    tiers = [[host_rule("com", "/", "allow"), host_rule("example.com", "/en/", "block"), host_rule("www.example.com", "/en/", "allow"),
              host_rule("net", "/es/", "block"), host_rule("a*b", "/?", "block")],
             [Rule(g, "block" if i % 2 else "allow", (g, g[::-1])) for i, g in enumerate(globs)] + [host_words("spam-", "block"), host_words("casino", "block")]]
    df = spark.createDataFrame([(i, u, "mine", "kept") for i, u in enumerate(urls)], "page_id long, url string, Verdict string, other string")
    words = url_filters.BLOCK_WORDS
    try:
        url_filters.BLOCK_WORDS = 2  # many blocks of rules
        small = url_filters.RuleSet(tiers)
        url_filters.BLOCK_WORDS = words
        assert len(small.blocks) > 5 and len(url_filters.RuleSet(tiers).blocks) == 1
    finally:
        url_filters.BLOCK_WORDS = words
    import pyarrow as pa

    keys = ["".join(brute_judge(u, [], "")[:2]) for u in urls]
    assert small.first(pa.array(keys)).tolist() == url_filters.RuleSet(tiers).first(pa.array(keys)).tolist()
    got = judge_urls(df, tiers)
    assert got.columns == ["page_id", "url", "other", "host", "path", "tier", "rule", "verdict"]
    rows = sorted(got.collect(), key=lambda r: r.page_id)
    assert [r.url for r in rows] == urls and {r.other for r in rows} == {"kept"}
    for r in rows:
        if len(r.url or "") < 1000:
            assert (r.host, r.path, r.tier, r.rule, r.verdict) == brute_judge(r.url, tiers, "allow"), r.url
    assert rows[-1].path == "" and rows[-2].path.endswith("/end")


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(df, [[host_rule("com", "/", "allow")]]).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in judge_urls(one, [], default="block").collect()] == [(None, "block")]
    assert [(r.rule, r.verdict) for r in judge_urls(one, [[]]).collect()] == [(None, "allow")]


def test_query(spark):
    from turnstile.llm.queries import URL_RULES, URL_WORDS, op11_url_filters, read

    sf = "/root/testdata/sf0.001"
    want = {r.page_id: brute_judge(r.url, [URL_RULES, URL_WORDS], "allow") for r in read(spark, sf, "pages").collect()}
    got = op11_url_filters(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        host, path, tier, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.verdict, r.rule, r.host_glob) == (host, path, verdict, rule if tier == 0 else None, rule if tier == 1 else None)
