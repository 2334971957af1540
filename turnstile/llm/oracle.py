"""DuckDB SQL of the queries here that SQL can express."""

# Words of the decontamination contract, on lower-cased text: A-Z alone change.
_LOWER = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op1_chat_formatting": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(12 + length(replace(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '</turn>', '<' || chr(92) || '/turn>'),
                        '### ', '#' || chr(92) || '## '), chr(10), chr(92) || 'n'))
                + 1 + length(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '</turn>', '<' || chr(92) || '/turn>'),
                        '### ', '#' || chr(92) || '## ')))::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op2_decontamination": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(t="text")} AS w FROM documents),
        items AS (SELECT item_id::VARCHAR AS item, {_WORDS.format(t="text")} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        wins AS (
            SELECT DISTINCT item, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS n
            FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM wins),
        spots AS (
            SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
        found AS (SELECT r, i, s.n, item FROM spots s JOIN wins USING (win, n)),
        hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, i, n FROM found) f, unnest(range(f.i, f.i + f.n)) AS t(p) GROUP BY r),
        listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM found) x GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
    """,
    "op11_url_filters": """
        WITH parts AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
        pages_cut AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
        rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        words(word, i) AS (VALUES ('adult-', 0), ('ads-', 1), ('casino', 2), ('-bets', 3), ('-pills', 4), ('spam-', 5)),
        judged AS (
            SELECT p.page_id, p.host, p.path,
                (SELECT max_by({'rule': r.host || r.path, 'verdict': r.verdict}, length(r.host || r.path)) FROM rules r
                 WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS r,
                (SELECT max_by('*' || word || '*', 100 * length(word) - i) FROM words WHERE contains(p.host, word)) AS host_glob
            FROM pages_cut p)
        SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN host_glob IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
            CASE WHEN r IS NULL THEN host_glob END AS host_glob
        FROM judged
    """,
    "op12_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format(t="text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
        grams AS (
            SELECT lang, m, w[i:i + m - 1] AS w, count(*) AS f
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, range(1, 5) AS s(m) WHERE len(w) >= m)
            GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
            SELECT lang, m, w, f AS a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:m], ' ') AS q
            FROM grams, range(1, 4) AS s(k) WHERE m >= 2 AND k < m),
        parts AS (SELECT lang, array_to_string(w, ' ') AS part, f FROM grams),
        scored AS (
            SELECT c.lang, array_to_string(w, ' ') AS phrase, a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
            FROM cuts c JOIN parts x ON x.lang = c.lang AND x.part = c.p JOIN parts y ON y.lang = c.lang AND y.part = c.q),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(f) AS longer
            FROM grams, range(2, 4) AS s(n), range(1, 4) AS t(i) WHERE m >= 3 AND n < m AND i + n - 1 <= m GROUP BY ALL),
        kept AS (
            SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
            WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
    """,
    "op13_periodic_runs": """
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                    lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) AS h
            FROM documents),
        sized AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AS hit, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM docs),
        cycled AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM sized),
        planted AS (
            SELECT r, doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w
            FROM cycled),
        words AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS word FROM planted),
        same AS (SELECT x.r, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        stretches AS (
            SELECT r, q, min(i) AS s, count(*) + q AS len
            FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same)
            GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS (SELECT r, s, len, min(q) AS q FROM stretches GROUP BY r, s, len),
        listed AS (
            SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
                arg_min({'s': s, 'len': len, 'q': q}, (-len, s, q)) AS best
            FROM runs GROUP BY r),
        gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.len::BIGINT AS length, best.q::BIGINT AS period,
            (1000 * best.len // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
            sha256(coalesce(t, '')) AS collapsed_sha256, n::BIGINT AS n_words
        FROM planted LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
    """,
}
