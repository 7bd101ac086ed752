"""SQL of an independent engine for the queries that SQL can express."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

EXACT = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, translate(coalesce(text, ''), {SPACES}, '') AS form
           FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY form ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY form) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(form) AS text_sha256 FROM k"""

# Five hex digits of the hash are four letters of base 32.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id, upper(sha1(html)) AS hex FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER)
                        >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM g"""

CALLS = """
WITH m AS (SELECT conv_id, turn, role, text,
                  lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
                  lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn,
                  lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS last_role,
                  lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS last_turn FROM conversations),
u AS (SELECT conv_id, turn, turn - 2 * row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS run
      FROM m WHERE role = 'user'),
d AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) - 1 AS depth FROM u),
j AS (SELECT m.*, d.depth FROM m LEFT JOIN d ON m.conv_id = d.conv_id
      AND d.turn = CASE m.role WHEN 'user' THEN m.turn WHEN 'assistant' THEN m.turn - 1 END)
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE role END AS kind,
       CASE role WHEN 'user' THEN 'c' || conv_id || 't' || turn
                 WHEN 'assistant' THEN 'c' || conv_id || 't' || (turn - 1) END AS call_id,
       CASE WHEN role = 'user' AND next_role = 'assistant' AND next_turn = turn + 1 THEN 'linked'
            WHEN role = 'user' THEN 'no result'
            WHEN role = 'assistant' AND last_role = 'user' AND last_turn = turn - 1 THEN 'linked'
            WHEN role = 'assistant' THEN 'no call' END AS status,
       CASE role WHEN 'user' THEN 2 * depth WHEN 'assistant' THEN 2 * depth + 1 END AS step,
       CASE WHEN role = 'user' THEN length(text) >= 40 END AS valid,
       CASE WHEN role = 'user' AND length(text) < 40 THEN '$.query: length' END AS problems,
       CASE role WHEN 'user' THEN '{"arguments":{"query":' || to_json(text) || ',"turn":' || turn || '},"id":"c'
                                  || conv_id || 't' || turn || '","name":"answer","type":"tool_call"}'
                 WHEN 'assistant' THEN '{"content":' || to_json(text) || ',"tool_call_id":"c' || conv_id || 't'
                                       || (turn - 1) || '","type":"tool_result"}'
                 ELSE '{"content":' || to_json(text) || ',"type":"' || role || '"}' END AS json
FROM j"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
r AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS run FROM s),
f AS (SELECT run, min(doc_id) AS first_id FROM r GROUP BY run),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM r JOIN f USING (run) WHERE first_id < doc_id),
k AS (SELECT d.doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) AS d
      ANTI JOIN hit USING (doc_id, i)),
t AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t.text, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""

ORACLES = {
    "op1_exact_dedup": EXACT,
    "op3_warc": WARC,
    "op6_tool_calls": CALLS,
    "op7_substring_dedup": SUBSTRINGS,
    # Every order is walked row by row: a document goes at the first filter of the order that it fails.
    "op11_filter_audit": r"""
        WITH said AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        w AS (
            SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ),
        f AS (
            SELECT w.doc_id, coalesce(source, '') AS part,
                CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
            FROM w
        ),
        d AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM f LEFT JOIN said USING (doc_id) GROUP BY ALL
        ),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ),
        walked AS (
            SELECT part, filter_order, step, fails, n, good, toxic, filter_order[step] AS x,
                (SELECT min(p) FROM unnest(range(1, 6)) r(p) WHERE contains(fails, filter_order[p])) AS gone
            FROM d, o, unnest(range(1, 6)) s(step)
        ),
        steps AS (
            SELECT part, filter_order, step, any_value(x) AS x,
                coalesce(sum(n) FILTER (gone IS NULL OR gone > step), 0) AS kept,
                coalesce(sum(n) FILTER (gone = step), 0) AS removed,
                coalesce(sum(n) FILTER (gone < step AND contains(fails, x)), 0) AS redundant,
                coalesce(sum(n) FILTER (fails = x), 0) AS unique_fails,
                coalesce(sum(good) FILTER (gone = step), 0) AS good_lost,
                coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
            FROM walked GROUP BY ALL
        )
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
            redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
            toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
        FROM steps""",
    # All pairs that share a shingle, then everything that links reach.
    "op12_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS x
            FROM d
        ),
        z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_have AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM both_have p JOIN z y ON a = y.doc_id JOIN z v ON b = v.doc_id WHERE 100 * p.n >= 85 * (y.n + v.n - p.n)
        ),
        reached AS (SELECT a AS doc_id, b AS at FROM links UNION SELECT doc_id, l.b FROM reached r JOIN links l ON r.at = l.a)
        SELECT doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, least(doc_id, coalesce(min(r.at), doc_id)) AS component_id
        FROM d LEFT JOIN z USING (doc_id) LEFT JOIN reached r USING (doc_id) GROUP BY doc_id""",
    # CRC-32 bit by bit over the bytes of id and run; near words meet by the letters left when one is deleted.
    "op13_spelling": r"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce(list_prepend(b, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS t
            FROM range(256) r(b)
        ),
        runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents
        ),
        counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
        coded AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM counted),
        hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(range(1, length(x), 2), lambda k: ('0x' || x[k:k+1])::BIGINT)),
                lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
            FROM coded, crc
        ),
        cut AS (
            SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
        ),
        v AS (
            SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ),
        gaps AS (SELECT word, n, k, word[:k] || word[k + 2:] AS rest FROM v, unnest(range(length(word))) u(k)),
        near AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM gaps a JOIN v b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM gaps a JOIN v b ON a.rest = b.word
        ),
        best AS (
            SELECT word, count(*) AS n_near, min(struct_pack(m := -near_n, near)) AS b FROM near GROUP BY word
        ),
        found AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                CASE WHEN -b.m >= 10 * v.n THEN b.near END AS form, CASE WHEN -b.m >= 10 * v.n THEN -b.m END AS form_n
            FROM v LEFT JOIN best USING (word)
        ),
        ways AS (
            SELECT word, word AS root FROM found
            UNION ALL SELECT w.word, f.form FROM ways w JOIN found f ON w.root = f.word WHERE f.form IS NOT NULL
        )
        SELECT f.word, form, w.root, f.n, n_near, form_n FROM found f JOIN ways w ON f.word = w.word
        WHERE (SELECT g.form FROM found g WHERE g.word = w.root) IS NULL""",
}
