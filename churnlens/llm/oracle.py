"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_TURNS = """
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
"""

#: Lengths of the marks: 12 opens a block (and a line end), 11 closes it (with its line end), 10 parts merged turns.
CHAT = f"""
WITH turns AS ({_TURNS}),
marked AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS last_role,
           length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS escaped
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + CASE WHEN last_role IS NOT NULL AND last_role = role THEN 10
                               ELSE 12 + length(role) + 1 + 11 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


#: Dense on purpose: every kept term of a language against every pair of its sources.
DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
tokens AS (SELECT lang, source, sum(n) AS tokens FROM n GROUP BY lang, source),
p AS (
    SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 1)) // (coalesce(tokens.tokens, 0) + v.v)::HUGEINT AS p
    FROM g JOIN kept USING (lang) JOIN v USING (lang)
    LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term
    LEFT JOIN tokens ON tokens.lang = g.lang AND tokens.source = g.source
),
q AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)::HUGEINT) // (any_value(all_n) + any_value(v.v))::HUGEINT AS q
    FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS all_n FROM n GROUP BY lang) USING (lang)
    GROUP BY lang, term
),
f AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // q.q AS BIGINT)
    FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts
QUALIFY part = 'pair' OR rank <= 200
"""


#: h by crc32 bit by bit; every node meets each of its ancestors once for the sums over subtrees.
TRIE = r"""
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
hashed AS (
    SELECT conv_id, turns, xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))
    ), 4294967295) % 4 AS h
    FROM own
),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
),
prefix AS (
    SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ends
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
node AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ended,
           CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM prefix GROUP BY path, d
),
child AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
leafy AS (
    SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child ON child.path = node.path AND child.d = node.d
),
under AS (
    SELECT path[1:a] AS path, a AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM leafy) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
FROM leafy n JOIN under u ON u.path = n.path AND u.d = n.d
LEFT JOIN node p ON n.d > 0 AND p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""


ORACLE_SQL = {"op5_chat_format": CHAT, "op11_prefix_trie": TRIE, "op13_divergence": DIVERGENCE}
