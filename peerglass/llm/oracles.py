"""SQL that must give the same rows, for the operators that SQL can express."""

from __future__ import annotations

from peerglass.llm.urls import BAD_WORDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tokens(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_tokens('text')} AS w FROM documents),
b AS (SELECT item_id, {_tokens('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS size,
              array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS run
       FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i AS place, array_to_string(w[i:i + size - 1], ' ') AS run
       FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
hits AS (SELECT doc_id, item_id, place, size FROM dw JOIN bw USING (size, run)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT DISTINCT doc_id, place, size FROM hits), LATERAL (SELECT unnest(range(place, place + size)) AS p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
r AS (SELECT *, CASE WHEN contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR regexp_matches(text, '<\\+\|')
                     THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END AS shown FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(length('<|im_start|>' || role || chr(10) || shown || '<|im_end|>' || chr(10))) AS formatted_chars
      FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM c
"""

_WORDS = "|".join(BAD_WORDS)
_URLS = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
rules(verdict, rule_host, rule_path) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
                                                ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
m AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             arg_max(verdict, length(rule_host || rule_path)) AS verdict
      FROM p JOIN rules ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN
         regexp_matches(host, '(^|[^0-9a-z])({_WORDS})([^0-9a-z]|$)')
         OR regexp_matches(translate(path, '{_UPPER}', '{_LOWER}'), '/({_WORDS})(/|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (page_id)
"""

_JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = w.doc_id
"""

# The checksum of a number's digits bit by bit: each digit is mixed in, then eight steps follow.
_PERIODIC = r"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
                      string_split(CAST(doc_id AS VARCHAR), ''), lambda d: list_concat([CAST(ascii(d) AS BIGINT)], list_transform(range(8), lambda i: -1))))),
                      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END) AS inverse
           FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, xor(inverse, 4294967295) % 10 AS pick, xor(inverse, 4294967295) // 10 AS g FROM c),
p AS (SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM g),
x AS MATERIALIZED (SELECT doc_id, i, w[1 + CASE WHEN pick = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
      FROM p, LATERAL (SELECT unnest(range(n)) AS i)),
same AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM x u JOIN x v ON v.doc_id = u.doc_id AND v.word = u.word AND v.i > u.i
         JOIN p ON p.doc_id = u.doc_id AND 4 * (v.i - u.i) <= p.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY doc_id, q, island),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
best AS (SELECT doc_id, count(*) AS n_runs, first(struct_pack(s := start, l := length, q := period) ORDER BY length / period DESC, start, period) AS b,
                string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM x ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM p LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_RANKED = rf"""
WITH d AS (SELECT doc_id, {_tokens('text')} AS w FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
t AS (SELECT DISTINCT item_id, unnest({_tokens('text')}) AS term FROM benchmark),
f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) SEMI JOIN t USING (term) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY term, docs),
parts AS (SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * docs) // words))) AS part
          FROM f JOIN weights USING (term) JOIN d USING (doc_id), s),
scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM t JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores QUALIFY rank <= 10
"""

SQL = {"op6_decontamination": _DECONTAMINATION, "op7_chat": _CHAT, "op8_urls": _URLS, "op9_jaccard": _JACCARD, "op12_periodic": _PERIODIC,
       "op13_ranked_search": _RANKED}
