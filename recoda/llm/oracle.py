"""DuckDB SQL for the queries of this subpackage that SQL can express.

Written from the operators' definitions, with their fixed values as literals.
No SQL: token counts, packing and token files (a tokenizer's ids), sharding
(CRC32), toxicity and language (fitted models), SimHash and the pipeline that uses it (XXH64);
tests hold these against brute-force versions.
"""

from __future__ import annotations

OP1_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, len(ls) AS n FROM d),
m AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM l
),
r AS (SELECT *, (coalesce(lag(h) OVER p, 0) * 1000003 + h) % 2147483647 AS r FROM m WINDOW p AS (PARTITION BY rid ORDER BY i)),
s AS (
  SELECT *, CASE
    WHEN i = 1 THEN 1
    WHEN w > 50 OR lag(w) OVER p > 50 THEN 1
    WHEN i >= 3 AND i < n AND lag(r, 1) OVER p < lag(r, 2) OVER p AND lag(r, 1) OVER p <= r THEN 1
    ELSE 0 END AS starts
  FROM r WINDOW p AS (PARTITION BY rid ORDER BY i)
),
c AS (SELECT *, sum(starts) OVER (PARTITION BY rid ORDER BY i) AS chunk FROM s),
t AS (
  SELECT rid, min(i) AS first, max(i) AS last, count(*) FILTER (w > 0) >= 2 OR max(w) > 50 AS eligible
  FROM c GROUP BY rid, chunk
),
f AS (
  SELECT rid, i, n, sum(w) OVER p AS upto, sum(w) OVER p - w AS before, sum(w) OVER p - w + 50 AS ahead, sum(w) OVER p - 50 AS back
  FROM m WHERE w > 0 WINDOW p AS (PARTITION BY rid ORDER BY i)
),
runs AS (
  SELECT a.rid, a.i AS first, b.i AS last FROM f a ASOF JOIN f b ON a.rid = b.rid AND a.ahead < b.upto
  UNION SELECT a.rid, b.i, a.i FROM f a ASOF JOIN f b ON a.rid = b.rid AND a.back > b.before
  UNION SELECT rid, 1, n FROM f
),
places AS (
  SELECT rid, first, last, bool_or(chunk) AS chunk
  FROM (SELECT *, FALSE AS chunk FROM runs UNION ALL SELECT rid, first, last, TRUE FROM t WHERE eligible)
  GROUP BY rid, first, last
),
g AS (
  SELECT rid, first, last, chunk,
         row_number() OVER (PARTITION BY array_to_string(ls[first : last], chr(10)) ORDER BY doc_id NULLS LAST, rid, first, last) > 1 AS gone
  FROM places JOIN d USING (rid)
),
x AS (SELECT DISTINCT rid, unnest(range(first, last + 1)) AS i FROM g WHERE gone),
o AS (
  SELECT m.rid, count(*)::BIGINT AS n_lines, count(x.i)::BIGINT AS n_removed_lines,
         CASE WHEN coalesce(max(m.w) FILTER (x.i IS NULL), 0) > 0
              THEN string_agg(line, chr(10) ORDER BY m.i) FILTER (x.i IS NULL) ELSE '' END AS clean
  FROM m LEFT JOIN x ON m.rid = x.rid AND m.i = x.i GROUP BY m.rid
),
k AS (SELECT rid, count(*)::BIGINT AS n_chunks FROM t GROUP BY rid),
e AS (SELECT rid, (count(*) FILTER (gone AND chunk))::BIGINT AS n FROM g GROUP BY rid)
SELECT d.doc_id, n_lines, n_chunks, coalesce(e.n, 0) AS n_removed_chunks, n_removed_lines,
       CASE WHEN n_removed_lines = 0 THEN d.text ELSE clean END AS text
FROM d JOIN o USING (rid) JOIN k USING (rid) LEFT JOIN e USING (rid)
"""

OP6_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
),
rep AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) WHERE c > 1)
  GROUP BY rid
),
l AS (
  SELECT rid, source, t, regexp_replace(lower(trim(regexp_replace(x, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ')), '[0-9]+', '0', 'g') AS x,
         len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM (SELECT rid, source, t, unnest(ls) AS x FROM w)
),
u AS (SELECT DISTINCT source, t, x, n > 25 AS long FROM l),
ranked AS (
  SELECT *, nth_value(x, 1) OVER p AS first, nth_value(x, 2) OVER p AS second
  FROM u WINDOW p AS (PARTITION BY source, t ORDER BY strlen(x) DESC, x ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
counted AS (
  SELECT source, x, CASE WHEN long THEN 'line ' || CASE WHEN x = first THEN second ELSE first END END AS other, t FROM ranked
),
boiler AS (SELECT source, x FROM counted GROUP BY source, x HAVING count(DISTINCT coalesce(other, 'text ' || t)) > 10),
lost AS (
  SELECT rid, sum(n) AS n FROM l JOIN boiler b ON l.source IS NOT DISTINCT FROM b.source AND l.x = b.x GROUP BY rid
),
o AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_boilerplate_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_boilerplate_words <= 0.5 * n_words AS kept,
       n_boilerplate_words
FROM o
"""

_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS ws FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item, n, array_to_string(ws[i : i + n - 1], ' ') AS k
  FROM (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
        FROM b WHERE len(ws) > 0)
),
grams AS (
  SELECT rid, n, i, array_to_string(ws[i : i + n - 1], ' ') AS k
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))
),
hits AS (SELECT rid, i, g.n, item FROM grams g JOIN win USING (n, k)),
places AS (
  SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid
),
items AS (
  SELECT rid, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)
"""

OP10_SQL = """
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
p AS (
  SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
),
terms(term, weight) AS (VALUES
  ('porn', 2), ('porno', 2), ('xxx', 2), ('hentai', 2), ('milf', 2), ('camgirls', 2), ('cheap-pills', 2), ('spam-farm', 2),
  ('warez', 2), ('phishing', 2), ('casino', 1), ('poker', 1), ('betting', 1), ('slots', 1), ('viagra', 1), ('pills', 1),
  ('spam', 1), ('adult', 1), ('sex', 1), ('nude', 1), ('escort', 1), ('dating', 1), ('torrent', 1), ('crack', 1),
  ('keygen', 1), ('replica', 1), ('loan', 1), ('cheap', 1), ('free', 1), ('win', 1)),
hits AS (
  SELECT rid, (count(*) FILTER (weight = 2))::INTEGER AS strict_hits, (count(*) FILTER (weight = 1))::INTEGER AS soft_hits
  FROM p JOIN terms ON regexp_matches(low, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY rid
),
j AS (
  SELECT page_id, host, path, coalesce(strict_hits, 0)::INTEGER AS strict_hits, coalesce(soft_hits, 0)::INTEGER AS soft_hits, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p LEFT JOIN hits USING (rid)
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN strict_hits > 0 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_hits
FROM j
"""

OP12_SQL = """
WITH t AS (
  SELECT conv_id, bytes, dig, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dig) AS i
  FROM (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
           substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30) AS dig
    FROM conversations WHERE conv_id IS NOT NULL)
),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
),
r AS (
  SELECT conv_id, dig, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth
  FROM (
    SELECT c.conv_id, t.dig, t.bytes, 0 AS part, t.i FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
    UNION ALL
    SELECT c.conv_id, t.dig, t.bytes, 1, t.i FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h)
),
k AS (
  SELECT conv_id, depth, bytes, string_agg(dig, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
),
p AS (
  SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS last FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
),
n AS (
  SELECT node, depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last) AS ends
  FROM p GROUP BY node, depth
),
f AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN f USING (node)),
s AS (
  SELECT a.node, count(*) FILTER (m.n_children = 0) AS n_leaves, sum(m.saved) AS saved_tokens
  FROM m JOIN p a ON a.conv_id = m.conv_id AND a.depth <= m.depth GROUP BY a.node
)
SELECT m.conv_id, m.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s USING (node) LEFT JOIN n q ON q.node = m.parent
"""

OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents
),
stats AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS l FROM d),
term AS (
  SELECT rid, doc_id, n, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
),
item AS (
  SELECT DISTINCT iid, item_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM (
    SELECT row_number() OVER () AS iid, item_id,
           unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
    FROM benchmark)
),
tf AS (
  SELECT rid, doc_id, n, t, count(*) AS tf FROM term WHERE t IN (SELECT t FROM item) GROUP BY ALL
),
w AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, stats GROUP BY t, n_docs
),
part AS (
  SELECT rid, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // l))) AS gain
  FROM tf JOIN w USING (t), stats
),
scored AS (
  SELECT iid, item_id, rid, doc_id, sum(gain)::BIGINT AS score FROM item JOIN part USING (t) GROUP BY ALL HAVING sum(gain) > 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid)::INTEGER AS rank FROM scored
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL = {
    "op1_line_dedup": OP1_SQL,
    "op6_quality": OP6_SQL,
    "op7_decontamination": OP7_SQL,
    "op10_url_filter": OP10_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}

PIPELINE_SQL = None
