"""DuckDB SQL for the operators that SQL can express on whole tables.

The others rest on XXH64, tokenizers, trained models or seeded shuffles and
are tested against plain Python versions.
"""

SQL: dict[str, str] = {}

SQL["op3_suffix_array_dedup"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS ord, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
s AS (SELECT r, doc_id, ord, h, CAST(length(h) // 2 AS BIGINT) AS n FROM d),
w AS (SELECT r, ord, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT *, unnest(range(0, n - 49)) AS i FROM s WHERE n >= 50)),
m AS (SELECT r, i FROM (SELECT r, ord, i, min(ord) OVER (PARTITION BY g) AS least FROM w) WHERE least < ord),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM m),
b AS (SELECT s.r, u.p, substr(s.h, 2 * u.p + 1, 2) AS x, gone.p IS NOT NULL AS cut
      FROM s CROSS JOIN LATERAL (SELECT unnest(range(0, s.n)) AS p) u
      LEFT JOIN gone ON gone.r = s.r AND gone.p = u.p WHERE s.r IN (SELECT r FROM gone)),
e AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY r ORDER BY p), false) AS opens FROM b),
k AS (SELECT r, count(*) FILTER (WHERE cut) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
             coalesce(string_agg(x, '' ORDER BY p) FILTER (WHERE NOT cut), '') AS kept FROM e GROUP BY r)
SELECT s.doc_id, s.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.kept, s.h))) AS kept_sha256
FROM s LEFT JOIN k ON k.r = s.r"""

SQL["op4_substring_dedup"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS ord,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
w AS (SELECT r, ord, i, array_to_string(words[i + 1 : i + 50], ' ') AS g
      FROM (SELECT *, unnest(range(0, len(words) - 49)) AS i FROM d WHERE len(words) >= 50)),
m AS (SELECT r, i FROM (SELECT r, ord, i, min(ord) OVER (PARTITION BY g) AS least FROM w) WHERE least < ord),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM m),
t AS (SELECT d.r, u.p, d.words[u.p + 1] AS word FROM d CROSS JOIN LATERAL (SELECT unnest(range(0, len(d.words))) AS p) u),
k AS (SELECT t.r, count(gone.p) AS n_removed, coalesce(string_agg(t.word, ' ' ORDER BY t.p) FILTER (WHERE gone.p IS NULL), '') AS kept
      FROM t LEFT JOIN gone ON gone.r = t.r AND gone.p = t.p GROUP BY t.r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.r = d.r"""

SQL["op8_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
g AS (SELECT DISTINCT item_id, array_to_string(words[i + 1 : i + 10], ' ') AS w, least(10, len(words)) AS n
      FROM (SELECT *, unnest(range(0, greatest(len(words) - 9, 1))) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
o AS (SELECT x.r, x.i, x.n, g.item_id
      FROM (SELECT r, n, i, array_to_string(words[i + 1 : i + n], ' ') AS w
            FROM (SELECT d.r, d.words, s.n, unnest(range(0, len(d.words) - s.n + 1)) AS i
                  FROM d JOIN sizes s ON len(d.words) >= s.n)) x
      JOIN g ON g.w = x.w AND g.n = x.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM o) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named.items, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN named ON named.r = d.r"""


SQL["op12_conversation_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS item,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list(item ORDER BY pos) AS turns,
             flatten([[CAST(ascii(c) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]) AS bits
      FROM t GROUP BY conv_id),
h AS (SELECT conv_id, turns, conv_id - conv_id % 5 AS base,
             CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), bits),
                  lambda c, e: CASE WHEN xor(c, e) & 1 = 1 THEN xor(xor(c, e) >> 1, 3988292384) ELSE xor(c, e) >> 1 END), 4294967295) % 9 AS BIGINT) AS h
      FROM s),
r AS (SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns FROM h a LEFT JOIN h b ON b.conv_id = a.base),
p AS (SELECT conv_id, depth, turns[1:depth] AS k, depth = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM r)),
n AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY depth, k),
c AS (SELECT depth - 1 AS depth, k[1:depth - 1] AS k, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(c.n, 0) AS n_children, (n_convs - 1) * CASE WHEN depth > 0 THEN octet_length(encode(k[depth].t)) ELSE 0 END AS own
      FROM n LEFT JOIN c USING (depth, k)),
b AS (SELECT depth, k, sum(own) AS saved, sum(CAST(n_children = 0 AS BIGINT)) AS leaves
      FROM (SELECT v.own, v.n_children, d AS depth, v.k[1:d] AS k FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v) v) GROUP BY depth, k)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN b USING (depth, k) LEFT JOIN v u ON u.depth = v.depth - 1 AND u.k = v.k[1:v.depth - 1] AND v.depth > 0"""


SQL["op13_phrase_collocation_mining"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, words, k, unnest(range(0, len(words) - k + 1)) AS i FROM (SELECT p.*, unnest([1, 2, 3, 4]) AS k FROM p) x WHERE len(words) >= k),
f AS (SELECT lang, k, array_to_string(words[i + 1 : i + k], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2),
u AS (SELECT lang, phrase, a, words, cut, array_to_string(words[1 : cut], ' ') AS x, array_to_string(words[cut + 1 :], ' ') AS y
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
s AS (SELECT u.lang, u.phrase, u.a, u.cut, fx.f AS l, fy.f AS r, CAST(u.a AS HUGEINT) * 2000000 // (CAST(fx.f AS HUGEINT) + fy.f) AS score
      FROM u JOIN f fx ON fx.lang = u.lang AND fx.phrase = u.x JOIN f fy ON fy.lang = u.lang AND fy.phrase = u.y),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM s) WHERE place = 1),
o AS (SELECT lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, max(a) AS longer
      FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE o.longer IS NULL OR 100 * CAST(o.longer AS HUGEINT) < 80 * CAST(b.a AS HUGEINT)),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT t.lang, t.rank, t.phrase, t.a, t.l, t.r, n.n, CAST(t.score AS BIGINT) AS score FROM t JOIN n USING (lang) WHERE t.rank <= 2000"""
