"""The same rows in SQL, where it can express the operator."""

OP6 = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
    FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY plain) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(plain) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY plain ORDER BY n_chars DESC, doc_id)
"""

OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, strlen(html)::bigint AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id < last THEN last END AS refers_to
FROM g
"""

# A window: 13 words in a row of an item, or all of a shorter one.
OP10 = r"""
WITH folded AS (
    SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
worded AS (
    SELECT side, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM folded),
windows AS (
    SELECT DISTINCT id AS item_id, len(words[i : i + 12]) AS size, array_to_string(words[i : i + 12], ' ') AS span
    FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 12, least(len(words), 1)) + 1)) AS i
          FROM worded WHERE side = 'b')),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT id AS doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS span
    FROM (SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM worded, sizes WHERE side = 'd')),
met AS (SELECT doc_id, p.size, i, item_id FROM places p JOIN windows w ON p.size = w.size AND p.span = w.span),
hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM met) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::varchar AS item_id FROM met) GROUP BY doc_id)
SELECT w.id AS doc_id, len(words)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM worded w LEFT JOIN hit h ON h.doc_id = w.id LEFT JOIN items t ON t.doc_id = w.id
WHERE side = 'd'
"""

# The tree over the groups has the group number -1. The checksum goes bit by bit.
OP11 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, list_reduce(list_prepend(4294967295::bigint, list_transform(
               string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint)), lambda c, b: list_reduce(
               [xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS crc,
           concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                  coalesce(strlen(lang) || ':' || lang, '-'),
                  coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) AS head, text
    FROM documents),
leaves AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
           count(*) OVER (PARTITION BY source) AS n,
           sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
           CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(concat(head, coalesce(
               strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))) END AS tampered
    FROM d),
nodes AS (
    SELECT g, 0 AS lvl, i, n, leaf AS h FROM leaves
    UNION ALL
    SELECT g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
    FROM nodes WHERE n > 1 GROUP BY g, lvl, i // 3, n),
subroots AS (SELECT g, h FROM nodes WHERE n = 1),
tops AS (
    SELECT -1 AS g, 0 AS lvl, g AS i, (SELECT count(*) FROM subroots) AS n, h FROM subroots
    UNION ALL
    SELECT g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
    FROM tops WHERE n > 1 GROUP BY g, lvl, i // 3, n),
beside AS (
    SELECT g, lvl, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM (SELECT * FROM nodes UNION ALL SELECT * FROM tops) WHERE n > 1
    WINDOW w AS (PARTITION BY g, lvl, i // 3 ORDER BY i)),
up AS (
    SELECT doc_id, g, 0 AS lvl, i, coalesce(tampered, leaf) AS h, '' AS proof FROM leaves
    UNION ALL
    SELECT doc_id, u.g, u.lvl + 1, u.i // 3, sha256(concat(l, h, r)), concat(proof, l, r)
    FROM up u JOIN beside b ON b.g = u.g AND b.lvl = u.lvl AND b.i = u.i),
over_groups AS (
    SELECT doc_id, -1 AS g, 0 AS lvl, g AS i, h, proof
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl DESC) AS nth FROM up) WHERE nth = 1
    UNION ALL
    SELECT doc_id, u.g, u.lvl + 1, u.i // 3, sha256(concat(l, h, r)), concat(proof, l, r)
    FROM over_groups u JOIN beside b ON b.g = u.g AND b.lvl = u.lvl AND b.i = u.i),
ends AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl DESC) AS nth FROM over_groups)
    WHERE nth = 1)
SELECT l.doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM leaves l JOIN subroots s USING (g) JOIN ends e USING (doc_id) JOIN tops t ON t.n = 1
"""

OP12 = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i : i + 49], ' ') AS span
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)),
firsts AS (SELECT span, min(doc_id) AS least FROM windows GROUP BY span),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (span) WHERE doc_id > least),
worded AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS line
    FROM worded ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words)::bigint AS n_words, len(words)::bigint - coalesce(n, 0) AS n_removed,
       sha256(coalesce(line, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

LLM_ORACLES = {"op4_warc": OP4, "op6_exact_dedup": OP6, "op10_decontamination": OP10,
               "op11_merkle_manifest": OP11, "op12_substring_dedup": OP12}
