"""SQL each query must equal, where SQL can express it.

Searches by checksum, trained models, sampling and tokenizers have none; the tests hold those queries against
plain versions.
"""

from __future__ import annotations

_QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
p AS (SELECT r, least(3, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS step FROM h WHERE n > 1),
c AS (SELECT r, sum(step)::BIGINT AS covered FROM p GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered, 0)::BIGINT AS n_repeat_words,
    len(ls) AS n_lines, length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
    length(t) - length(regexp_replace(t, '\p{Ll}', '', 'g')) AS n_lower, length(t) - length(replace(t, '!', '')) AS n_shouts
  FROM d JOIN w USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, (n_words < 50)::BIGINT AS b0, (100 * n_repeat_words > 50 * n_words)::BIGINT AS b1,
    (10 * n_symbols > n_words)::BIGINT AS b2, (n_upper > n_lower AND n_upper >= 20)::BIGINT AS b3,
    (10 * n_shouts > n_words)::BIGINT AS b4, (100 * n_dup_lines > 50 * n_lines AND n_lines >= 4)::BIGINT AS b5,
    (word_chars > 20 * n_words OR word_chars < 2 * n_words)::BIGINT AS b6 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 + b1 > 0 AS base_failed,
  b0 + b1 + b2 + b3 + b4 + b5 + b6 = 0 AS kept,
  (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6)::BIGINT AS fail_bits FROM b"""

_PLAIN = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_PLAIN} AS ws FROM benchmark),
p AS (SELECT DISTINCT item, len(ws[i:i + 12]) AS size, array_to_string(ws[i:i + 12], ' ') AS pattern
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM p),
s AS (SELECT r, i, size, array_to_string(ws[i:i + size - 1], ' ') AS pattern
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes WHERE len(ws) >= size)),
h AS (SELECT r, i, s.size, item FROM s JOIN p USING (size, pattern)),
n AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM h) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)"""

_SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS turn FROM g),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM o WHERE turn > 1),
s AS (SELECT doc_id, list(place) AS gone FROM p GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
    ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)"""

def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

_CRC = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS entries)"""

# Hex digits of one length are ordered as the numbers they show, and the largest number has the smallest score.
_SHARDS = f"""
WITH {_CRC},
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, encode(coalesce(text, '')) AS body FROM documents),
s AS (SELECT doc_id, k, octet_length(body) + 8 AS size, xor(list_reduce(list_transform(regexp_extract_all(lower(hex(body)), '..'),
    lambda x: (instr('0123456789abcdef', x[1]) - 1) * 16 + instr('0123456789abcdef', x[2]) - 1), lambda c, b:
    xor(c // 256, entries[xor(c, b) % 256 + 1]), 4294967295), 4294967295)::BIGINT AS crc,
  list_transform(range(25), lambda i: md5(k || '/' || i)[1:13]) AS draws FROM d, crc),
p AS (SELECT *, list_position(draws[1:24], list_max(draws[1:24])) - 1 AS shard FROM s)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(k || '#' || size || '#' || crc)[1:3], doc_id NULLS FIRST, size, crc) - 1 AS slot,
  CASE WHEN draws[25] > list_max(draws[1:24]) THEN 24 ELSE shard END::INTEGER AS grown_shard FROM p"""

_NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS shingle
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS x, b.r AS y, count(*) AS same FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * same >= 85 * (a.n + b.n - same)),
reach AS (SELECT r AS x, r AS y FROM n UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
least AS (SELECT x AS r, min(doc_id) AS component FROM reach JOIN d ON d.r = reach.y GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component END AS component_id,
  doc_id IS NOT DISTINCT FROM CASE WHEN n IS NULL THEN doc_id ELSE component END AS kept
FROM d LEFT JOIN n USING (r) LEFT JOIN least USING (r)"""

_MANIFEST = f"""
WITH RECURSIVE {_CRC},
d AS (SELECT *, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
    xor(c // 256, entries[xor(c, b) % 256 + 1]), 4294967295) % 2 = 1 AS even FROM documents, crc),
l AS (SELECT row_number() OVER () AS r, doc_id, source, sha256({_HEAD} || {_field('text')}) AS leaf,
    sha256({_HEAD} || {_field("(CASE WHEN even THEN replace(text, chr(10), '') ELSE text END)")}) AS changed FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS size FROM l),
tree AS (SELECT source, 0 AS lvl, pos, size, leaf AS node FROM p
  UNION ALL SELECT source, lvl + 1, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE size > 1
  GROUP BY source, lvl, size, pos // 3),
subs AS (SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
  FROM tree WHERE size = 1),
over AS (SELECT 0 AS lvl, pos, size, node FROM subs
  UNION ALL SELECT lvl + 1, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM over WHERE size > 1
  GROUP BY lvl, size, pos // 3),
fold AS (SELECT r, source, 0 AS lvl, pos, changed AS node, '' AS proof FROM p
  UNION ALL SELECT f.r, f.source, f.lvl + 1, f.pos // 3,
    sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.node ELSE t.node END, '' ORDER BY t.pos)),
    f.proof || coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), '')
  FROM fold f JOIN tree t ON t.source IS NOT DISTINCT FROM f.source AND t.lvl = f.lvl AND t.pos // 3 = f.pos // 3 AND t.size > 1
  GROUP BY f.r, f.source, f.lvl, f.pos, f.proof),
up AS (SELECT r, 0 AS lvl, s.pos, s.node AS subroot, f.node, f.proof
  FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lvl DESC) AS last FROM fold) f
  JOIN subs s ON s.source IS NOT DISTINCT FROM f.source WHERE last = 1
  UNION ALL SELECT u.r, u.lvl + 1, u.pos // 3, u.subroot,
    sha256(string_agg(CASE WHEN o.pos = u.pos THEN u.node ELSE o.node END, '' ORDER BY o.pos)),
    u.proof || coalesce(string_agg(o.node, '' ORDER BY o.pos) FILTER (o.pos <> u.pos), '')
  FROM up u JOIN over o ON o.lvl = u.lvl AND o.pos // 3 = u.pos // 3 AND o.size > 1 GROUP BY u.r, u.lvl, u.pos, u.subroot, u.proof),
root AS (SELECT node AS root FROM over WHERE size = 1)
SELECT l.doc_id, l.leaf, u.subroot, root, sha256(u.proof) AS proof_sha256, u.node AS folded_root, u.node = root AS verified
FROM l JOIN (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lvl DESC) AS last FROM up) u USING (r), root WHERE last = 1"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": _QUALITY, "op6_sharding": _SHARDS, "op7_near_dups": _NEAR_DUPLICATES,
    "op9_decontaminate": _CONTAMINATION, "op11_substring_dups": _SUBSTRINGS,
    "op12_merkle_manifest": _MANIFEST,
}
