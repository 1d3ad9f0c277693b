"""SQL twins (DuckDB) of the operators' queries, where SQL can express them."""

from __future__ import annotations

import re

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len(v) AS n, array_to_string(v, ' ') AS v
  FROM (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i : i + least(10, len(w)) - 1])) AS v FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT p.r, p.n, p.i, x.item_id FROM places p JOIN windows x USING (n, v)),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY r),
longest AS (
  -- grown word by word: a match of n words goes on while the next word agrees
  SELECT r, max(size) AS size FROM (
    SELECT h.r, h.n + coalesce(list_position(list_transform(range(0, least(len(d.w) - h.i - h.n + 1, len(b.w) - t.i - h.n + 1) + 1),
        lambda k: coalesce(d.w[h.i + h.n + k] <> b.w[t.i + h.n + k], true)), true) - 1, 0) AS size
    FROM hits h JOIN d USING (r) JOIN b USING (item_id)
    JOIN (SELECT item_id AS id, n AS m, i, array_to_string(w[i : i + n - 1], ' ') AS v
          FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b, sizes WHERE len(w) >= n)) t
      ON t.id = h.item_id AND t.m = h.n AND t.v = array_to_string(d.w[h.i : h.i + h.n - 1], ' ')
  ) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest.size, 0) AS INTEGER) AS longest_match
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r) LEFT JOIN longest USING (r)
"""

_REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT r, doc_id, hex(b) AS x, octet_length(b) AS n FROM d),
cut AS (SELECT r, doc_id, n, o, substr(x, 2 * o + 1, 1122) AS y FROM (SELECT r, doc_id, x, n, unnest(range(0, n - 49, 512)) AS o FROM h WHERE n >= 50)),
s AS (SELECT r, doc_id, o + i AS i, substr(y, 2 * i + 1, 100) AS v FROM (SELECT r, doc_id, o, y, unnest(range(0, least(512, n - 49 - o))) AS i FROM cut)),
low AS (SELECT md5(v) AS m, min(coalesce(doc_id, 9223372036854775807)) AS doc FROM s GROUP BY 1),
hit AS (SELECT r, i FROM s JOIN low ON md5(v) = m WHERE coalesce(doc_id, 9223372036854775807) > doc),
edges AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS gap FROM hit),
runs AS (SELECT r, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run FROM edges),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS z FROM runs GROUP BY r, run),
per AS (SELECT r, sum(z - a) AS removed, count(*) AS spans, list(struct_pack(a := a, z := z) ORDER BY a) AS l FROM spans GROUP BY r),
keep AS (
  SELECT h.r, doc_id, n, coalesce(removed, 0) AS removed, coalesce(spans, 0) AS spans,
    CASE WHEN l IS NULL THEN x ELSE array_to_string(list_transform(range(0, len(l) + 1), lambda k:
      x[2 * CASE WHEN k = 0 THEN 0 ELSE l[k].z END + 1 : 2 * CASE WHEN k = len(l) THEN n ELSE l[k + 1].a END]), '') END AS y
  FROM h LEFT JOIN per USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, CAST(spans AS BIGINT) AS n_spans, sha256(unhex(y)) AS kept_sha256 FROM keep
"""

_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low.b, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = doc_id
"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS digest FROM p),
last AS (SELECT digest, max(page_id) AS keep FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < keep THEN keep END AS refers_to
FROM d LEFT JOIN last USING (digest)
"""

_NEAR_EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (
  SELECT vec_id, x FROM v
  WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
  coalesce(low.b, vec_id) >= vec_id AS kept
FROM v LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

_CHATS = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/?s>)', '\1\2\\\3', 'g') AS safe,
    regexp_replace(role, '([<\[])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/?s>)', '\1\2\\\3', 'g') AS safe_role FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(CASE role WHEN 'assistant' THEN length(safe) + 4 WHEN 'user' THEN length(safe) + 15 ELSE length(safe_role) + length(safe) + 19 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_MERKLE = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS t,
    CAST(doc_id AS VARCHAR) AS id, source AS s, lang AS l, n_chars, text AS x FROM documents),
f AS (
  -- crc32, bit by bit: every eighth step takes in a character of the id
  SELECT *, n_chars + CASE WHEN xor(list_reduce(
      list_transform(range(0, 8 * len(id)), lambda i: CASE WHEN i % 8 = 0 THEN CAST(ord(substr(id, i // 8 + 1, 1)) AS BIGINT) ELSE 0 END),
      lambda c, v: CASE WHEN xor(c, v) & 1 = 1 THEN xor(xor(c, v) >> 1, 3988292384) ELSE xor(c, v) >> 1 END, CAST(4294967295 AS BIGINT)),
    4294967295) % 7 = 0 THEN 1 ELSE 0 END AS claimed FROM d),
h AS (SELECT r, doc_id, t, sha256(a || CAST_N(n_chars) || z) AS leaf, sha256(a || CAST_N(coalesce(claimed, n_chars)) || z) AS start
  FROM (SELECT *, WRITTEN(id) || WRITTEN(s) || WRITTEN(l) AS a, WRITTEN(x) AS z FROM f)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, start) - 1 AS pos, count(*) OVER (PARTITION BY t) AS size FROM h),
nodes AS (
  SELECT 0 AS level, t, pos, size, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, t, pos // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE size > 1 GROUP BY level, t, pos // 2, size),
subroots AS (SELECT t, digest AS subroot, row_number() OVER (ORDER BY t) - 1 AS place, count(*) OVER () AS parts FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, place AS pos, parts AS size, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE size > 1 GROUP BY level, pos // 2, size),
climb AS (
  SELECT r, t, 0 AS level, pos, size, start AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT c.r, c.t, c.level + 1, c.pos // 2, (c.size + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 1 THEN n.digest || c.folded ELSE c.folded || coalesce(n.digest, '') END), c.proof || coalesce(n.digest, '')
  FROM climb c LEFT JOIN nodes n ON n.level = c.level AND n.t = c.t AND n.pos = xor(c.pos, 1) WHERE c.size > 1),
above AS (
  SELECT r, 0 AS level, place AS pos, parts AS size, folded, proof FROM climb JOIN subroots USING (t) WHERE size = 1
  UNION ALL
  SELECT c.r, c.level + 1, c.pos // 2, (c.size + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 1 THEN n.digest || c.folded ELSE c.folded || coalesce(n.digest, '') END), c.proof || coalesce(n.digest, '')
  FROM above c LEFT JOIN tops n ON n.level = c.level AND n.pos = xor(c.pos, 1) WHERE c.size > 1)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM h JOIN subroots USING (t) JOIN (SELECT r, folded, proof FROM above WHERE size = 1) USING (r), (SELECT digest FROM tops WHERE size = 1)
"""
_MERKLE = re.sub(r"WRITTEN\((\w+)\)", r"coalesce(octet_length(encode(\1)) || ':' || \1, '-')", _MERKLE)
_MERKLE = re.sub(r"CAST_N\(((?:\w+|coalesce\([^)]*\)))\)", r"coalesce(len(CAST(\1 AS VARCHAR)) || ':' || CAST(\1 AS VARCHAR), '-')", _MERKLE)

_COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, string_split_regex(piece, '[ \t]') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
words AS (SELECT * FROM (SELECT lang, piece, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM pieces) WHERE x <> ''),
runs AS (SELECT lang, x, lead(x) OVER here AS y, lead(x, 2) OVER here AS z FROM words WINDOW here AS (PARTITION BY piece ORDER BY i)),
f AS (
  SELECT lang, [x] AS p, count(*) AS f FROM runs GROUP BY lang, x
  UNION ALL SELECT lang, [x, y], count(*) FROM runs WHERE y IS NOT NULL GROUP BY lang, x, y
  UNION ALL SELECT lang, [x, y, z], count(*) FROM runs WHERE z IS NOT NULL GROUP BY lang, x, y, z),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
frequent AS MATERIALIZED (SELECT lang, len(p) AS k, p, array_to_string(p, ' ') AS phrase, f FROM f WHERE f >= 10),
candidates AS (SELECT * FROM frequent WHERE k > 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3) GROUP BY lang, phrase),
cuts AS MATERIALIZED (
  SELECT lang, phrase, f AS a, cut, array_to_string(p[1:cut], ' ') AS first, array_to_string(p[cut + 1 : k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = first JOIN frequent y ON y.lang = c.lang AND y.phrase = rest),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored),
ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE place = 1 AND (longer.f IS NULL OR 100 * longer.f < 50 * a))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_decontamination": _DECONTAMINATION,
    "op3_chat_formatting": _CHATS,
    "op5_repeats": _REPEATS,
    "op8_jaccard_join": _JACCARD,
    "op9_warc_revisits": _WARC,
    "op10_near_embeddings": _NEAR_EMBEDDINGS,
    "op12_merkle_manifest": _MERKLE,
    "op13_collocations": _COLLOCATIONS,
}
