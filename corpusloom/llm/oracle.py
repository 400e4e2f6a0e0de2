"""DuckDB SQL for the queries that SQL can express, written apart from their code."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op3_contamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT DISTINCT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM sized) AS sizes WHERE len(w) >= n)
), hits AS (
  SELECT grams.doc_id, grams.i, grams.n, item_id FROM grams JOIN windows USING (n, g)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SQL["op5_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT::DOUBLE
           / 1152921504606846976.0::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source
), lap(round, level, n) AS (
  SELECT 0, (SELECT sum(source_size)::DOUBLE / sum(w)::DOUBLE FROM s), 0::BIGINT
  UNION ALL
  SELECT round + 1, next, m FROM (
    SELECT round, n, level,
      (SELECT count(*) FROM s WHERE 3 * source_size <= w * level) AS m,
      (SELECT (SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(CASE WHEN 3 * source_size <= w * level THEN 3 * source_size END), 0)::DOUBLE FROM s)
      / nullif((SELECT sum(CASE WHEN 3 * source_size <= w * level THEN 0 ELSE w END) FROM s), 0)::DOUBLE AS next
    FROM lap) WHERE m > n AND next IS NOT NULL
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, w * (SELECT arg_max(level, round) FROM lap)) AS target FROM s
), p AS (
  SELECT *, least(coalesce(floor(target / nullif(source_size, 0)), 0), 3) AS whole FROM t
), r AS (
  SELECT *, greatest(target - whole * source_size, 0.0) AS rest FROM p
), o AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.rest,
         sum(d.size) OVER (PARTITION BY r.source ORDER BY (u / (1 - u)) / nullif((rest / source_size) / (1 - rest / source_size), 0)
                           ROWS UNBOUNDED PRECEDING) AS run
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN size > 0 AND rest > 0 AND abs(run - rest) < abs(run - size - rest) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""

_TEMPLATES = (
    ("All rights reserved", "all rights reserved"),
    ("Apache-2.0", "licensed under the apache license version 2 0"),
    ("Apache-2.0 header", "you may not use this file except in compliance with the license"),
    ("BSD", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4 0"),
    ("GPL-3.0", "this work is licensed under the gnu general public license version 3"),
    ("GPL notice", "under the terms of the gnu general public license as published by the free software foundation"),
    ("ISC", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "released under the mit license"),
    ("MIT notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MPL-2.0", "subject to the terms of the mozilla public license v 2 0"),
)

# Containment at every place, without retrieval. Places are the even ones, as windows begin there.
SQL["op2_licenses"] = (
    "WITH t(name, text) AS (VALUES "
    + ", ".join(f"('{n}', '{t}')" for n, t in _TEMPLATES)
    + r"""), tw AS (
  SELECT name, string_split(text, ' ') AS w FROM t
), ts AS (
  SELECT DISTINCT name, len(w) - 1 AS n, w[i] || ' ' || w[i + 1] AS g FROM (SELECT name, w, unnest(range(1, len(w))) AS i FROM tw)
), tn AS (
  SELECT name, n, count(*) AS kinds FROM ts GROUP BY ALL
), d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
), hit AS (
  SELECT s.doc_id, ts.name, ts.n, s.i, s.g FROM s JOIN ts USING (g)
), place AS (  -- a window of four words from word a0 + 1; what is looked a0 begins n - 2 shingles before it
  SELECT DISTINCT h.doc_id, h.name, h.n, a0 FROM (
    SELECT doc_id, name, n, unnest([i - 1, i - 2, i - 3]) AS a0 FROM hit WHERE n >= 4) AS h WHERE a0 >= 0 AND a0 % 2 = 0
), share AS (
  SELECT p.doc_id, p.name, p.a0, count(DISTINCT h.g) AS got
  FROM place p JOIN hit h ON h.doc_id = p.doc_id AND h.name = p.name
   AND h.i >= greatest(p.a0 + 2 - p.n, 1) AND h.i < greatest(p.a0 + 2 - p.n, 1) + 2 * p.n + 4
  GROUP BY ALL
), short AS (  -- templates that hold no window for certain: every stretch of their length that begins with a hit
  SELECT p.doc_id, p.name, p.i, count(DISTINCT h.g) AS got
  FROM hit p JOIN hit h ON h.doc_id = p.doc_id AND h.name = p.name AND h.i >= p.i AND h.i < p.i + p.n
  WHERE p.n < 4 GROUP BY ALL
), found AS (
  SELECT doc_id, name, max(got / kinds::DOUBLE) AS c
  FROM (SELECT doc_id, name, got FROM share UNION ALL SELECT doc_id, name, got FROM short) JOIN tn USING (name) GROUP BY ALL HAVING max(got / kinds::DOUBLE) >= 0.8
)
SELECT d.doc_id, count(name) AS n_licenses, coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses, max(c) AS containment
FROM d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id
"""
)

SQL["op7_fixity"] = r"""
WITH a AS (
  SELECT page_id, crc, octet_length(encode(
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>'
    || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
    || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10))) AS size
  FROM (SELECT *, ('0x' || substr(md5('decay:' || page_id), 1, 15))::BIGINT AS crc FROM pages)
), m AS (
  SELECT *, page_id >> 12 AS file, sum(size) OVER (PARTITION BY page_id >> 12 ORDER BY page_id)::BIGINT AS e FROM a
)
SELECT page_id AS record_id, file, e - size AS begin, e AS "end",
       CASE WHEN crc % 193 = 0 THEN 'missing' ELSE 'changed' END AS status
FROM m WHERE crc % 193 = 0 OR crc % 97 = 1
"""

SQL["op1_extraction"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS body FROM a
), c AS (
  SELECT page_id, url, replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS body FROM b
)
SELECT page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text, length(trim(regexp_replace(body, '\s+', ' ', 'g'))) AS n_chars FROM c
"""

SQL["op6_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y, c = nx.n AND nx.n = ny.n AS equal
  FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 9 * c >= 4 * (nx.n + ny.n)
), reach(doc_id, class_id) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT y, class_id FROM reach JOIN links ON x = reach.doc_id
), least AS (
  SELECT doc_id, min(class_id) AS class_id FROM reach GROUP BY doc_id
), degree AS (
  SELECT x AS doc_id, count(*) AS n_links, count(*) FILTER (equal) AS same FROM links GROUP BY x
)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, 1 + coalesce(same, 0) AS copies FROM least LEFT JOIN degree USING (doc_id)
"""

SQL["op9_repeats"] = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
  SELECT doc_id, p, md5(substr(x, 2 * p + 1, 800)) AS h
  FROM (SELECT doc_id, x, unnest(range(0, strlen(x) // 2 - 399)) AS p FROM d)
), twice AS (
  SELECT h FROM w GROUP BY h HAVING count(*) > 1
), hit AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS new
  FROM w JOIN twice USING (h)
), run AS (
  SELECT doc_id, min(p) AS b, max(p) + 400 AS e
  FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM hit) GROUP BY doc_id, r
), kept AS (  -- what lies before each run, and after the last one
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS f, b AS t FROM run
  UNION ALL
  SELECT d.doc_id, coalesce(max(e), 0), max(strlen(x)) // 2 FROM d LEFT JOIN run USING (doc_id) GROUP BY d.doc_id
), left_over AS (
  SELECT kept.doc_id, string_agg(substr(x, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS y FROM kept JOIN d USING (doc_id) GROUP BY kept.doc_id
), gone AS (
  SELECT doc_id, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id
)
SELECT doc_id, strlen(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(y)) AS kept_sha256
FROM d JOIN left_over USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

# Rows after damage with their first fault; then, row by row, the cheapest edits that lead to each
# state of the pattern (0 nothing, 1 system, 2 user, 3 assistant), of equal cost the least audit.
SQL["op11_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) AS r(n))
), c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), luck AS (
  SELECT c.*, xor(4294967295::BIGINT, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS luck
  FROM c, crc
), damaged AS (
  SELECT conv_id, turn, CASE luck WHEN 4 THEN 'user' ELSE role END AS role,
    CASE luck WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM luck, range(2) AS r(copy) WHERE luck <> 0 AND (copy = 0 OR luck = 3)
), numbered AS (
  SELECT *, row_number() OVER w AS i, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))
), rows AS (
  SELECT *, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS left_over,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM numbered
), marked AS (
  SELECT *, CASE WHEN left_over = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(left_over, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM rows
), inserts(f, t, n, cost, audit, lines) AS (VALUES
  (0, 0, 0, 0, '', ''), (1, 1, 0, 0, '', ''), (2, 2, 0, 0, '', ''), (3, 3, 0, 0, '', ''),
  (0, 2, 1, 3, 'I', E'\nuser:'), (1, 2, 1, 3, 'I', E'\nuser:'), (2, 3, 1, 3, 'I', E'\nassistant:'), (3, 2, 1, 3, 'I', E'\nuser:'),
  (0, 3, 2, 6, 'II', E'\nuser:\nassistant:'), (1, 3, 2, 6, 'II', E'\nuser:\nassistant:'),
  (2, 2, 2, 6, 'II', E'\nassistant:\nuser:'), (3, 3, 2, 6, 'II', E'\nuser:\nassistant:')
), takes(f, initial, t, op) AS (VALUES
  (0, 's', 1, 'K'), (0, 'u', 2, 'K'), (1, 'u', 2, 'K'), (2, 'a', 3, 'K'), (3, 'u', 2, 'K'),
  (0, NULL, 2, 'R'), (1, NULL, 2, 'R'), (2, NULL, 3, 'R'), (3, NULL, 2, 'R'),
  (0, NULL, 0, 'D'), (1, NULL, 1, 'D'), (2, NULL, 2, 'D'), (3, NULL, 3, 'D')
), best(conv_id, i, state, b) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'lines': ''} FROM marked
  UNION ALL
  SELECT best.conv_id, m.i, takes.t, min({
      'cost': b.cost + inserts.cost + CASE op WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN fault = 't' AND op <> 'D' THEN 3 ELSE 0 END,
      'audit': b.audit || inserts.audit || op,
      'lines': b.lines || inserts.lines || CASE op WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
        ELSE chr(10) || CASE takes.t WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || text END})
  FROM best JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM best.conv_id AND m.i = best.i + 1
    JOIN inserts ON inserts.f = best.state
    JOIN takes ON takes.f = inserts.t AND (op <> 'K' OR takes.initial = m.initial) AND (op = 'D' OR fault NOT IN ('b', 'd'))
  GROUP BY best.conv_id, m.i, takes.t
), stats AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), done AS (
  SELECT best.conv_id, min({'cost': b.cost + inserts.cost, 'audit': b.audit || inserts.audit, 'lines': b.lines || inserts.lines}) AS b
  FROM best JOIN stats ON stats.conv_id IS NOT DISTINCT FROM best.conv_id AND stats.n = best.i
    JOIN inserts ON inserts.f = best.state AND inserts.t IN (0, 3)
  GROUP BY best.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(substr(b.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e
  LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM e.conv_id
"""

SQL["op12_negatives"] = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

SQL["op13_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (  -- a backslash for each backslash and each control string
  SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g')) + len(regexp_extract_all(text, '</?s>|\[/?(INST|SYS|ROLE)\]|\[(BOT|TEXT)\]')) AS n,
    length(role) + length(regexp_replace(role, '[^\\]', '', 'g')) + len(regexp_extract_all(role, '</?s>|\[/?(INST|SYS|ROLE)\]|\[(BOT|TEXT)\]')) AS r
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE r + 19 END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
