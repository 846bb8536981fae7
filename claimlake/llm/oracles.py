"""The queries that SQL can express, for DuckDB. Missing are op2, op5, op8 (models) and op11 (random draws); see tests/llm."""

from __future__ import annotations

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
HEAD = r"""
SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {lower}), '') AS host,
       coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
FROM pages
""".format(lower=LOWER)

ORACLES: dict[str, str] = {
    "op1_url_filter": f"""
WITH cut AS ({HEAD}), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged""",
    "op3_embedding_dedup": """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
roots AS (SELECT node, min(other) AS least FROM reach GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(r.least, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(r.least, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN roots r ON r.node = e.vec_id LEFT JOIN counts c ON c.node = e.vec_id""",
    "op4_minhash_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
roots AS (SELECT node, min(other) AS least FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.least, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(r.least, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN roots r ON r.node = d.doc_id""",
    "op6_license_scan": rf"""
WITH sentences AS (
  SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '([.!?])[\x09-\x0D\x20]+|[\x0A\x0D]+', '\1' || chr(10), 'g'), chr(10))) AS s FROM documents),
known AS (
  SELECT doc_id, regexp_replace(regexp_replace(translate(s, {LOWER}), '^[\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x60\x7B-\x7F]+$', '', 'g'), '[\x09-\x0D\x20]+', ' ', 'g') AS s
  FROM sentences),
named AS (
  SELECT doc_id, CASE s WHEN 'released under the mit license' THEN 'MIT' WHEN 'licensed under the mit license' THEN 'MIT'
    WHEN 'permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files' THEN 'MIT'
    WHEN 'licensed under the apache license, version 2.0' THEN 'Apache-2.0'
    WHEN 'this work is licensed under the gnu general public license, version 3' THEN 'GPL-3.0'
    WHEN 'this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license' THEN 'GPL'
    WHEN 'licensed under cc by 4.0' THEN 'CC-BY-4.0' WHEN 'licensed under cc by-nc 4.0' THEN 'CC-BY-NC-4.0' WHEN 'licensed under cc by-sa 4.0' THEN 'CC-BY-SA-4.0'
    WHEN 'redistribution and use in source and binary forms, with or without modification, are permitted' THEN 'BSD' END AS license
  FROM known)
SELECT d.doc_id, coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses, count(license)::BIGINT AS n_matches
FROM documents d LEFT JOIN named n ON n.doc_id = d.doc_id AND n.license IS NOT NULL GROUP BY d.doc_id""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)""",
    "op9_line_dedup": rf"""
WITH lines AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
keyed AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), {LOWER}) AS key FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT k.doc_id, i, line, coalesce(k.doc_id > first, false) AS gone FROM keyed k LEFT JOIN firsts USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_decontaminate": rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bw WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, ns WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, p.n, i FROM places p JOIN windows USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_collocations": rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f FROM places, range(1, 6) AS t(k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
parts AS (
  SELECT lang, g, f, k, unnest(range(1, k)) AS j, string_split(g, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, t.n, j, (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS tail FROM parts) c
  JOIN counts x ON x.lang = c.lang AND x.g = head JOIN counts y ON y.lang = c.lang AND y.g = tail JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(f) AS longer FROM (SELECT lang, f, k, string_split(g, ' ') AS w FROM counts), range(2, 5) AS s(m), range(1, 5) AS q(i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (
  SELECT v.* FROM least v LEFT JOIN inner_parts p ON p.lang = v.lang AND p.g = v.g WHERE p.longer IS NULL OR 100 * p.longer < 100 * v.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000""",
    "op13_spelling": rf"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, {LOWER}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
crc AS (
  SELECT run, n, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM bytes, crc_table),
vocabulary AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM crc GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6),
less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, v.word FROM less l JOIN vocabulary v ON v.word = l.rest
  UNION SELECT v.word, l.word FROM less l JOIN vocabulary v ON v.word = l.rest),
near AS (
  SELECT a AS word, b AS best, v.n AS best_n, count(*) OVER (PARTITION BY a) AS n_near FROM pairs JOIN vocabulary v ON v.word = b
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) = 1),
judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form, CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n
  FROM vocabulary v LEFT JOIN near USING (word)),
followed AS (
  SELECT word, word AS root FROM judged
  UNION SELECT f.word, j.form FROM followed f JOIN judged j ON j.word = f.root WHERE j.form IS NOT NULL),
ends AS (SELECT f.word, f.root FROM followed f JOIN judged j ON j.word = f.root WHERE j.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)""",
}
