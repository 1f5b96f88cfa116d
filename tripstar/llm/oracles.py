"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_OP1 = r"""
WITH w AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT *, row_number() OVER () AS rid FROM w),
words AS (
  SELECT rid, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM p),
hashed AS (
  SELECT rid, doc_id, word, pos, ('0x' || md5(word)[1:7])::BIGINT AS h,
    lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3,
    lead(('0x' || md5(word)[1:7])::BIGINT) OVER o AS h2
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY pos)),
cells AS (
  SELECT rid, doc_id, h % 65536 AS cell FROM hashed
  UNION ALL SELECT rid, doc_id, (h * 31 + h2 + 7) % 65536 FROM hashed WHERE h2 IS NOT NULL),
trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
counts AS (
  SELECT cell, count(*) AS raw, count(t.doc_id) AS target FROM cells LEFT JOIN trusted t USING (doc_id) GROUP BY cell),
totals AS (SELECT sum(raw) AS raw, sum(target) AS target FROM counts),
weights AS (
  SELECT cell, CASE WHEN t.target = 0 THEN 0 ELSE
    round_even(ln((c.target + 4.0::DOUBLE) / (c.raw * t.target::DOUBLE / t.raw::DOUBLE + 4.0::DOUBLE)) * 65536, 0) END::BIGINT AS weight
  FROM counts c, totals t),
scores AS (SELECT rid, count(*) AS n_ngrams, sum(weight)::BIGINT AS llr_fixed FROM cells JOIN weights USING (cell) GROUP BY rid),
twice AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, word, w2, w3) AS n FROM hashed WHERE w3 IS NOT NULL) WHERE n > 1),
repeats AS (
  SELECT rid, count(DISTINCT pos + d) AS n FROM twice, (VALUES (0), (1), (2)) v(d) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM p),
dups AS (
  SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
base AS (
  SELECT p.doc_id, p.rid, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
    coalesce(n_ngrams, 0)::BIGINT AS n_ngrams, coalesce(llr_fixed, 0)::BIGINT AS llr_fixed
  FROM p LEFT JOIN dups USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN scores USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND llr_fixed >= -0.09::DOUBLE * 65536 * n_ngrams AS kept,
  n_ngrams, llr_fixed
FROM base
"""

_OP3 = r"""
WITH p AS (
  SELECT page_id, url, nullif(regexp_replace(regexp_replace(
    regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '^www\.', ''), '') AS host FROM pages),
captures AS (SELECT p.*, e.ts + INTERVAL 12 HOURS AS fetched FROM p LEFT JOIN events e ON e.user_id = p.page_id),
entries AS (
  SELECT list, pattern, since, min(is_on) AS is_on FROM (
    SELECT CASE event_type WHEN 'error' THEN 'block' WHEN 'purchase' THEN 'block' WHEN 'signup' THEN 'allow' WHEN 'view' THEN 'allow' END AS list,
      CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END AS is_on,
      regexp_replace(regexp_replace(CASE WHEN user_id % 5 = 0 THEN regexp_replace(host, '^[^.]*\.', '') ELSE host END, '\.+$', ''), '^www\.', '') AS pattern,
      ts AS since
    FROM events JOIN p ON p.page_id = events.user_id)
  WHERE list IS NOT NULL AND pattern <> '' AND since IS NOT NULL GROUP BY ALL),
hosts AS (SELECT DISTINCT host, fetched, string_split(host, '.') AS parts FROM captures WHERE host IS NOT NULL AND fetched IS NOT NULL),
parents AS (SELECT host, fetched, array_to_string(parts[i:], '.') AS pattern FROM hosts, unnest(range(1, len(parts) + 1)) t(i)),
asked AS (SELECT parents.*, n.list FROM parents JOIN (SELECT DISTINCT list, pattern FROM entries) n USING (pattern)),
active AS (
  SELECT a.host, a.fetched, a.list, a.pattern, len(string_split(a.pattern, '.')) AS n
  FROM asked a ASOF JOIN entries e ON a.list = e.list AND a.pattern = e.pattern AND a.fetched >= e.since WHERE e.is_on = 1),
verdicts AS (
  SELECT host, fetched, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
    max({'n': n, 'p': pattern}) FILTER (list <> 'allow') AS block, max(n) FILTER (list = 'allow') AS allow_n
  FROM active GROUP BY ALL)
SELECT c.page_id, c.url, c.host, strftime(c.fetched, '%Y-%m-%d %H:%M:%S.%f') AS fetched_at, coalesce(v.lists, '') AS lists,
  v.block.p AS pattern, coalesce(v.block IS NOT NULL AND (v.allow_n IS NULL OR v.allow_n < v.block.n), false) AS blocked
FROM captures c LEFT JOIN verdicts v ON v.host = c.host AND v.fetched = c.fetched
"""

_OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
firsts AS (SELECT text, min(doc_id) AS lowest FROM d GROUP BY text),
labelled AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
flags AS (SELECT part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
    100 * length(regexp_replace(d.text, '[^A-Z]+', '', 'g')) > 3 * length(d.text) AS c,
    regexp_matches(d.text, '[#$%&*|]') AS d, coalesce(d.doc_id > lowest, false) AS e,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d JOIN firsts USING (text) LEFT JOIN labelled USING (doc_id)),
counts AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails,
    count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM flags GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31
    AND len(list_distinct([v.bit, w.bit, x.bit, y.bit, z.bit])) = 5),
steps AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
taken AS (SELECT part, filter_order, step, own,
    sum(n) FILTER (fails & (earlier | own) = 0) AS kept, sum(n) FILTER (fails & own > 0 AND fails & earlier = 0) AS removed,
    sum(n) FILTER (fails & own > 0 AND fails & earlier > 0) AS redundant, sum(n) FILTER (fails = own) AS unique_fails,
    sum(good) FILTER (fails & own > 0 AND fails & earlier = 0) AS good_lost,
    sum(toxic) FILTER (fails & own > 0 AND fails & earlier = 0) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM taken
"""

ORACLE_SQL = {"op3_url_lists": _OP3, "op1_quality_rules": _OP1, "op12_filter_audit": _OP12}
