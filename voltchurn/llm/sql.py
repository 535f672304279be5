"""DuckDB SQL of the numbered queries that SQL can express."""

LINE_DEDUP = r"""
WITH split_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split_lines),
shared AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.pos, k.line, (s.key IS NOT NULL AND k.doc_id <> s.first_id) AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_STRENGTH = """least(greatest(CASE WHEN sum(n * (n - 1) * m * (1 - m)) > 0 AND
  sum(power(k - n * m, 2) - n * m * (1 - m)) > 0
  THEN 1 / (sum(power(k - n * m, 2) - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m))) - 1
  ELSE 1e6 END, 1.0), 1e6)"""

URL_FILTER = rf"""
WITH src AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN
           substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM src),
cut AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM parts),
named AS (
  SELECT *, string_split(host, '.') AS p,
         array_to_string(list_slice(string_split(host, '.'), -2, NULL), '.') AS two FROM cut),
known AS (
  SELECT doc_id AS page_id, 1 - quality AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL),
hosts AS (
  SELECT host, CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br')
                    THEN array_to_string(list_slice(p, -3, NULL), '.') ELSE two END AS domain,
         CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br') THEN two ELSE p[-1] END AS suffix,
         count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
  FROM named LEFT JOIN known USING (page_id) GROUP BY ALL),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k,
         (SELECT coalesce(sum(k) / nullif(sum(n), 0), 0) FROM hosts) AS m FROM hosts GROUP BY suffix),
s1 AS (SELECT {_STRENGTH} AS s FROM suffixes),
suffix_post AS (SELECT suffix, (s * m + k) / (s + n) AS m FROM suffixes, s1),
domains AS (
  SELECT domain, suffix, sum(n) AS n, sum(k) AS k, any_value(sp.m) AS m
  FROM hosts JOIN suffix_post sp USING (suffix) GROUP BY domain, suffix),
s2 AS (SELECT {_STRENGTH} AS s FROM domains),
domain_post AS (SELECT domain, suffix, (s * m + k) / (s + n) AS m FROM domains, s2),
host_prior AS (SELECT host, n, k, dp.m AS m FROM hosts JOIN domain_post dp USING (domain, suffix)),
s3 AS (SELECT {_STRENGTH} AS s FROM host_prior),
host_beta AS (SELECT host, s * m + k AS a, s * (1 - m) + n - k AS b, (s * m + k) / (s + n) AS post FROM host_prior, s3),
bounds AS (
  SELECT host, post - 1.6448536269514722 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM host_beta),
ruled AS (
  SELECT c.page_id, c.host, c.path, b.low,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM cut c LEFT JOIN bounds b USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN low > 0.3 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

FILTER_AUDIT = r"""
WITH src AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM src GROUP BY t),
flagged AS (
  SELECT part,
    len(words) < 200 AS a,
    100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    doc_id > first_id AS e,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = s.doc_id AND l.quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = s.doc_id AND l.toxic = 1) AS toxic
  FROM src s JOIN firsts USING (t)),
failing AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
       || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM flagged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS o FROM letters p, letters q, letters r, letters s, letters u
  WHERE p.x NOT IN (q.x, r.x, s.x, u.x) AND q.x NOT IN (r.x, s.x, u.x) AND r.x NOT IN (s.x, u.x) AND s.x <> u.x),
steps AS (SELECT o, k, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS before FROM orders, range(1, 6) t(k)),
counted AS (
  SELECT part, o, k, f,
    sum(n) FILTER (WHERE NOT early AND NOT hit) AS kept,
    sum(n) FILTER (WHERE NOT early AND hit) AS removed,
    sum(n) FILTER (WHERE early AND hit) AS redundant,
    sum(n) FILTER (WHERE fails = f) AS unique_fails,
    sum(n_good) FILTER (WHERE NOT early AND hit) AS good_lost,
    sum(n_toxic) FILTER (WHERE NOT early AND hit) AS toxic_lost
  FROM (SELECT *, contains(fails, f) AS hit, before <> '' AND translate(fails, before, '') <> fails AS early FROM failing, steps)
  GROUP BY ALL)
SELECT part, o AS filter_order, k::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""

RANKED_SEARCH = r"""
WITH doc_term AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents) GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM doc_term GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM doc_term, total GROUP BY term, n_docs),
item_term AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item_term JOIN weights USING (term) JOIN doc_term USING (term) JOIN lengths USING (doc_id), total
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
