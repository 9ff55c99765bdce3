"""DuckDB SQL of the operators that SQL can express."""

ORACLE: dict[str, str] = {}

# Tempered target weights, the Poisson distribution by its log-gamma form, inverted at the hashed number.
ORACLE["op3_mixing"] = """
WITH size AS (SELECT source, CAST(SUM(strlen(COALESCE(text, ''))) AS DOUBLE) AS bytes FROM documents GROUP BY source),
share AS (SELECT source, bytes, sqrt(bytes) / SUM(sqrt(bytes)) OVER () * SUM(bytes) OVER () AS wanted FROM size),
rate AS (SELECT source, CASE WHEN bytes > 0 THEN wanted / bytes END AS m FROM share),
mass AS (SELECT source, k, exp(-m + k * ln(m) - lgamma(k + 1)) AS p
         FROM rate, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(m + 12 * sqrt(m) + 30) AS BIGINT))) AS k)
         WHERE m > 0),
below AS (SELECT source, k, SUM(p) OVER (PARTITION BY source ORDER BY k) AS c FROM mass),
drawn AS (SELECT row_number() OVER () AS r, *,
                 CAST('0x' || substr(md5('mix-1:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)
                 / 281474976710656.0 AS u FROM documents),
counted AS (SELECT d.r, COUNT(b.k) AS copies FROM drawn d
            LEFT JOIN below b ON b.source IS NOT DISTINCT FROM d.source AND b.c <= d.u GROUP BY d.r),
kept AS (SELECT d.*, CASE WHEN t.m IS NULL THEN 1 ELSE n.copies END AS copies
         FROM drawn d JOIN counted n USING (r) JOIN rate t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(generate_series(1, copies)) AS INTEGER) AS copy
FROM kept WHERE copies > 0
"""

# Windows as text, for each length that a window has.
ORACLE["op7_decontamination"] = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id,
       regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id,
       regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
asked AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + 12), ' ') AS s
          FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM item WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM asked),
found AS (SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
          FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, lengths WHERE len(w) >= n)),
hit AS (SELECT f.r, f.i, f.n, a.item_id FROM found f JOIN asked a ON a.n = f.n AND a.s = f.s),
covered AS (SELECT r, COUNT(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, COUNT(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

ORACLE["op10_warc"] = """
WITH page AS (SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes,
                     sha1(COALESCE(html, '')) AS payload_digest FROM pages),
kept AS (SELECT payload_digest, MAX(page_id) AS last FROM page WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM page LEFT JOIN kept USING (payload_digest)
"""

# Flags as a list, counted per part and list; then each of the 600 steps against each list.
ORACLE["op12_filter_audit"] = r"""
WITH doc AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t,
                    regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
earliest AS (SELECT t, MIN(doc_id) AS least FROM doc GROUP BY t),
label AS (SELECT doc_id, MAX(quality) AS quality, MAX(toxic) AS toxic FROM labels GROUP BY doc_id),
failed AS (SELECT part, quality, toxic,
                  [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                   100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
                   COALESCE(doc.doc_id > least, FALSE)] AS f
           FROM doc JOIN earliest USING (t) LEFT JOIN label ON label.doc_id = doc.doc_id),
alike AS (SELECT part, f, COUNT(*) AS n, COUNT(*) FILTER (quality = 1) AS good, COUNT(*) FILTER (toxic = 1) AS toxic
          FROM failed GROUP BY part, f),
letter AS (SELECT unnest(generate_series(1, 5)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letter a, letter b, letter c, letter d, letter e
           WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT array_to_string([chr(CAST(64 + x AS INTEGER)) for x in o], '') AS filter_order, step,
                 o[step] AS i, o[1:step - 1] AS before
          FROM orders, (SELECT unnest(generate_series(1, 5)) AS step)),
met AS (SELECT part, filter_order, step, i, f[i] AS fails, len([x for x in before if f[x]]) > 0 AS gone,
               len([x for x in f if x]) = 1 AS once, n, good, toxic FROM alike, steps),
counted AS (SELECT part, filter_order, step, i,
       SUM(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
       SUM(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
       SUM(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
       SUM(CASE WHEN fails AND once THEN n ELSE 0 END) AS unique_fails,
       SUM(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
       SUM(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM counted
"""
