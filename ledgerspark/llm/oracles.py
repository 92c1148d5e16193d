"""SQL of the queries for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from ledgerspark.llm.license_scan import TEMPLATES

OP8 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm,
    min(doc_id) OVER (PARTITION BY norm) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS place
  FROM t)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

OP7 = r"""
WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT page_id, payload, octet_length(payload) AS n,
  min(page_id) OVER (PARTITION BY payload) AS first_id FROM t)
SELECT page_id, n AS payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN n >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g
"""

OP9 = r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT k, doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN
    [array_to_string(ws, ' ')]
    ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] END) AS g
  FROM t),
e AS (SELECT k, len(g) AS n, unnest(g) AS x FROM s),
o AS (
  SELECT a.k AS a, b.k AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM e AS a JOIN e AS b ON a.x = b.x AND a.k <> b.k GROUP BY a.k, b.k),
l AS (SELECT a, b FROM o WHERE 100 * shared >= 90 * (na + nb - shared)),
reach(k, r) AS (
  SELECT k, k FROM s UNION SELECT reach.k, l.b FROM reach JOIN l ON l.a = reach.r),
c AS (SELECT reach.k, min(s.doc_id) AS component_id FROM reach JOIN s ON s.k = reach.r GROUP BY reach.k)
SELECT doc_id, len(g) AS n_shingles, component_id FROM s JOIN c USING (k)
"""

# Lines without words, or without a fault: the reverse of what the line rules remove.
OP6 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
w AS (
  SELECT doc_id, body, ws, len(ws) AS n,
    [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] AS wins,
    [x FOR x IN string_split(body, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM t),
found AS (
  SELECT k, win, i FROM (
    SELECT row_number() OVER () AS k, wins FROM w), unnest(wins) WITH ORDINALITY AS u(win, i)),
twice AS (SELECT k, win FROM found GROUP BY k, win HAVING count(*) > 1),
covered AS (
  SELECT k, count(DISTINCT i + d) AS n_repeat
  FROM found JOIN twice USING (k, win), range(0, 3) AS r(d) GROUP BY k),
judged AS (
  SELECT row_number() OVER () AS k, doc_id, body, n, lines, [x FOR x IN lines IF
      len(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))
        <= len(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) * 0.1
      AND len(regexp_extract_all(x, '[!?]{2}([\x20\x09-\x0D]|$)'))
        <= len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) * 0.5
      AND NOT (len(regexp_replace(x, '[^|»›•>]', '', 'g')) >= 2
        AND len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))
          - len(regexp_replace(x, '[^|»›•>]', '', 'g'))
          <= (len(regexp_replace(x, '[^|»›•>]', '', 'g')) + 1) * 3)
      AND NOT (len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) <= 40 AND regexp_matches(lower(x),
        'accept all cookies|accept cookies|cookie policy|enable javascript|javascript is disabled|'
        || 'javascript is required|lorem ipsum|privacy policy|skip to content|'
        || 'subscribe to our newsletter|terms of service|terms of use|we use cookies'))
    ] AS good
  FROM w),
counts AS (
  SELECT doc_id, n AS n_words,
    len(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))
      - len(regexp_replace(array_to_string(good, ''), '[\x20\x09-\x0D]', '', 'g')) AS lost_chars
  FROM judged LEFT JOIN covered USING (k))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND lost_chars <= word_chars * 0.5 AS kept
FROM counts
"""



def _op4(rounds: int = 130, damping: float = 0.85) -> str:
    """Rules as a table; each ranking is the sum of what moves in each round."""
    url_parts = r"""
WITH RECURSIVE u AS (
  SELECT page_id, html, instr(url, '://') AS place, substr(url, instr(url, '://') + 3) AS rest FROM pages),
p AS (
  SELECT page_id, coalesce(html, '') AS html,
    CASE WHEN place > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN place > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM u),
rules(rhost, rpath, said) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT p.*, (SELECT max_by({'rule': rhost || rpath, 'said': said}, len(rhost || rpath)) FROM rules
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
  FROM p),
l AS (
  SELECT host AS src, regexp_extract_all(html,
    '(?i)<a\s[^>]*?href\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?(?://[^/?#"''\s>]*)?)', 1) AS links FROM p),
d AS (
  SELECT src, unnest(list_distinct([CASE WHEN regexp_matches(x, '(?i)^(https?:)?//')
      THEN translate(regexp_extract(x, '//(.*)$', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      WHEN x = '' THEN '' END FOR x IN links])) AS link FROM l),
e AS (
  SELECT src, CASE WHEN link = '' THEN src ELSE link END AS dst, count(*) AS n FROM d
  WHERE src <> '' AND link IS NOT NULL GROUP BY 1, 2),
f AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM e),
b AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY dst) AS w FROM e),
c AS (SELECT host, count(*) FILTER (best.said = 'allow') AS a, count(*) FILTER (best.said = 'block') AS d
  FROM m WHERE host <> '' GROUP BY host),
s AS (SELECT host, coalesce(a / nullif((SELECT sum(a) FROM c), 0), 0) AS t,
  coalesce(d / nullif((SELECT sum(d) FROM c), 0), 0) AS d FROM c),
"""
    steps = f"""t(k, host, x) AS (
  SELECT 0, host, t FROM s WHERE t > 0
  UNION ALL SELECT k + 1, dst, sum({damping} * x * w) FROM t JOIN f ON src = host WHERE k < {rounds} GROUP BY k, dst),
r(k, host, x) AS (
  SELECT 0, host, d FROM s WHERE d > 0
  UNION ALL SELECT k + 1, src, sum({damping} * x * w) FROM r JOIN b ON dst = host WHERE k < {rounds} GROUP BY k, src),
trust AS (SELECT host, sum(x) / (SELECT sum(x) FROM t) AS x FROM t GROUP BY host),
distrust AS (SELECT host, sum(x) / (SELECT sum(x) FROM r) AS x FROM r GROUP BY host)"""
    return f"""{url_parts}{steps}
SELECT page_id, m.host, path, best.rule AS rule, coalesce(best.said,
  CASE WHEN coalesce(distrust.x, 0) > 1.000001 * coalesce(trust.x, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN trust ON trust.host = m.host LEFT JOIN distrust ON distrust.host = m.host
"""


def _op5() -> str:
    templates = ",\n  ".join(
        f"('{t.license}', '{t.text}')" for t in TEMPLATES
    )
    return rf"""
WITH notices(license, notice) AS (VALUES
  {templates}),
t AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
  coalesce(text, '') AS body FROM documents),
unit AS (
  SELECT k, unnest(lines) AS u, true AS is_line FROM t
  UNION ALL SELECT k, body, false FROM t WHERE len(lines) > 1),
words AS (
  SELECT k, is_line, regexp_extract_all(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS ws FROM unit),
grams AS (
  SELECT k, is_line, list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) AS g
  FROM words),
wanted AS (
  SELECT license, list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) AS w
  FROM (SELECT license, regexp_extract_all(lower(notice), '[a-z0-9]+') AS ws FROM notices)),
scored AS (
  SELECT k, row_number() OVER () AS unit_id, license, dice FROM (
    SELECT k, g, max({{'dice': 2.0::DOUBLE * len(list_intersect(g, w)) / (len(g) + len(w)), 'license': license}}) AS m
    FROM (SELECT row_number() OVER () AS id, k, g FROM grams WHERE len(g) BETWEEN 1 AND 100), wanted
    WHERE len(list_intersect(g, w)) > 0
    GROUP BY id, k, g), unnest([m.license]) AS a(license), unnest([m.dice]) AS b(dice)
  WHERE dice >= 0.8),
docs AS (
  SELECT k, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
    max({{'dice': dice, 'license': license}}) AS best FROM scored GROUP BY k),
counts AS (SELECT k, count(*) FILTER (is_line AND len(g) > 0) AS n_lines FROM grams GROUP BY k)
SELECT doc_id, n_lines, coalesce(n, 0) AS n_notices, coalesce(licenses, '') AS licenses,
  best.license AS best_license, best.dice AS best_dice
FROM t JOIN counts USING (k) LEFT JOIN docs USING (k)
"""


# Every kept term for every group, and every pair of groups over it.
OP11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
w AS (SELECT k, lang, source, unnest(ws) AS term FROM t),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM t),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (coalesce(total, 0) + v) AS p
  FROM g JOIN kept USING (lang) JOIN sizes USING (lang)
    LEFT JOIN total USING (lang, source) LEFT JOIN c USING (lang, source, term)),
whole AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 1) // (any_value(all_n) + any_value(v)) AS q
  FROM dense JOIN sizes USING (lang)
    JOIN (SELECT lang, sum(total) AS all_n FROM total GROUP BY lang) USING (lang)
  GROUP BY lang, term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense AS a JOIN dense AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q
  FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR place <= 200
"""


ORACLES = {
    "op4_url_filter": _op4(),
    "op5_license_scan": _op5(),
    "op6_quality_rules": OP6,
    "op7_warc_zip": OP7,
    "op8_exact_dedup": OP8,
    "op9_ngram_join": OP9,
    "op11_source_divergence": OP11,
}
