"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from .url_filter import MULTI_SUFFIXES

#: Lines with a word, normalised; one row for each written line. %s: a further way to be over the limit.
_LINES = r"""
docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
written AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n FROM docs),
normal AS (
  SELECT *, trim(regexp_replace(lower(line), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS norm FROM written),
totals AS (SELECT source, count(*) AS pages FROM docs GROUP BY source),
shared AS (
  SELECT n.source, n.norm
  FROM (SELECT source, norm, count(DISTINCT doc_id) AS c FROM normal WHERE norm <> '' GROUP BY ALL) n
  JOIN totals t ON n.source IS NOT DISTINCT FROM t.source
  WHERE c >= 5 AND (c > t.pages * 0.08%s)),
marked AS (
  SELECT n.*, s.norm IS NOT NULL AS dropped
  FROM normal n LEFT JOIN shared s ON n.source IS NOT DISTINCT FROM s.source AND n.norm = s.norm)
"""

_OP8 = rf"""
WITH {_LINES % " OR c > 1000"},
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, w FROM w),
tri AS (
  SELECT doc_id, n_words, unnest(generate_series(1, n_words - 2)) AS p, w FROM base WHERE n_words > 2),
keyed AS (SELECT doc_id, p, [w[p], w[p + 1], w[p + 2]] AS k FROM tri),
again AS (SELECT doc_id, p FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) v(o) GROUP BY doc_id),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM written
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
removed AS (
  SELECT doc_id, sum(len(string_split(norm, ' '))) AS removed_words FROM marked WHERE dropped GROUP BY doc_id),
j AS (
  SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM base LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN removed USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM j)
SELECT *, NOT base_failed AND 100 * removed_words <= 50 * n_words AS kept FROM f
"""

_OP10 = f"""
WITH {_LINES % ""},
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped) AS kept,
         count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE n_lines END::BIGINT AS n_lines,
       n_dropped::BIGINT AS n_dropped,
       CASE WHEN n_dropped = 0 THEN d.text ELSE coalesce(kept, '') END AS text
FROM documents d JOIN kept USING (doc_id)
"""




def _strength(units: str) -> str:
    """One row (p, c): mean and strength of the prior over units, by the method of moments."""
    return f"""
  SELECT p, CASE WHEN coalesce(n, 0) = 0 THEN 1.0 WHEN m < 2 OR p * (1 - p) = 0 OR room <= 0 THEN 1e4
            ELSE (1 - spread) / spread END AS c
  FROM (SELECT *, least(greatest((kk - n * p * p - p * (1 - p) * (m - 1)) / nullif(p * (1 - p) * room, 0), 1e-4), 0.99)
               AS spread
        FROM (SELECT *, n - nn / n - m + 1 AS room
              FROM (SELECT count(*) AS m, sum(n) AS n, coalesce(sum(k) / sum(n), 0.0) AS p, sum(k * k / n) AS kk,
                           sum(n::DOUBLE * n) AS nn FROM {units} WHERE n > 0)))"""


_OP6 = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
own AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
known AS (
  SELECT doc_id::VARCHAR AS ref, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY 1),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site FROM own),
hosts AS (
  SELECT site, count(bad) AS n, coalesce(sum(bad), 0) AS k,
         array_to_string(string_split(site, '.')[-2:], '.') AS last2,
         array_to_string(string_split(site, '.')[-1:], '.') AS last1,
         array_to_string(string_split(site, '.')[-3:], '.') AS last3
  FROM named LEFT JOIN known ON known.ref = regexp_extract(path, '^/[a-z]{{2}}/(\d+)(?:[./].*)?$', 1) GROUP BY site),
h AS (
  SELECT site, n, k, CASE WHEN multi THEN last3 ELSE last2 END AS domain, CASE WHEN multi THEN last2 ELSE last1 END AS suffix
  FROM (SELECT *, last2 IN {tuple(MULTI_SUFFIXES)} AS multi FROM hosts)),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
ps AS ({_strength('s')}), pd AS ({_strength('d')}), ph AS ({_strength('h')}),
sr AS (SELECT suffix, (k + ps.p * ps.c) / (n + ps.c) AS rate FROM s, ps),
dr AS (SELECT domain, suffix, (k + rate * pd.c) / (n + pd.c) AS rate FROM d JOIN sr USING (suffix), pd),
hr AS (SELECT site, n, k, n + ph.c AS total, (k + rate * ph.c) / (n + ph.c) AS rate FROM h JOIN dr USING (domain, suffix), ph),
rep AS (SELECT *, rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) AS bound FROM hr),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN bound > 0.4 THEN 'block' ELSE 'allow' END AS verdict,
       n::BIGINT AS n_outcomes, k::BIGINT AS n_bad, round(rate, 6) AS bad_rate, round(bound, 6) AS bad_bound
FROM ruled JOIN rep USING (site)
"""


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP12 = f"""
WITH tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
weight AS (
  SELECT item_id, term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM asked JOIN df USING (term), total),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM weight JOIN tf USING (term) JOIN size USING (doc_id), total GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filter": _OP6, "op8_quality_rules": _OP8, "op10_line_dedup": _OP10, "op12_lexical_search": _OP12}
