"""SQL for the numbered operators that SQL can express, written from their definitions."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS}) AS size,
         ('0x' || substr(md5('17/' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
), levels AS (  -- what a unit of weight gets when the sources with a smaller limit per weight are full
  SELECT a.w, 2.0::DOUBLE * a.source_size / a.w AS ratio,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
          - coalesce((SELECT sum(2.0::DOUBLE * b.source_size) FROM s b WHERE 2.0::DOUBLE * b.source_size / b.w < 2.0::DOUBLE * a.source_size / a.w), 0.0))
         / (SELECT sum(b.w) FROM s b WHERE 2.0::DOUBLE * b.source_size / b.w >= 2.0::DOUBLE * a.source_size / a.w) AS level
  FROM s a
), t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, coalesce((SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio) * w, 2.0::DOUBLE * source_size)) AS target
  FROM s
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t
), c AS (
  SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h) AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), best AS (
  SELECT source, arg_min(h, (dist, upto, h)) AS cut FROM (
    SELECT source, h, upto, abs(upto - rest) AS dist FROM c WHERE rest > 0
    UNION ALL SELECT DISTINCT source, -1, 0, rest FROM c WHERE rest > 0
  ) GROUP BY source
)
SELECT c.doc_id, c.size, c.source_size, c.target,
       (c.size * (c.passes + CASE WHEN c.h <= coalesce(b.cut, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c LEFT JOIN best b ON c.source IS NOT DISTINCT FROM b.source
"""

HOST_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents
), tri AS (
  SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM tri) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY r
), ln AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT d.r, doc_id, source, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN ln ON d.r = ln.r
), f AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 10 * n_symbols > n_words AS f3,
         10 * n_dup_lines > 3 * n_lines AS f4,
         n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words) AS f5
  FROM m
), h AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS k
  FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([f1, f2, f3, f4, f5]) AS failed FROM f)
  WHERE source IS NOT NULL GROUP BY source, rule
), prior AS (
  SELECT rule, sum(k) / sum(n) AS mean, greatest(sum(k * (k / n)) / sum(n) - (sum(k) / sum(n)) ** 2, 1e-12) AS v FROM h GROUP BY rule
), bad AS (
  SELECT DISTINCT source FROM (
    SELECT source, k, n, mean, least(greatest(mean * (1 - mean) / v - 1, 1), 1e6) AS wt FROM h JOIN prior USING (rule)
  ) WHERE (k + wt * mean) / (n + wt) > 0.5
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2) AND coalesce(source NOT IN (SELECT source FROM bad), true) AS kept
FROM f
"""

LINE_SPREAD = r"""
WITH ln AS (
  SELECT r, doc_id, source, i, string_split(text, chr(10))[i] AS raw,
         trim(string_split(text, chr(10))[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS l
  FROM (SELECT row_number() OVER () AS r, *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), bad AS (
  SELECT l, min({'d': doc_id, 'i': i}) AS first FROM ln WHERE l <> '' GROUP BY l HAVING count(DISTINCT source) >= 3
), kept AS (
  SELECT ln.*, bad.l IS NOT NULL AND {'d': doc_id, 'i': i} <> bad.first AS gone FROM ln LEFT JOIN bad ON ln.l = bad.l
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
       md5(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS clean_md5
FROM kept GROUP BY r, doc_id
"""
