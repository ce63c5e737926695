"""DuckDB text of the host quality query."""

from __future__ import annotations

from panelforge.llm.common import WORD_PATTERN
from panelforge.llm.quality_hosts import MAX_HOST_RATE, MAX_REPEATED_PERCENT, MIN_WORDS, STRONGEST_PRIOR


def sql() -> str:
    return f"""
WITH numbered AS (
  SELECT row_number() OVER () AS row, doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}') AS w FROM documents),
triples AS (
  SELECT row, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t
  FROM (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM numbered) WINDOW o AS (PARTITION BY row ORDER BY i)),
again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, t) AS n FROM triples WHERE t IS NOT NULL) WHERE n > 1),
repeated AS (SELECT row, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row),
lines AS (
  SELECT row, count(*) - count(DISTINCT line) AS n FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM numbered)
  WHERE regexp_matches(line, '{WORD_PATTERN}') GROUP BY row),
measured AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM numbered LEFT JOIN lines l USING (row) LEFT JOIN repeated r USING (row)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM measured),
hosts AS (SELECT host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM judged GROUP BY host),
sums AS (SELECT count(*) AS k, sum(n) AS n, sum(f) / sum(n) AS m, sum(f * f / n) AS ss, sum(n * n) AS nn FROM hosts),
spread AS (SELECT *, CASE WHEN n - nn / n > 0 THEN ((ss - n * m * m) - (k - 1) * m * (1 - m)) / (n - nn / n) ELSE 0 END AS v FROM sums),
strength AS (SELECT *, CASE WHEN v <= 0 THEN {STRONGEST_PRIOR} ELSE least({STRONGEST_PRIOR}, greatest(m * (1 - m) / v - 1, 0.01)) END AS s FROM spread),
prior AS (
  SELECT CASE WHEN m <= 0 OR m >= 1 THEN m * {STRONGEST_PRIOR} + 0.5 ELSE m * s END AS a,
         CASE WHEN m <= 0 OR m >= 1 THEN (1 - m) * {STRONGEST_PRIOR} + 0.5 ELSE (1 - m) * s END AS b FROM strength),
rates AS (SELECT host, (f + a) / (n + a + b) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= {MAX_HOST_RATE} AS kept, round(rate, 6)::DOUBLE AS host_failure_rate
FROM judged JOIN rates USING (host)
"""
