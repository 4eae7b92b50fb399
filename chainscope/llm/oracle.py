"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from chainscope.llm.quality_rules import BOILERPLATE, MENU_WORDS, SYMBOLS

_WS = r"[\x20\x09-\x0D]"

LINE_QUALITY = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents),
words AS (
    SELECT rid, list_filter(regexp_split_to_array(t, '{_WS}+'), lambda x: x <> '') AS w FROM d),
positions AS (
    SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words),
windows AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM positions),
repeats AS (
    SELECT rid, count(DISTINCT j) AS n_repeat_words
    FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY rid),
lines AS (
    SELECT rid, x, length(regexp_replace(x, '{_WS}', '', 'g')) AS chars,
           len(list_filter(regexp_split_to_array(x, '{_WS}+'), lambda y: y <> '')) AS n,
           length(x) - length(translate(x, '{SYMBOLS}', '')) AS symbols,
           length(x) - length(translate(x, '|»›', '')) AS bars,
           chars - length(regexp_replace(regexp_replace(x, '(?i)(?:{"|".join(BOILERPLATE)})', '', 'g'),
               '{_WS}', '', 'g')) AS phrases
    FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d)),
failed AS (
    SELECT rid, sum(chars) AS lost, count(*) AS n FROM lines
    WHERE chars > 0 AND NOT (
        (n >= 6 OR regexp_matches(x, '[.!?:;,…。！？"'')»”]'))
        AND symbols <= CAST(0.3 AS DOUBLE) * chars
        AND NOT (bars >= 2 AND n <= 3 * (bars + 1))
        AND NOT regexp_matches(x, '(?i)^{_WS}*(?:(?:{"|".join(MENU_WORDS)}){_WS}*)+$')
        AND NOT (phrases > 0 AND phrases >= CAST(0.3 AS DOUBLE) * chars))
    GROUP BY rid),
dups AS (
    SELECT rid, count(*) - count(DISTINCT x) AS n FROM lines WHERE chars > 0 GROUP BY rid),
counts AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
           CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(failed.n, 0) AS BIGINT) AS n_lines_removed,
           CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
    FROM d JOIN words USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN failed USING (rid)
        LEFT JOIN dups USING (rid)),
verdicts AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 2 * lost_chars <= word_chars AS kept, n_lines_removed, lost_chars
FROM verdicts
"""

ORACLE = {"op9_line_quality": LINE_QUALITY}
