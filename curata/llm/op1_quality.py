"""op1: the quality rules over every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import quality
from curata.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines")


QUERIES = {"op1_quality": op1_quality}

_WS = r"[\x20\x09-\x0D]"
SQL = {
    "op1_quality": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
g AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o] AS g, lead(word, 2) OVER o IS NOT NULL AS full_window FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, full_window AND count(*) OVER (PARTITION BY doc_id, g, full_window) > 1 AS twice FROM g),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS i FROM r, (VALUES (0), (1), (2)) v(k) WHERE twice) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
f AS (
  SELECT doc_id, line, length(regexp_replace(line, '{_WS}', '', 'g')) AS chars,
    length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) * 10 > length(line)
    OR length(line) - length(replace(line, '|', '')) >= 3
    OR length(line) - length(replace(line, '!!', '!')) >= 3
    OR (NOT regexp_matches(line, '[.!?:;…。！？]["''”“’‘»«›‹)\]]*{_WS}*$') AND length(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) < 10)
    OR (length(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) < {quality.NOTICE_WORDS} AND regexp_matches(line, '(?i){quality.BOILERPLATE}')) AS fails
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
s AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dups, count(*) FILTER (WHERE fails) AS failed, coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost FROM f GROUP BY doc_id),
a AS (
  SELECT d.doc_id, length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words, length(regexp_replace(text, '{_WS}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(failed, 0) AS n_failed_lines, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5 * word_chars AS kept, CAST(n_failed_lines AS BIGINT) AS n_failed_lines
FROM a"""
}
