"""Query of the quality ledger and its SQL twin."""

from harrow.llm.quality import POLICIES, RULES, DEFAULT_POLICY, apply_policy, quality_ledger
from harrow.llm.registry import register, table

_FAIL = " OR ".join(f"({cond})" for name, cond in RULES if name in POLICIES[DEFAULT_POLICY])
SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), pos AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3
), win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM pos
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE c >= 2) AS x
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) AS x
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, CAST(sum(c) AS BIGINT) AS n_lines, CAST(sum(c - 1) AS BIGINT) AS n_dup_lines
  FROM (SELECT doc_id, l, count(*) AS c FROM lines GROUP BY doc_id, l) AS x GROUP BY doc_id
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bangs
  FROM d LEFT JOIN dup ON dup.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR {_FAIL}) AS kept
FROM m
"""


@register("op5_quality_rules", SQL)
def op5_quality_rules(spark, sf_dir):
    ledger = apply_policy(quality_ledger(table(spark, sf_dir, "documents")))
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")
