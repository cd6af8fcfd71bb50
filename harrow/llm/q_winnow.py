"""Query of the winnowing operator and its SQL twin."""

from pyspark.sql import functions as F

from harrow.llm.registry import register, table
from harrow.llm.winnow import contamination

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS t FROM (
    SELECT item_id, w, least(10, len(w)) AS size,
           unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) AS x
), sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS t FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM d, sizes WHERE len(w) >= size) AS x
), hit AS (
  SELECT dw.doc_id, dw.size, dw.i, bw.item_id FROM dw JOIN bw ON bw.t = dw.t AND bw.size = dw.size
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) AS x GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) AS x GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""


@register("op6_benchmark_decontamination", SQL)
def op6_benchmark_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")
