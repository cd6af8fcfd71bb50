"""Query of the lexical search and its SQL twin."""

from harrow.llm.lexical import search
from harrow.llm.registry import register, table

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents),
lens AS (SELECT doc_id, r, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
tot AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lens),
it AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) AS x
       WHERE term IN (SELECT term FROM it) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, tot GROUP BY term, nd),
part AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))) AS s
         FROM tf JOIN w USING (term) JOIN lens USING (r), tot),
sc AS (SELECT item_id, r, CAST(sum(s) AS BIGINT) AS score FROM it JOIN part USING (term)
       GROUP BY item_id, r HAVING sum(s) > 0),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (
             PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank
           FROM sc JOIN lens USING (r))
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@register("op13_lexical_search", SQL)
def op13_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
