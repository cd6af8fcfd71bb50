"""Query of the mixing operator and its SQL twin (the sweeps unrolled)."""

from pyspark.sql import functions as F

from harrow.llm.mixing import SWEEPS, mix
from harrow.llm.registry import register, table

DIMS = ("source", "lang", "topic")


def _sql() -> str:
    parts = [r"""
r AS (
  SELECT doc_id, source, lang, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
         CASE WHEN instr(t, ' | ') > 0 THEN 'table'
              WHEN length(t) - length(replace(t, chr(10), '')) >= 20 THEN 'long'
              WHEN length(t) - length(replace(t, chr(10), '')) >= 5 THEN 'article'
              ELSE 'note' END AS topic
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents) AS x
)""", """
c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM r GROUP BY 1, 2, 3)"""]
    for d in DIMS:
        parts.append(f"t_{d} AS (SELECT {d}, s / sum(s) OVER () AS share FROM "
                     f"(SELECT {d}, pow(sum(tokens), 0.7) AS s FROM c GROUP BY {d}) AS x)")
    parts.append("x0 AS (SELECT source, lang, topic, tokens, tokens AS mass FROM c)")
    n = 0
    for _ in range(SWEEPS):
        for d in DIMS:
            parts.append(f"x{n + 1} AS (SELECT x.source, x.lang, x.topic, x.tokens, "
                         f"x.mass * t.share / sum(x.mass) OVER (PARTITION BY x.{d}) AS mass "
                         f"FROM x{n} AS x JOIN t_{d} AS t ON t.{d} = x.{d})")
            n += 1
    parts.append(f"w AS (SELECT source, lang, topic, mass * sum(tokens) OVER () / tokens AS weight "
                 f"FROM x{n})")
    parts.append("p AS (SELECT source, lang, topic, weight, weight / max(weight) OVER () "
                 "AS probability FROM w)")
    return "WITH " + ",\n".join(x.strip() for x in parts) + """
SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, round(p.weight, 6) AS weight,
       round(p.probability, 6) AS probability,
       CAST(CAST('0x' || substr(md5(CAST(r.doc_id AS VARCHAR) || '-17'), 1, 13) AS BIGINT) AS DOUBLE)
         / 4503599627370496.0 < p.probability AS sampled
FROM r JOIN p ON p.source = r.source AND p.lang = r.lang AND p.topic = r.topic
"""


@register("op2_source_mixing", _sql())
def op2_source_mixing(spark, sf_dir):
    rows = mix(table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})
