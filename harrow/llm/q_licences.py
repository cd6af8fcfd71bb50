"""Query of the licence scan and its SQL twin.

``documents`` has no paths, so they follow from the id: directories by thousands, hundreds
and tens, and the first file of each directory is its licence file."""

from pyspark.sql import functions as F

from harrow.llm.licences import TEMPLATES, THRESHOLD, scan_licences
from harrow.llm.registry import register, table

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_PATH = """CASE WHEN doc_id % 1000 = 0 THEN concat('/', doc_id {div} 1000, '/LICENSE')
     WHEN doc_id % 100 = 0 THEN concat('/', doc_id {div} 1000, '/', doc_id {div} 100, '/LICENSE')
     WHEN doc_id % 10 = 0 THEN concat('/', doc_id {div} 1000, '/', doc_id {div} 100, '/', doc_id {div} 10, '/LICENSE')
     ELSE concat('/', doc_id {div} 1000, '/', doc_id {div} 100, '/', doc_id {div} 10, '/file', doc_id, '.txt') END"""


def _sql() -> str:
    values = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''"))
                       for i, (name, text) in enumerate(TEMPLATES))
    return rf"""
WITH tpl(i, name, t) AS (VALUES {values}),
tt AS (SELECT i, name, term, count(*) AS tf FROM (
  SELECT i, name, unnest(regexp_extract_all(translate(t, {_LOWER}), '{_TERM}')) AS term FROM tpl) AS x
  GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM tt),
d AS (SELECT doc_id, {_PATH.format(div='//')} AS path,
             translate(coalesce(text, ''), {_LOWER}) AS t FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l,
                 generate_subscripts(string_split(t, chr(10)), 1) AS u FROM d),
lt AS (SELECT doc_id, u, term, count(*) AS tf FROM (
  SELECT doc_id, u, unnest(regexp_extract_all(l, '{_TERM}')) AS term FROM lines) AS x GROUP BY ALL),
wt AS (SELECT doc_id, CAST(0 AS BIGINT) AS u, term, CAST(sum(tf) AS BIGINT) AS tf FROM lt
       GROUP BY doc_id, term),
ut AS (SELECT * FROM lt UNION ALL SELECT * FROM wt),
n AS (SELECT count(*) AS n FROM documents),
idf AS (SELECT v.term, ln((1.0 + (SELECT n FROM n)) / (1 + count(wt.doc_id))) AS idf
        FROM vocab AS v LEFT JOIN wt ON wt.term = v.term GROUP BY v.term),
norm AS (SELECT doc_id, u, sqrt(sum(pow(tf * coalesce(idf, ln(1.0 + (SELECT n FROM n))), 2))) AS norm
         FROM ut LEFT JOIN idf ON idf.term = ut.term GROUP BY doc_id, u),
tnorm AS (SELECT i, sqrt(sum(pow(tf * idf, 2))) AS norm FROM tt JOIN idf ON idf.term = tt.term GROUP BY i),
dots AS (SELECT ut.doc_id, ut.u, tt.i, tt.name, sum(ut.tf * tt.tf * idf.idf * idf.idf) AS dot
         FROM ut JOIN tt ON tt.term = ut.term JOIN idf ON idf.term = ut.term GROUP BY ALL),
best AS (SELECT dots.doc_id, name, round(max(dot / norm.norm / tnorm.norm), 9) AS score
         FROM dots JOIN norm ON norm.doc_id = dots.doc_id AND norm.u = dots.u
         JOIN tnorm ON tnorm.i = dots.i WHERE norm.norm > 0 GROUP BY dots.doc_id, name),
own AS (SELECT doc_id, name, score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name) AS r FROM best
  WHERE score >= {THRESHOLD}) AS x WHERE r = 1),
f AS (SELECT d.doc_id, d.path, regexp_extract(d.path, '^(.*)/[^/]*$', 1) AS dir, own.name, own.score
      FROM d LEFT JOIN own ON own.doc_id = d.doc_id),
places AS (SELECT dir, name FROM (SELECT dir, name, row_number() OVER (
  PARTITION BY dir ORDER BY score DESC, name) AS r FROM f
  WHERE name IS NOT NULL AND path LIKE '%/LICENSE') AS x WHERE r = 1),
near AS (SELECT f.doc_id, p.dir, p.name, row_number() OVER (
  PARTITION BY f.doc_id ORDER BY length(p.dir) DESC) AS r
  FROM f JOIN places AS p ON starts_with(f.dir || '/', p.dir || '/'))
SELECT f.doc_id, f.path, f.name AS own_licence, round(f.score, 6) AS own_score,
       coalesce(f.name, near.name) AS licence,
       CASE WHEN f.name IS NULL THEN near.dir END AS licence_from
FROM f LEFT JOIN near ON near.doc_id = f.doc_id AND near.r = 1
"""


@register("op7_licence_scan", _sql())
def op7_licence_scan(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.expr(_PATH.format(div="div")).alias("path"))
    return scan_licences(files, keep=("doc_id",)).select(
        "doc_id", "path", "own_licence", F.round("own_score", 6).alias("own_score"), "licence",
        "licence_from")
