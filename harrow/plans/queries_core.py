"""Queries for columns (P), cleaning (P5-P7), profiling (A) and J3 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import columns as C
from harrow.operators import clean as CL
from harrow.operators import profile as A
from harrow.plans import fixtures as FX
from harrow.plans.catalog import register, with_ctes

RAW = FX.RAW_TRACKS_CTE
CLEAN = FX.CLEAN_TRACKS_CTE
LAB = FX.LABELLED_CTE
FEATURES = ["energy", "danceability", "loudness", "tempo"]
PARSE = FX.PARSE_DATE_SQL.format(c="first_week")


def _raw(spark, sf):
    return FX.raw_tracks(spark, sf)


def _lab(spark, sf):
    return FX.labelled_tracks(spark, sf)


# --- P ---------------------------------------------------------------------

@register("p01_add_label", with_ctes(RAW) + """
SELECT track_key, popularity, CAST(coalesce(popularity >= 400000.0, false) AS INTEGER) AS hit
FROM raw_tracks""", doubles=["popularity"])
def p01_add_label(spark, sf):
    return C.add_label(_raw(spark, sf), "popularity", FX.LABEL_THRESHOLD).select(
        "track_key", "popularity", "hit")


@register("p02_resolve_label", with_ctes(RAW) + """
SELECT track_key, popularity AS track_popularity,
       CAST(coalesce(popularity >= 400000.0, false) AS INTEGER) AS hit
FROM raw_tracks""", doubles=["track_popularity"])
def p02_resolve_label(spark, sf):
    df = _raw(spark, sf).withColumnRenamed("popularity", "track_popularity")
    return C.resolve_label(df, threshold=FX.LABEL_THRESHOLD).select(
        "track_key", "track_popularity", "hit")


@register("p03_select_features", with_ctes(LAB) + """
SELECT tempo, energy, danceability, loudness, genre, hit FROM labelled""",
          doubles=["tempo", "energy", "danceability", "loudness"])
def p03_select_features(spark, sf):
    return C.select_features(_lab(spark, sf))


@register("p05_parse_mixed_dates", with_ctes(RAW) + f"""
SELECT track_key, first_week, CAST({PARSE} AS DATE) AS parsed FROM raw_tracks""")
def p05_parse_mixed_dates(spark, sf):
    df = _raw(spark, sf)
    return df.select("track_key", "first_week",
                     F.to_date(C.parse_mixed_dates("first_week", FX.DATE_FORMATS)).alias("parsed"))


@register("p06_clean", with_ctes(CLEAN) + """
SELECT * REPLACE (CAST(first_week AS DATE) AS first_week) FROM clean_tracks""",
          doubles=["popularity", "acctbal"] + FEATURES)
def p06_clean(spark, sf):
    df = CL.clean(_raw(spark, sf), "first_week", FX.NOW, FX.DATE_FORMATS)
    return df.withColumn("first_week", F.to_date("first_week"))


@register("p07_cleaning_report", with_ctes(RAW) + f""",
g AS (SELECT *, count(*) AS n FROM raw_tracks GROUP BY ALL),
p AS (SELECT n, {PARSE} AS d FROM g)
SELECT CAST(sum(n) AS BIGINT) AS rows_in,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicates_dropped,
       CAST(count(*) FILTER (WHERE d IS NULL) AS BIGINT) AS unparseable_dates_dropped,
       CAST(count(*) FILTER (WHERE d > {FX.NOW_SQL}) AS BIGINT) AS future_dates_dropped,
       '2000-12-31' AS cutoff,
       strftime(min(d), '%Y-%m-%d') AS date_min_before,
       strftime(max(d), '%Y-%m-%d') AS date_max_before,
       strftime(min(d) FILTER (WHERE d <= {FX.NOW_SQL}), '%Y-%m-%d') AS date_min_after,
       strftime(max(d) FILTER (WHERE d <= {FX.NOW_SQL}), '%Y-%m-%d') AS date_max_after,
       CAST(count(*) FILTER (WHERE d <= {FX.NOW_SQL}) AS BIGINT) AS rows_out,
       CAST(sum(n) - count(*) FILTER (WHERE d <= {FX.NOW_SQL}) AS BIGINT) AS rows_dropped_total
FROM p""")
def p07_cleaning_report(spark, sf):
    return CL.cleaning_report(_raw(spark, sf), "first_week", FX.NOW, FX.DATE_FORMATS)


@register("p09_fill_feature_defaults", with_ctes(LAB) + """,
med AS (SELECT median(energy) AS m0, median(danceability) AS m1, median(loudness) AS m2,
               median(tempo) AS m3 FROM labelled)
SELECT track_key, coalesce(energy, m0) AS energy, coalesce(danceability, m1) AS danceability,
       coalesce(loudness, m2) AS loudness, coalesce(tempo, m3) AS tempo,
       coalesce(genre, '') AS genre, coalesce(segment, '') AS segment
FROM labelled, med""", doubles=FEATURES)
def p09_fill_feature_defaults(spark, sf):
    from harrow.operators.rank import median_map
    lab = _lab(spark, sf)
    defaults = median_map(lab, FEATURES)
    return C.fill_feature_defaults(lab.select("track_key", *FEATURES, "genre", "segment"),
                                   defaults, ["genre", "segment"])


@register("p12_safe_double", """
SELECT event_id,
       CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS k_value,
       TRY_CAST(event_type AS DOUBLE) AS type_value
FROM (SELECT event_id, event_type,
             TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'NaN'
                           WHEN event_id % 11 = 0 THEN 'Infinity'
                           ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS v
      FROM events)""", doubles=["k_value", "type_value"])
def p12_safe_double(spark, sf):
    ev = FX.table(spark, sf, "events")
    text = (F.when(F.col("event_id") % 7 == 0, F.lit("NaN"))
            .when(F.col("event_id") % 11 == 0, F.lit("Infinity"))
            .otherwise(F.get_json_object("props", "$.k")))
    return ev.select("event_id", C.safe_double(text).alias("k_value"),
                     C.safe_double("event_type").alias("type_value"))


PAGE_ID_ARGS = dict(url_marker=".example.com/", url_pattern=r"example\.com/[a-z]+/([A-Za-z0-9]+)",
                    uri_prefix="http://blog.")


@register("p15_extract_id", r"""
WITH p AS (SELECT page_id, trim(coalesce(url, '')) AS v FROM pages)
SELECT page_id,
  CASE WHEN v = '' THEN NULL
       WHEN strpos(v, '.example.com/') > 0
         THEN nullif(regexp_extract(v, 'example\.com/[a-z]+/([A-Za-z0-9]+)', 1), '')
       WHEN starts_with(v, 'http://blog.') THEN string_split(v, ':')[-1]
       WHEN regexp_full_match(v, '[A-Za-z0-9]{22}') THEN v END AS id,
  CASE WHEN v = '' THEN 'empty'
       WHEN strpos(v, '.example.com/') > 0 THEN
         CASE WHEN regexp_extract(v, 'example\.com/[a-z]+/([A-Za-z0-9]+)', 1) = ''
              THEN 'unparseable url' END
       WHEN starts_with(v, 'http://blog.') THEN NULL
       WHEN regexp_full_match(v, '[A-Za-z0-9]{22}') THEN NULL
       ELSE 'invalid' END AS reason
FROM p""")
def p15_extract_id(spark, sf):
    pages = FX.table(spark, sf, "pages")
    ident, reason = C.extract_id("url", **PAGE_ID_ARGS)
    return pages.select("page_id", ident.alias("id"), reason.alias("reason"))


@register("p16_verdict_band", with_ctes(FX.SCORED_CTE) + """
SELECT row_key, y_score,
  CASE WHEN y_score * 100 >= 70 THEN '🔥 BANGER' WHEN y_score * 100 >= 40 THEN '😴 SLEEPER'
       ELSE '💀 FLOP' END AS verdict,
  CAST(y_score >= 0.5 AS INTEGER) AS decision
FROM scored""", doubles=["y_score"])
def p16_verdict_band(spark, sf):
    s = FX.scored(spark, sf)
    return s.select("row_key", "y_score", C.verdict_band("y_score").alias("verdict"),
                    C.decision("y_score").alias("decision"))


@register("p17_coverage_band", """
WITH d AS (SELECT d.source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT source, count(*) FILTER (WHERE quality IS NOT NULL) AS with_value,
             count(*) AS total FROM d GROUP BY source)
SELECT source, with_value, total, 100.0 * with_value / total AS pct,
       CASE WHEN 100.0 * with_value / total >= 50 THEN 'GOOD'
            WHEN 100.0 * with_value / total > 0 THEN 'PARTIAL' ELSE 'ZERO' END AS band
FROM r""", doubles=["pct"])
def p17_coverage_band(spark, sf):
    docs = FX.table(spark, sf, "documents").select("doc_id", "source")
    labels = FX.table(spark, sf, "labels").select("doc_id", "quality")
    j = docs.join(labels, "doc_id", "left")
    r = j.groupBy("source").agg(F.count("quality").alias("with_value"),
                                F.count(F.lit(1)).alias("total"))
    pct = F.col("with_value") * 100.0 / F.col("total")
    return r.select("source", "with_value", "total", pct.alias("pct"),
                    C.coverage_band(pct).alias("band"))


@register("p18_minmax_profile", with_ctes(LAB) + """,
rg AS (SELECT min(energy) AS lo0, max(energy) AS hi0, min(tempo) AS lo1, max(tempo) AS hi1,
              min(loudness) AS lo2, max(loudness) AS hi2 FROM labelled)
SELECT track_key,
  CASE WHEN hi0 <= lo0 THEN 0.0 ELSE least(greatest((coalesce(energy, 0.0) - lo0) / (hi0 - lo0), 0.0), 1.0) END AS energy,
  CASE WHEN hi1 <= lo1 THEN 0.0 ELSE least(greatest((coalesce(tempo, 0.0) - lo1) / (hi1 - lo1), 0.0), 1.0) END AS tempo,
  CASE WHEN hi2 <= lo2 THEN 0.0 ELSE least(greatest((coalesce(loudness, 0.0) - lo2) / (hi2 - lo2), 0.0), 1.0) END AS loudness
FROM labelled, rg""", doubles=["energy", "tempo", "loudness"])
def p18_minmax_profile(spark, sf):
    lab = _lab(spark, sf)
    cols = ["energy", "tempo", "loudness"]
    r = lab.agg(*[F.min(c).alias(f"lo_{c}") for c in cols],
                *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    ranges = {c: (r[f"lo_{c}"], r[f"hi_{c}"]) for c in cols}
    return C.minmax_profile(lab, ranges, keep=["track_key"])


@register("p19_has_any_nonzero", with_ctes(RAW) + """
SELECT track_key, CAST(coalesce(energy, 0.0) != 0 OR coalesce(danceability, 0.0) != 0
       OR coalesce(loudness, 0.0) != 0 OR coalesce(tempo, 0.0) != 0 AS INTEGER) AS has_signal
FROM raw_tracks""")
def p19_has_any_nonzero(spark, sf):
    return _raw(spark, sf).select("track_key", C.has_any_nonzero(FEATURES).cast("int")
                                  .alias("has_signal"))


@register("p20_time_proxy", with_ctes(RAW) + """
SELECT track_key, track_key AS __time_proxy__ FROM raw_tracks""")
def p20_time_proxy(spark, sf):
    return C.time_proxy(_raw(spark, sf).select("track_key"), key="track_key")


@register("p21_row_label", """
SELECT doc_id, substr(text, 1, 40) AS label FROM documents""")
def p21_row_label(spark, sf):
    docs = FX.table(spark, sf, "documents")
    return docs.select("doc_id", C.row_label(docs, "doc_id", 40, candidates=("text",))
                       .alias("label"))


@register("p21_row_label_fallback", """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS label FROM documents""")
def p21_row_label_fallback(spark, sf):
    docs = FX.table(spark, sf, "documents").select("doc_id", "lang")
    return docs.select("doc_id", C.row_label(docs, "doc_id", 40).alias("label"))


# --- A ---------------------------------------------------------------------

@register("a01_class_balance", with_ctes(LAB) + """
SELECT count(*) AS rows, count(*) FILTER (WHERE hit = 1) AS hits,
       count(*) FILTER (WHERE hit = 0) AS flops,
       count(*) FILTER (WHERE hit = 1) / count(*) AS hit_rate,
       count(*) FILTER (WHERE hit = 1) / (count(*) FILTER (WHERE hit IN (0, 1))) AS share_hit,
       count(*) FILTER (WHERE hit = 0) / (count(*) FILTER (WHERE hit IN (0, 1))) AS share_flop
FROM labelled""", doubles=["hit_rate", "share_hit", "share_flop"])
def a01_class_balance(spark, sf):
    return A.class_balance(_lab(spark, sf))


RAW_COLUMNS = ["track_key", "artist_key", "artist", "first_week", "popularity", "genre",
               "nation", "segment", "status", "acctbal", "energy", "danceability", "loudness",
               "tempo", "n_lines"]
_missing_union = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, count(*) FILTER (WHERE \"{c}\" IS NULL) "
    f"AS missing FROM raw_tracks" for i, c in enumerate(RAW_COLUMNS))


@register("a02_missing_by_column", with_ctes(RAW) + f""",
m AS ({_missing_union})
SELECT column_name, position, missing, CAST(sum(missing) OVER () AS BIGINT) AS missing_total
FROM m WHERE missing > 0 ORDER BY missing DESC, position LIMIT 12""")
def a02_missing_by_column(spark, sf):
    return A.missing_by_column(_raw(spark, sf), top=12)


@register("a03_rows_missing_all", with_ctes(RAW) + """
SELECT count(*) FILTER (WHERE danceability IS NULL AND energy IS NULL AND loudness IS NULL
                        AND tempo IS NULL) AS rows_missing_all FROM raw_tracks""")
def a03_rows_missing_all(spark, sf):
    return A.rows_missing_all(_raw(spark, sf), A.SIGNAL_PROBE_COLUMNS)


@register("a04_duplicate_rows", with_ctes(RAW) + """,
g AS (SELECT *, count(*) AS n FROM raw_tracks GROUP BY ALL)
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM g""")
def a04_duplicate_rows(spark, sf):
    return A.duplicate_rows(_raw(spark, sf))


CARD_COLS = ["genre", "nation", "artist", "status"]
_card_union = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, count(DISTINCT \"{c}\") AS \"distinct\", "
    f"avg(CAST(\"{c}\" IS NOT NULL AS DOUBLE)) AS coverage FROM raw_tracks"
    for i, c in enumerate(CARD_COLS))


@register("a05_cardinality_coverage", with_ctes(RAW) + f""",
c AS ({_card_union})
SELECT column_name, position, "distinct", coverage,
       CAST("distinct" > 500 AS INTEGER) AS high_cardinality,
       CAST(coverage < 0.5 AS INTEGER) AS sparse FROM c""", doubles=["coverage"])
def a05_cardinality_coverage(spark, sf):
    return A.cardinality_coverage(_raw(spark, sf), CARD_COLS)


@register("a06_date_quality", with_ctes(RAW) + f""",
p AS (SELECT {PARSE} AS d FROM raw_tracks)
SELECT strftime(min(d), '%Y-%m-%d') AS date_min, strftime(max(d), '%Y-%m-%d') AS date_max,
       count(*) FILTER (WHERE d > {FX.NOW_SQL}) AS future,
       count(*) FILTER (WHERE d IS NULL) AS unparsed FROM p""")
def a06_date_quality(spark, sf):
    return A.date_quality(_raw(spark, sf), "first_week", FX.NOW, FX.DATE_FORMATS)


FLAG_CATS = ["genre", "artist"]


A07_SQL = with_ctes(RAW) + f""",
p AS (SELECT {PARSE} AS d, * FROM raw_tracks),
s AS (SELECT count(*) AS n,
             count(*) FILTER (WHERE d > {FX.NOW_SQL}) AS future,
             count(*) FILTER (WHERE d IS NULL) AS unparsed,
             min(d) AS dmin,
             count(*) FILTER (WHERE danceability IS NULL AND energy IS NULL AND loudness IS NULL
                              AND tempo IS NULL) AS nosig,
             count(DISTINCT genre) AS d0, avg(CAST(genre IS NOT NULL AS DOUBLE)) AS v0,
             count(DISTINCT artist) AS d1, avg(CAST(artist IS NOT NULL AS DOUBLE)) AS v1
      FROM p),
g AS (SELECT *, count(*) AS c FROM raw_tracks GROUP BY ALL),
dup AS (SELECT sum(c - 1) AS duplicates FROM g),
f AS (
  SELECT 1 AS seq, 'serious' AS severity, 'Impossible release dates' AS label,
         CAST(future AS DOUBLE) AS value, future / n AS share,
         dmin IS NOT NULL AND future > 0 AS keep FROM s
  UNION ALL SELECT 2, 'warning', 'Unparseable dates', unparsed, unparsed / n, unparsed > 0 FROM s
  UNION ALL SELECT 3, 'serious', 'Rows with no audio features', nosig, nosig / n, nosig > 0 FROM s
  UNION ALL SELECT 4, 'warning', 'Duplicate rows', duplicates, duplicates / n, duplicates > 0
            FROM s, dup
  UNION ALL SELECT 5, 'warning', 'High-cardinality `genre`', d0, d0 / n, d0 > 500 FROM s
  UNION ALL SELECT 6, 'warning', 'Sparse `genre`', v0, v0 / n, v0 < 0.5 FROM s
  UNION ALL SELECT 7, 'warning', 'High-cardinality `artist`', d1, d1 / n, d1 > 500 FROM s
  UNION ALL SELECT 8, 'warning', 'Sparse `artist`', v1, v1 / n, v1 < 0.5 FROM s)
SELECT seq, severity, label, value, share FROM f WHERE keep"""


@register("a07_quality_flags", A07_SQL, doubles=["value", "share"])
def a07_quality_flags(spark, sf):
    return A.quality_flags(_raw(spark, sf), "first_week", FX.NOW, FX.DATE_FORMATS,
                           category_cols=FLAG_CATS)


SUMMARY_NUMERIC = "track_key,artist_key,acctbal,energy,danceability,loudness,tempo,n_lines"
_most_missing = " UNION ALL ".join(
    f"SELECT '{c}' AS name, {i} AS pos, count(*) FILTER (WHERE \"{c}\" IS NULL) AS m FROM t"
    for i, c in enumerate(RAW_COLUMNS + ["hit"]))
_missing_sum = " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in RAW_COLUMNS + ["hit"])


@register("a08_dataset_summary", with_ctes(RAW) + f""",
t AS (SELECT *, CAST(coalesce(popularity >= 400000.0, false) AS INTEGER) AS hit FROM raw_tracks),
g AS (SELECT *, count(*) AS c FROM t GROUP BY ALL),
dup AS (SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates FROM g),
mm AS (SELECT string_agg(name || ':' || CAST(m AS VARCHAR), '; ' ORDER BY m DESC, pos) AS most_missing
       FROM (SELECT * FROM ({_most_missing}) AS x WHERE m > 0 ORDER BY m DESC, pos LIMIT 12) AS y),
fl AS (SELECT string_agg(severity || ':' || label, '; ' ORDER BY seq) AS flags FROM ({A07_SQL}) AS z)
SELECT count(*) AS rows, CAST(16 AS BIGINT) AS columns,
       count(*) FILTER (WHERE hit = 1) AS hits, count(*) FILTER (WHERE hit = 0) AS flops,
       count(*) FILTER (WHERE hit = 1) / count(*) AS hit_rate,
       strftime(min({PARSE}), '%Y-%m-%d') AS date_min,
       strftime(max({PARSE}), '%Y-%m-%d') AS date_max,
       CAST({_missing_sum} AS BIGINT) AS missing_total,
       any_value(duplicates) AS duplicates,
       '{SUMMARY_NUMERIC}' AS numeric_features, any_value(most_missing) AS most_missing,
       any_value(flags) AS flags
FROM t, dup, mm, fl""", doubles=["hit_rate"])
def a08_dataset_summary(spark, sf):
    df = C.add_label(_raw(spark, sf), "popularity", FX.LABEL_THRESHOLD)
    return A.dataset_summary(df, "hit", "first_week", FX.DATE_FORMATS, C.LEAKAGE_COLUMNS, FX.NOW,
                             category_cols=FLAG_CATS)


def _hist_sql(source: str, value: str, bins: int, fixed: tuple[float, float] | None,
              counts: dict[str, str]) -> str:
    """DuckDB twin of the shared-edge histogram (numpy's edge rules)."""
    if fixed:
        stats = f"SELECT CAST({fixed[0]} AS DOUBLE) AS lo, CAST({fixed[1]} AS DOUBLE) AS hi"
    else:
        stats = (f"SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, "
                 f"CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v")
    edge = (lambda k: f"(CASE WHEN {k} = {bins} THEN hi ELSE CAST({k} AS DOUBLE) * step + lo END)")
    sums = ", ".join(f"CAST(sum({expr}) AS BIGINT) AS {name}" for name, expr in counts.items())
    outs = ", ".join(f"CAST(coalesce(a.{name}, 0) AS BIGINT) AS {name}" for name in counts)
    return f"""
v AS (SELECT {value} AS x, * FROM {source} WHERE {value} IS NOT NULL AND NOT isnan({value})),
st AS ({stats}),
pr AS (SELECT v.*, lo, hi, (hi - lo) / {bins} AS step, {bins} / (hi - lo) AS norm
       FROM v, st WHERE x >= lo AND x <= hi),
r0 AS (SELECT *, CASE WHEN floor((x - lo) * norm) >= {bins} THEN {bins - 1}
                      ELSE CAST(floor((x - lo) * norm) AS BIGINT) END AS raw FROM pr),
r1 AS (SELECT *, CASE WHEN x < {edge('raw')} THEN raw - 1
                      WHEN x >= {edge('raw + 1')} AND raw != {bins - 1} THEN raw + 1
                      ELSE raw END AS bin FROM r0),
a AS (SELECT bin, {sums} FROM r1 GROUP BY bin),
grid AS (SELECT range AS bin, lo, hi, (hi - lo) / {bins} AS step FROM range({bins}), st),
hist AS (
  SELECT g.bin AS bin,
         ({edge('g.bin')} + {edge('g.bin + 1')}) / 2 AS bin_center,
         {edge('g.bin')} AS bin_lo, {edge('g.bin + 1')} AS bin_hi, {outs},
         (lo + step) - lo AS bin_width
  FROM grid g LEFT JOIN a ON g.bin = a.bin)"""


A09_HIST = _hist_sql("labelled", "tempo", 30, None,
                     {"hit_count": "CAST(hit = 1 AS INTEGER)",
                      "flop_count": "CAST(hit = 0 AS INTEGER)"})


@register("a09_feature_distribution", with_ctes(LAB, A09_HIST) + """
SELECT * FROM hist""", doubles=["bin_center", "bin_lo", "bin_hi", "bin_width"])
def a09_feature_distribution(spark, sf):
    return A.feature_distribution(_lab(spark, sf), "tempo", "hit", bins=30)


@register("a10_feature_stats", with_ctes(LAB) + """
SELECT 'tempo' AS feature, avg(tempo) AS mean, median(tempo) AS median,
       stddev_samp(tempo) AS std, min(tempo) AS min, max(tempo) AS max,
       count(*) FILTER (WHERE tempo IS NULL) AS missing,
       avg(tempo) FILTER (WHERE hit = 1) AS hit_mean, avg(tempo) FILTER (WHERE hit = 0) AS flop_mean
FROM labelled""", doubles=["mean", "median", "std", "min", "max", "hit_mean", "flop_mean"])
def a10_feature_stats(spark, sf):
    return A.feature_stats(_lab(spark, sf), "tempo", "hit")


@register("a11_share_within_class", with_ctes(LAB, A09_HIST) + """
SELECT *, CASE WHEN sum(hit_count) OVER () > 0
               THEN hit_count / sum(hit_count) OVER () * 100 ELSE 0.0 END AS hit_share,
          CASE WHEN sum(flop_count) OVER () > 0
               THEN flop_count / sum(flop_count) OVER () * 100 ELSE 0.0 END AS flop_share
FROM hist""", doubles=["bin_center", "bin_lo", "bin_hi", "bin_width", "hit_share", "flop_share"])
def a11_share_within_class(spark, sf):
    return A.share_within_class(A.feature_distribution(_lab(spark, sf), "tempo", "hit", 30))


CORR_COLS = ["energy", "danceability", "loudness", "tempo", "acctbal", "hit"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            lo, hi = (a, b) if i <= j else (b, a)
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS i, {j} AS j, "
                         f"corr(CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE)) AS r FROM labelled")
    return "\n  UNION ALL ".join(parts)


@register("a12_correlations", with_ctes(LAB) + f""",
m AS ({_corr_sql()})
SELECT a, b, i, j, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM m""", doubles=["r"])
def a12_correlations(spark, sf):
    return A.correlations(_lab(spark, sf), CORR_COLS)


@register("a12_top_correlations", with_ctes(LAB) + f""",
m AS ({_corr_sql()})
SELECT a, b, i, j, r FROM m WHERE i < j AND r IS NOT NULL AND NOT isnan(r)
ORDER BY abs(r) DESC, i, j LIMIT 10""", doubles=["r"])
def a12_top_correlations(spark, sf):
    return A.top_correlations(A.correlations(_lab(spark, sf), CORR_COLS), 10)


@register("a13_coverage_rate", """
WITH d AS (SELECT l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT count(*) FILTER (WHERE quality IS NOT NULL AND CAST(quality AS VARCHAR) != '') AS with_value,
       count(*) AS total,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE quality IS NOT NULL) / count(*)
            ELSE 0.0 END AS rate
FROM d""", doubles=["rate"])
def a13_coverage_rate(spark, sf):
    docs = FX.table(spark, sf, "documents").select("doc_id")
    labels = FX.table(spark, sf, "labels").select("doc_id", "quality")
    return A.coverage_rate(docs.join(labels, "doc_id", "left"), "quality")


@register("a14_category_distribution", with_ctes(LAB) + """,
per AS (SELECT nation, count(*) AS rows, avg(CAST(hit AS DOUBLE)) AS rate FROM labelled
        WHERE nation IS NOT NULL GROUP BY nation ORDER BY rows DESC, nation LIMIT 15),
tot AS (SELECT count(DISTINCT nation) AS "distinct",
               avg(CAST(nation IS NOT NULL AS DOUBLE)) AS coverage FROM labelled)
SELECT 'nation' AS column_name, nation AS value, substr(nation, 1, 44) AS label, rows, rate, "distinct", coverage
FROM per, tot""", doubles=["rate", "coverage"])
def a14_category_distribution(spark, sf):
    return A.category_distribution(_lab(spark, sf), "nation", "hit", top=15)


@register("a15_rate_by_year", with_ctes(RAW) + f""",
t AS (SELECT year({PARSE}) AS year,
             CAST(coalesce(popularity >= 400000.0, false) AS INTEGER) AS hit FROM raw_tracks)
SELECT year, count(hit) AS count, avg(CAST(hit AS DOUBLE)) AS rate,
       CAST(year > 2000 AS INTEGER) AS is_future
FROM t WHERE year IS NOT NULL GROUP BY year HAVING count(hit) >= 10 ORDER BY year""",
          doubles=["rate"])
def a15_rate_by_year(spark, sf):
    df = C.add_label(_raw(spark, sf), "popularity", FX.LABEL_THRESHOLD)
    return A.rate_by_year(df, "first_week", "hit", 10, FX.NOW, FX.DATE_FORMATS)


PROFILE_COLS = ["energy", "danceability", "loudness", "tempo", "acctbal"]
_profile_union = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS position, min({c}) AS lo, max({c}) AS hi, "
    f"median({c}) AS median, avg({c}) FILTER (WHERE hit = 1) AS pos_mean, "
    f"avg({c}) FILTER (WHERE hit = 0) AS neg_mean FROM labelled"
    for i, c in enumerate(PROFILE_COLS))


@register("a16_feature_profile", with_ctes(LAB) + f"""
{_profile_union}""", doubles=["lo", "hi", "median", "pos_mean", "neg_mean"])
def a16_feature_profile(spark, sf):
    return A.feature_profile(_lab(spark, sf), PROFILE_COLS)


OPTION_COLS = ["genre", "nation", "segment", "status"]
_options_union = "\n  UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM labelled "
    f"WHERE {c} IS NOT NULL" for c in OPTION_COLS)


@register("a17_category_options", with_ctes(LAB) + f"""
SELECT * FROM ({_options_union}) ORDER BY column_name, value""")
def a17_category_options(spark, sf):
    return A.category_options(_lab(spark, sf), OPTION_COLS)


@register("a18_batch_kpis", with_ctes(FX.SCORED_CTE) + """
SELECT count(*) AS total, CAST(coalesce(sum(y_pred), 0) AS BIGINT) AS predicted_hits,
       avg(y_score) * 100 AS avg_score, max(y_score) * 100 AS top_score FROM scored""",
          doubles=["avg_score", "top_score"])
def a18_batch_kpis(spark, sf):
    return A.batch_kpis(FX.scored(spark, sf), "y_score", "y_pred")


A19_HIST = _hist_sql("(SELECT y_score * 100 AS pct FROM scored)", "pct", 25, (0.0, 100.0),
                     {"count": "1"})


@register("a19_score_histogram", with_ctes(FX.SCORED_CTE, A19_HIST) + """
SELECT bin, bin_center, bin_lo, bin_hi, count FROM hist""",
          doubles=["bin_center", "bin_lo", "bin_hi"])
def a19_score_histogram(spark, sf):
    return A.score_histogram(FX.scored(spark, sf), "y_score", 25)


LOG_SQL = """
log AS (SELECT event_id AS id, ts, event_type AS mode, value / 100 AS score,
               user_id FROM events)"""


def prediction_log(spark, sf):
    """Prediction-log stand-in from ``events``: score = value / 100."""
    ev = FX.table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"), "ts", F.col("event_type").alias("mode"),
                     (F.col("value") / 100).alias("score"), "user_id")


@register("a20_history_stats", with_ctes(LOG_SQL) + """
SELECT count(*) AS n, avg(score) AS mean_score, max(score) AS max_score,
       count(*) FILTER (WHERE score >= 0.5) AS n_positive FROM log""",
          doubles=["mean_score", "max_score"])
def a20_history_stats(spark, sf):
    return A.history_stats(prediction_log(spark, sf), "score")


@register("j03_keep_frequent_categories", with_ctes(FX.SCORED_CTE) + """,
f AS (SELECT row_key, coalesce("group", 'other') AS v FROM scored),
c AS (SELECT v, count(*) AS n FROM f GROUP BY v)
SELECT f.row_key, CASE WHEN c.n >= 600 THEN f.v ELSE 'other' END AS group_canonical
FROM f JOIN c ON f.v = c.v""")
def j03_keep_frequent_categories(spark, sf):
    s = FX.scored(spark, sf).select("row_key", "group")
    return A.keep_frequent_categories(s, "group", 600, "other", out="group_canonical").select(
        "row_key", "group_canonical")
