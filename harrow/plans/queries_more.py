"""Window (W), sampling (SA) and holdout-integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import columns as C
from harrow.operators import evaluate as E
from harrow.operators import rank as W
from harrow.operators import sampling as SA
from harrow.plans import fixtures as FX
from harrow.plans.catalog import register, with_ctes
from harrow.plans.queries_core import LOG_SQL
from harrow.session import freeze

LAB = FX.LABELLED_CTE
SC = FX.SCORED_CTE
H = "md5(concat_ws('-', CAST(track_key AS VARCHAR), '42'))"


def prediction_log_ms(spark, sf):
    ev = FX.table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"),
                     F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
                     F.col("event_type").alias("mode"), (F.col("value") / 100).alias("score"),
                     "user_id")


LOG_MS_SQL = """
logm AS (SELECT event_id AS id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp, event_type AS mode,
                value / 100 AS score, user_id FROM events)"""


@register("w01_temporal_split", with_ctes(LAB) + """,
r AS (SELECT track_key, row_number() OVER (ORDER BY first_week, track_key) AS rn,
             count(*) OVER () AS n FROM labelled)
SELECT track_key, CAST(rn > CAST(floor(CAST(0.8 AS DOUBLE) * n) AS BIGINT) AS INTEGER) AS is_test
FROM r""")
def w01_temporal_split(spark, sf):
    lab = FX.labelled_tracks(spark, sf)
    return W.temporal_split(lab, "first_week", ["track_key"], 0.2).select("track_key", "is_test")


@register("w01_split_sizes", with_ctes(LAB) + """,
r AS (SELECT hit, row_number() OVER (ORDER BY first_week, track_key) AS rn,
             count(*) OVER () AS n FROM labelled),
t AS (SELECT CAST(rn > CAST(floor(CAST(0.8 AS DOUBLE) * n) AS BIGINT) AS INTEGER) AS is_test,
             hit FROM r)
SELECT is_test, count(*) AS rows, avg(CAST(hit AS DOUBLE)) AS positive_rate
FROM t GROUP BY is_test""", doubles=["positive_rate"])
def w01_split_sizes(spark, sf):
    lab = FX.labelled_tracks(spark, sf)
    split = W.temporal_split(lab, "first_week", ["track_key"], 0.2)
    return split.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows"),
                                        F.avg(F.col("hit").cast("double")).alias("positive_rate"))


@register("w02_top_k_scored", with_ctes(SC) + """
SELECT row_key, y_score, substr(CAST(row_key AS VARCHAR), 1, 40) AS label
FROM scored ORDER BY y_score DESC, row_key LIMIT 10""", doubles=["y_score"])
def w02_top_k_scored(spark, sf):
    s = FX.scored(spark, sf)
    top = W.top_k(s, "y_score", 10, key="row_key")
    return top.select("row_key", "y_score", C.row_label(s, "row_key", 40).alias("label"))


@register("w03_preview", with_ctes(LAB) + """
SELECT track_key, artist, nation, popularity FROM labelled ORDER BY track_key LIMIT 20""",
          doubles=["popularity"])
def w03_preview(spark, sf):
    lab = FX.labelled_tracks(spark, sf).select("track_key", "artist", "nation", "popularity")
    return W.preview(lab, "track_key", 20)


@register("w04_best_per_group", with_ctes(SC) + """
SELECT "group", row_key, y_score FROM (
  SELECT "group", row_key, y_score,
         row_number() OVER (PARTITION BY "group" ORDER BY y_score DESC, row_key) AS r
  FROM scored WHERE y_score IS NOT NULL) WHERE r = 1""", doubles=["y_score"])
def w04_best_per_group(spark, sf):
    s = FX.scored(spark, sf).select("group", "row_key", "y_score")
    return W.best_per_group(s, "group", "y_score", "row_key")


@register("w06_keep_latest", with_ctes(LOG_MS_SQL) + """
SELECT id, timestamp, mode, score FROM logm ORDER BY timestamp DESC, id DESC LIMIT 200""",
          doubles=["score"])
def w06_keep_latest(spark, sf):
    log = prediction_log_ms(spark, sf).select("id", "timestamp", "mode", "score")
    return W.keep_latest(log, "timestamp", 200, key="id")


REPEAT_SQL = LOG_MS_SQL + """,
rep AS (SELECT id * 3 + c AS id, timestamp, mode, score, user_id,
               CASE WHEN id % 5 = 0 THEN NULL
                    WHEN c = 2 AND id % 4 = 1 THEN 'other' ELSE 'd' || CAST(id % 3 AS VARCHAR) END AS detail
        FROM logm, (SELECT unnest([0, 1, 2]) AS c) AS copies WHERE c = 0 OR id % 4 <= 1)"""


def repeated_log(spark, sf):
    """The prediction log with some records repeated at once, some of the repeats with
    another detail."""
    log = prediction_log_ms(spark, sf)
    copies = F.when(F.col("id") % 4 <= 1, F.array(*map(F.lit, (0, 1, 2)))).otherwise(
        F.array(F.lit(0)))
    rep = log.withColumn("c", F.explode(copies))
    detail = (F.when(F.col("id") % 5 == 0, F.lit(None))
              .when((F.col("c") == 2) & (F.col("id") % 4 == 1), F.lit("other"))
              .otherwise(F.concat(F.lit("d"), (F.col("id") % 3).cast("string"))))
    return rep.select((F.col("id") * 3 + F.col("c")).alias("id"), "user_id", "timestamp", "mode",
                      "score", detail.alias("detail"))


@register("w07_drop_consecutive_repeats", with_ctes(REPEAT_SQL) + """,
s AS (SELECT *, lag(mode) OVER w AS pm, lag(score) OVER w AS ps, lag(detail) OVER w AS pd,
             lag(1) OVER w AS has_prev
      FROM rep WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, id))
SELECT id, user_id, mode, score, detail FROM s
WHERE has_prev IS NULL OR NOT (mode IS NOT DISTINCT FROM pm AND score IS NOT DISTINCT FROM ps
                               AND detail IS NOT DISTINCT FROM pd)""",
          doubles=["score"])
def w07_drop_consecutive_repeats(spark, sf):
    out = W.drop_consecutive_repeats(repeated_log(spark, sf), ["user_id"], ["timestamp", "id"],
                                     ["mode", "score", "detail"])
    return out.select("id", "user_id", "mode", "score", "detail")


# --- sampling ----------------------------------------------------------------

MATCH_SQL = LAB + f""",
b AS (SELECT track_key, hit, year(first_week) AS yr, coalesce(genre, 'unknown') AS grp,
             {H} AS h FROM labelled),
p AS (SELECT *, row_number() OVER (PARTITION BY yr, grp ORDER BY h, track_key) AS r
      FROM b WHERE hit = 1 AND yr IS NOT NULL),
c AS (SELECT *, row_number() OVER (PARTITION BY yr, grp ORDER BY h, track_key) AS r
      FROM b WHERE hit = 0 AND yr IS NOT NULL),
m1 AS (SELECT p.track_key AS pk, c.track_key AS ck FROM p JOIN c
       ON p.yr = c.yr AND p.grp = c.grp AND p.r = c.r),
p2 AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY h, track_key) AS r2
       FROM p WHERE track_key NOT IN (SELECT pk FROM m1)),
c2 AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY h, track_key) AS r2
       FROM c WHERE track_key NOT IN (SELECT ck FROM m1)),
m2 AS (SELECT p2.track_key AS pk, c2.track_key AS ck FROM p2 JOIN c2
       ON p2.yr = c2.yr AND p2.r2 = c2.r2)"""


@register("sa01_match_report", with_ctes(MATCH_SQL) + """
SELECT (SELECT count(*) FROM b WHERE hit = 1) AS hits_available,
       (SELECT count(*) FROM b WHERE hit = 0) AS controls_available,
       (SELECT count(*) FROM m1) AS matched_year_and_genre,
       (SELECT count(*) FROM m2) AS matched_year_only,
       (SELECT count(*) FROM b WHERE hit = 1) - (SELECT count(*) FROM m1)
         - (SELECT count(*) FROM m2) AS hits_unmatched,
       2 * ((SELECT count(*) FROM m1) + (SELECT count(*) FROM m2)) AS rows_out,
       CASE WHEN (SELECT count(*) FROM m1) + (SELECT count(*) FROM m2) > 0 THEN 0.5
            ELSE 0.0 END AS positive_rate""", doubles=["positive_rate"])
def sa01_match_report(spark, sf):
    lab = FX.labelled_tracks(spark, sf)
    _, report = SA.case_control_match(lab, "hit", "first_week", "genre", "track_key", 42)
    return report


@register("sa01_matched_sample", with_ctes(MATCH_SQL) + """
SELECT track_key, hit FROM labelled
WHERE track_key IN (SELECT pk FROM m1 UNION ALL SELECT ck FROM m1
                    UNION ALL SELECT pk FROM m2 UNION ALL SELECT ck FROM m2)""")
def sa01_matched_sample(spark, sf):
    # Read by the matching and by the sample.
    lab = freeze(FX.labelled_tracks(spark, sf).select("track_key", "hit", "first_week", "genre"))
    sample, _ = SA.case_control_match(lab, "hit", "first_week", "genre", "track_key", 42)
    return sample.select("track_key", "hit")


@register("sa02_stratified_split", with_ctes(LAB) + f""",
r AS (SELECT track_key, hit, row_number() OVER (PARTITION BY hit ORDER BY {H}, track_key) AS r,
             count(*) OVER (PARTITION BY hit) AS n FROM labelled)
SELECT track_key, hit,
       CAST(r > floor(n * CAST(0.8 AS DOUBLE)) AS INTEGER) AS is_test FROM r""")
def sa02_stratified_split(spark, sf):
    lab = FX.labelled_tracks(spark, sf).select("track_key", "hit")
    return SA.stratified_split(lab, "hit", "track_key", 0.2, 42)


@register("sa03_stratified_folds", with_ctes(LAB) + f"""
SELECT track_key, hit,
       CAST((row_number() OVER (PARTITION BY hit ORDER BY {H}, track_key) - 1) % 5 AS INTEGER)
         AS fold
FROM labelled""")
def sa03_stratified_folds(spark, sf):
    lab = FX.labelled_tracks(spark, sf).select("track_key", "hit")
    return SA.stratified_folds(lab, "hit", "track_key", 5, 42)


@register("sa05_balanced_class_weights", with_ctes(LAB) + """,
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE hit = 1) AS pos,
             count(*) FILTER (WHERE hit = 0) AS neg FROM labelled)
SELECT n, pos, neg, CASE WHEN pos > 0 THEN n / (2 * pos) END AS weight_pos,
       CASE WHEN neg > 0 THEN n / (2 * neg) END AS weight_neg,
       CASE WHEN pos > 0 THEN neg / pos ELSE 1.0 END AS scale_pos_weight FROM c""",
          doubles=["weight_pos", "weight_neg", "scale_pos_weight"])
def sa05_balanced_class_weights(spark, sf):
    return SA.balanced_class_weights(FX.labelled_tracks(spark, sf), "hit")


def minority_embeddings(spark, sf):
    """Embeddings with label 0 as the (about 10%) minority class."""
    emb = FX.table(spark, sf, "embeddings")
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
                      (F.col("label") == 0).cast("int").alias("y"))


def _u(salt: str) -> str:
    return (f"(CAST(('0x' || substr(md5(concat_ws('-', CAST(s AS VARCHAR), '42', '{salt}')), 1, 8)) "
            "AS BIGINT) / 4294967296.0)")


@register("sa04_smote", f"""
WITH mi AS (SELECT vec_id, embedding AS e, row_number() OVER (ORDER BY vec_id) AS i
            FROM embeddings WHERE label = 0),
dist AS (SELECT a.vec_id AS q, b.vec_id AS nb, list_sum(list_transform(range(1, len(a.e) + 1),
           lambda j: pow(CAST(a.e[j] AS DOUBLE) - CAST(b.e[j] AS DOUBLE), 2))) AS d
         FROM mi AS a JOIN mi AS b ON a.vec_id <> b.vec_id),
nn AS (SELECT q, nb, row_number() OVER (PARTITION BY q ORDER BY d, nb) - 1 AS r FROM dist),
gen AS (SELECT s, CAST(floor({_u('base')} * (SELECT count(*) FROM mi)) AS BIGINT) + 1 AS i,
               CAST(floor({_u('nn')} * 5) AS BIGINT) AS r, {_u('step')} AS u
        FROM (SELECT unnest(range((SELECT count(*) FILTER (WHERE label <> 0)
                                          - count(*) FILTER (WHERE label = 0) FROM embeddings))) AS s) AS x),
syn AS (SELECT -(s + 1) AS vec_id, u, a.e AS x, b.e AS y FROM gen JOIN mi AS a ON a.i = gen.i
        JOIN nn ON nn.q = a.vec_id AND nn.r = gen.r JOIN mi AS b ON b.vec_id = nn.nb)
SELECT vec_id, CAST(label = 0 AS INTEGER) AS y, 0 AS synthetic, CAST(embedding[1] AS DOUBLE) AS v_first,
       list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS v_sum FROM embeddings
UNION ALL
SELECT vec_id, 1, 1, CAST(x[1] AS DOUBLE) + (CAST(y[1] AS DOUBLE) - CAST(x[1] AS DOUBLE)) * u,
       list_sum(list_transform(range(1, len(x) + 1),
         lambda j: CAST(x[j] AS DOUBLE) + (CAST(y[j] AS DOUBLE) - CAST(x[j] AS DOUBLE)) * u)) FROM syn""",
          doubles=["v_first", "v_sum"])
def sa04_smote(spark, sf):
    """Every row after SMOTE, its vector by its first entry and its sum."""
    out = SA.smote(minority_embeddings(spark, sf), "y", "embedding", "vec_id", k=5, seed=42)
    return out.select("vec_id", "y", "synthetic", F.get("embedding", 0).alias("v_first"),
                      F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("v_sum"))


@register("sa04_smote_class_counts", """
SELECT y, n FROM (SELECT 0 AS y UNION ALL SELECT 1 AS y) AS labels_,
     (SELECT count(*) AS n FROM embeddings WHERE label != 0) AS majority""")
def sa04_smote_class_counts(spark, sf):
    """After SMOTE both classes hold the majority count."""
    out = SA.smote(minority_embeddings(spark, sf), "y", "embedding", "vec_id", k=5, seed=42)
    return out.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@register("e13_holdout_integrity", with_ctes(LAB) + """,
r AS (SELECT *, row_number() OVER (ORDER BY first_week, track_key) AS rn,
             count(*) OVER () AS n FROM labelled),
t AS (SELECT * FROM r WHERE rn > CAST(floor(CAST(0.8 AS DOUBLE) * n) AS BIGINT)),
leak AS (SELECT * FROM t WHERE track_key % 7 <> 0)
SELECT 'resampled fit' AS case_name, count(*) AS n_before, count(*) AS n_after,
       avg(CAST(hit AS DOUBLE)) AS rate_before, avg(CAST(hit AS DOUBLE)) AS rate_after,
       1 AS unchanged FROM t
UNION ALL
SELECT 'rows lost', (SELECT count(*) FROM t), count(*),
       (SELECT avg(CAST(hit AS DOUBLE)) FROM t), avg(CAST(hit AS DOUBLE)), 0 FROM leak""",
          doubles=["rate_before", "rate_after"])
def e13_holdout_integrity(spark, sf):
    """The holdout before a resampled fit against the rows that the fitted model scores
    after it; and a holdout that lost rows, which must be noticed."""
    from harrow.ml.models import fit_pipeline
    # Read by the split, the fit, the scores and both checks.
    lab = freeze(FX.labelled_tracks(spark, sf).select("track_key", "hit", "first_week", "tempo",
                                                      "acctbal", "segment"))
    split = W.temporal_split(lab, "first_week", ["track_key"], 0.2)
    test = split.filter("is_test = 1").drop("is_test")
    train = split.filter("is_test = 0").drop("is_test")
    model = fit_pipeline(train, ["tempo", "acctbal"], ["segment"], "hit", "track_key",
                         "logistic_regression", "smote")
    cases = [("resampled fit", model.score(test)),
             ("rows lost", test.filter(F.col("track_key") % 7 != 0))]
    found = [E.holdout_integrity(test, after, "hit", ["track_key"])
             .select(F.lit(name).alias("case_name"), "*") for name, after in cases]
    return found[0].unionByName(found[1])


# --- enrichment -----------------------------------------------------------------

from harrow.operators import enrich as EN  # noqa: E402
from harrow.plans import catalog_json as CJ  # noqa: E402


def _catalog(spark, sf):
    tracks = EN.parse_records(CJ.track_json(spark, sf), "value", EN.TRACK_SCHEMA, "track")
    artists = EN.parse_records(CJ.artist_json(spark, sf), "value", EN.ARTIST_SCHEMA, "artist")
    return tracks, artists


FLAT_COLS = ("track_id, track_popularity, artist_popularity, artist_followers, duration_ms, "
             "is_explicit, release_year, release_month, num_artists, primary_genre, has_preview")


@register("s05_read_track_json", """
SELECT 't' || CAST(o_orderkey AS VARCHAR) AS id, CAST(trunc(o_totalprice / 5000) AS INTEGER) AS popularity,
       CASE WHEN o_orderkey % 10 = 7 THEN 0 ELSE 1 END AS n_artists,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'http://p/' || CAST(o_orderkey AS VARCHAR) END
         AS preview_url
FROM orders""")
def s05_read_track_json(spark, sf):
    tracks = EN.parse_records(CJ.track_json(spark, sf), "value", EN.TRACK_SCHEMA, "t")
    return tracks.select(F.col("t.id").alias("id"), F.col("t.popularity").alias("popularity"),
                         F.size("t.artists").alias("n_artists"),
                         F.col("t.preview_url").alias("preview_url"))


@register("p13_flatten_catalog", with_ctes(CJ.FLAT_SQL) + f"""
SELECT {FLAT_COLS} FROM flat""")
def p13_flatten_catalog(spark, sf):
    tracks, artists = _catalog(spark, sf)
    return EN.flatten_catalog(EN.lookup_first_artist(tracks, artists))


@register("j02_lookup_first_artist", with_ctes(CJ.FLAT_SQL) + """
SELECT track_id, artist_popularity, artist_followers, primary_genre FROM flat""")
def j02_lookup_first_artist(spark, sf):
    tracks, artists = _catalog(spark, sf)
    flat = EN.flatten_catalog(EN.lookup_first_artist(tracks, artists))
    return flat.select("track_id", "artist_popularity", "artist_followers", "primary_genre")


@register("p14_parse_release_date", f"""
WITH o AS (SELECT * FROM orders), r AS (SELECT o_orderkey, {CJ.RELEASE_SQL} AS rd FROM orders o)
SELECT o_orderkey, rd AS release_date,
       {CJ._digits("split_part(rd, '-', 1)")} AS release_year,
       {CJ._digits("split_part(rd, '-', 2)")} AS release_month FROM r""")
def p14_parse_release_date(spark, sf):
    o = FX.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    rd = (F.when(k % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
          .when(k % 5 == 1, F.date_format("o_orderdate", "yyyy"))
          .when(k % 5 == 2, F.date_format("o_orderdate", "yyyy-MM"))
          .when(k % 5 == 3, F.lit("")).otherwise(F.lit("unknown")))
    year, month = C.parse_release_date(rd)
    return o.select("o_orderkey", rd.alias("release_date"), year.alias("release_year"),
                    month.alias("release_month"))


META_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("j01_enrich_left_join", with_ctes(CJ.FLAT_SQL) + f""",
m AS (SELECT 't' || CAST(l_orderkey AS VARCHAR) AS track_id,
             'line ' || CAST(l_linenumber AS VARCHAR) AS track_name,
             l_returnflag AS playlist_genre, l_linestatus AS playlist_subgenre,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(META_ORDER)}) AS r
      FROM lineitem)
SELECT {FLAT_COLS}, m.track_name, m.playlist_genre, m.playlist_subgenre,
       CAST(coalesce(track_popularity >= 70, false) AS INTEGER) AS hit
FROM flat LEFT JOIN (SELECT * FROM m WHERE r = 1) m USING (track_id)""")
def j01_enrich_left_join(spark, sf):
    tracks, artists = _catalog(spark, sf)
    facts = EN.flatten_catalog(EN.lookup_first_artist(tracks, artists))
    li = FX.table(spark, sf, "lineitem")
    meta = li.select(F.concat(F.lit("t"), F.col("l_orderkey").cast("string")).alias("track_id"),
                     *META_ORDER)
    meta = meta.withColumn("track_name", F.concat(F.lit("line "),
                                                  F.col("l_linenumber").cast("string")))
    meta = meta.withColumn("playlist_genre", F.col("l_returnflag")).withColumn(
        "playlist_subgenre", F.col("l_linestatus"))
    out = EN.enrich_left_join(facts, meta, "track_id", META_ORDER,
                              keep=["track_name", "playlist_genre", "playlist_subgenre"])
    return out


# --- signal features ---------------------------------------------------------------

from harrow.operators import signal as G  # noqa: E402
from harrow.sources import io as IO  # noqa: E402
from harrow.session import scratch_path  # noqa: E402

TD_SQL = """
td AS (
  SELECT vec_id,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))
              / 2048) AS energy,
         20 * log10(greatest(sqrt(list_sum(list_transform(embedding,
              lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) / 2048), 1e-5)) AS loudness_db,
         len(list_filter(range(1, len(embedding)),
             lambda i: (embedding[i + 1] < -1e-10) != (embedding[i] < -1e-10))) / 2048 AS zcr
  FROM embeddings)"""


def _embeddings(spark, sf):
    return FX.table(spark, sf, "embeddings").select("vec_id", "embedding")


@register("g01_time_domain_features", with_ctes(TD_SQL) + """
SELECT vec_id, energy, loudness_db, zcr FROM td""", doubles=["energy", "loudness_db", "zcr"])
def g01_time_domain_features(spark, sf):
    """Single-frame case at this size (64 samples); the SQL twin covers that case."""
    return G.time_domain_features(_embeddings(spark, sf), "embedding").drop("embedding")


_zero_cols = ", ".join(
    (f"coalesce({c}, 0.0) AS {c}" if c in ("energy", "loudness_db", "zcr") else f"0.0 AS {c}")
    for c in G.SIGNAL_FEATURES)


@register("g02_zero_features", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN NULL ELSE embedding END AS embedding
           FROM embeddings),
td AS (
  SELECT vec_id,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))
              / 2048) AS energy,
         CASE WHEN embedding IS NOT NULL THEN
         20 * log10(greatest(sqrt(list_sum(list_transform(embedding,
              lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) / 2048), 1e-5)) END AS loudness_db,
         len(list_filter(range(1, len(embedding)),
             lambda i: (embedding[i + 1] < -1e-10) != (embedding[i] < -1e-10))) / 2048 AS zcr
  FROM e)
SELECT vec_id, """ + _zero_cols + """, 'audio features unavailable' AS audio_warning FROM td""",
          doubles=list(G.SIGNAL_FEATURES))
def g02_zero_features(spark, sf):
    e = _embeddings(spark, sf)
    e = e.withColumn("embedding", F.when(F.col("vec_id") % 4 == 0, F.lit(None))
                     .otherwise(F.col("embedding")))
    td = G.time_domain_features(e, "embedding").drop("embedding")
    return G.zero_features(td).select("vec_id", *G.SIGNAL_FEATURES, "audio_warning")


_overlay_num = ", ".join(f"{v!r}::DOUBLE AS {k}" for k, v in C.NEUTRAL_METADATA_NUMERIC.items())
_overlay_txt = ", ".join(f"'' AS {k}" for k in C.NEUTRAL_METADATA_TEXT)


@register("p10_overlay_neutral_metadata", with_ctes(TD_SQL) + f"""
SELECT vec_id, CAST(NULL AS DOUBLE) AS tempo, energy, loudness_db, zcr,
       loudness_db AS loudness, zcr AS speechiness, {_overlay_num}, {_overlay_txt} FROM td""",
          doubles=["tempo", "energy", "loudness_db", "zcr", "loudness", "speechiness",
                   *C.NEUTRAL_METADATA_NUMERIC])
def p10_overlay_neutral_metadata(spark, sf):
    td = G.time_domain_features(_embeddings(spark, sf), "embedding").drop("embedding")
    td = td.withColumn("tempo", F.lit(None).cast("double"))
    return C.overlay_neutral_metadata(td)


# --- sources and sinks --------------------------------------------------------------

@register("s01_read_table", """
SELECT c_custkey,
       CASE WHEN c_custkey % 17 = 0 THEN c_name || chr(10) || 'x "q"' ELSE c_name END AS c_name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       c_acctbal
FROM customer""", doubles=["c_acctbal"])
def s01_read_table(spark, sf):
    """Customer written as CSV (upper-case header, NA tokens, quoted newlines), read back."""
    c = FX.table(spark, sf, "customer")
    k = F.col("c_custkey")
    raw = c.select(
        k.alias("C_CUSTKEY"),
        F.when(k % 17 == 0, F.concat(F.col("c_name"), F.lit('\nx "q"'))).otherwise(
            F.col("c_name")).alias("C_NAME"),
        F.when(k % 13 == 0, F.lit("NA")).otherwise(F.col("c_mktsegment")).alias("C_MKTSEGMENT"),
        F.col("c_acctbal").alias("C_ACCTBAL"))
    path = scratch_path(spark, "csv")
    raw.write.option("header", True).option("escape", '"').csv(path)
    schema = "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"
    from pyspark.sql.types import _parse_datatype_string
    return IO.read_table(spark, path, _parse_datatype_string(schema), multi_line=True)


@register("s01_read_reordered", """
SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       c_mktsegment FROM customer""", doubles=["c_acctbal"])
def s01_read_reordered(spark, sf):
    """The file's columns stand in another order than the schema's, with one it lacks, and
    a number is written as NaN."""
    from pyspark.sql.types import _parse_datatype_string
    c = FX.table(spark, sf, "customer")
    nan = F.when(F.col("c_custkey") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    path = scratch_path(spark, "csv")
    (c.select(nan.alias("C_AcctBal"), F.col("c_name").alias("EXTRA"), "c_mktsegment", "c_custkey")
     .write.option("header", True).option("escape", '"').csv(path))
    return IO.read_table(spark, path, _parse_datatype_string(
        "c_custkey bigint, c_acctbal double, c_mktsegment string"))


@register("s01_read_inferred", """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       c_custkey % 2 = 0 AS even FROM customer""", doubles=["c_acctbal"])
def s01_read_inferred(spark, sf):
    """Without a schema: types come after the missing-value tokens are nulled."""
    c = FX.table(spark, sf, "customer")
    k = F.col("c_custkey")
    path = scratch_path(spark, "csv")
    (c.select(k.alias("C_CUSTKEY"),
              F.when(k % 7 == 0, F.lit("NA")).otherwise(F.col("c_acctbal").cast("string"))
              .alias("C_ACCTBAL"),
              F.when(k % 5 == 0, F.lit("#N/A")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
              (k % 2 == 0).alias("EVEN"))
     .write.option("header", True).option("escape", '"').csv(path))
    return IO.read_table(spark, path)


@register("s02_write_read_result", with_ctes(FX.RAW_TRACKS_CTE) + f""",
t AS (SELECT year({FX.PARSE_DATE_SQL.format(c="first_week")}) AS year,
             CAST(coalesce(popularity >= 400000.0, false) AS INTEGER) AS hit FROM raw_tracks)
SELECT year, count(hit) AS count, avg(CAST(hit AS DOUBLE)) AS rate,
       CAST(year > 2000 AS INTEGER) AS is_future, 'natural' AS run
FROM t WHERE year IS NOT NULL GROUP BY year HAVING count(hit) >= 10""", doubles=["rate"])
def s02_write_read_result(spark, sf):
    """A result written per run (S2) and read back (S3); a second run never clobbers it."""
    from harrow.operators import profile as A
    df = C.add_label(FX.raw_tracks(spark, sf), "popularity", FX.LABEL_THRESHOLD)
    res = A.rate_by_year(df, "first_week", "hit", 10, FX.NOW, FX.DATE_FORMATS)
    base = scratch_path(spark, "results")
    IO.write_result(res, base, "rate_by_year", "natural")
    IO.write_result(res.withColumn("rate", F.col("rate") / 2), base, "rate_by_year", "balanced")
    return IO.read_result(spark, base, "rate_by_year", "natural")


def _write_wavs(root: str):
    """Every row's samples as a WAV file under its label's folder, written by the tasks.
    A repeated attempt writes the same bytes again."""
    def run(batches):
        import io as bytes_io
        import re
        import wave

        import numpy as np
        import pandas as pd
        from pyarrow import fs
        files, base = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", root))
        for batch in batches:
            for key, folder, samples in zip(batch["vec_id"], batch["folder"], batch["embedding"],
                                            strict=True):
                buf = bytes_io.BytesIO()
                with wave.open(buf, "wb") as w:
                    w.setnchannels(1)
                    w.setsampwidth(2)
                    w.setframerate(G.SAMPLE_RATE)
                    w.writeframes((np.clip(samples, -1, 1) * 32767).astype(np.int16).tobytes())
                files.create_dir(f"{base}/{folder}", recursive=True)
                with files.open_output_stream(f"{base}/{folder}/{key}.wav") as out:
                    out.write(buf.getvalue())
            yield pd.DataFrame({"n": [len(batch)]})
    return run


@register("s04_read_audio_library", """
SELECT vec_id, CAST(label = 0 AS INTEGER) AS label, 44 + 2 * len(embedding) AS length,
       (SELECT count(*) FROM embeddings WHERE label = 0) AS hit,
       (SELECT count(*) FROM embeddings WHERE label <> 0) AS not_hit, 1 AS ready FROM embeddings""")
def s04_read_audio_library(spark, sf):
    """The sample arrays as WAV files in a labelled folder tree, listed and counted."""
    from harrow.operators.joins import attach
    root = scratch_path(spark, "audio")
    emb = FX.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("label") == 0, "hit").otherwise("not_hit").alias("folder"))
    emb.mapInPandas(_write_wavs(root), "n long").agg(F.sum("n")).collect()
    files, counts = IO.read_audio_library(spark, root)
    key = F.regexp_extract("path", r"/([0-9]+)\.wav$", 1).cast("long")
    return attach(files.select(key.alias("vec_id"), "label", "length"), counts)


# --- streaming -------------------------------------------------------------------------

from harrow.streaming import stream as X  # noqa: E402


def _stage_slices(spark, df, micros, n: int = 6) -> str:
    """Rows written as ``n`` slices in time order, one after another, so the file source
    (oldest file first) replays them as a live feed would arrive.  A slice is as many files as
    the planner gives it."""
    path = scratch_path(spark, "stage")
    cuts = df.select(micros.alias("s")).approxQuantile("s", [i / n for i in range(1, n)], 0.001)
    bounds = [None] + cuts + [None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (micros > F.lit(int(lo)))
        if hi is not None:
            cond = cond & (micros <= F.lit(int(hi)))
        df.filter(cond).write.mode("append").parquet(path)
    return path


def _stage_events(spark, sf, with_repeats: bool) -> str:
    """Events (plus repeated ids, optionally) staged so the stream runs over many
    micro-batches."""
    ev = FX.table(spark, sf, "events")
    if with_repeats:
        ev = ev.unionByName(ev.filter(F.col("event_id") % 10 == 0))
    return _stage_slices(spark, ev, F.unix_micros(F.col("ts").cast("timestamp")))


def stream_scorer(df):
    """A fixed logistic scorer on ``value`` (M12's contract) plus the verdict."""
    p = 1 / (1 + F.exp(-(F.col("value") - 50) / 20))
    return df.select("event_id", p.alias("hit_potential"),
                     (p >= 0.5).cast("int").alias("predicted_hit"),
                     C.verdict_band(p).alias("verdict"))


@register("x01_score_stream", """
SELECT event_id, 1 / (1 + exp(-(value - 50) / 20)) AS hit_potential,
       CAST(1 / (1 + exp(-(value - 50) / 20)) >= 0.5 AS INTEGER) AS predicted_hit,
       CASE WHEN 100 / (1 + exp(-(value - 50) / 20)) >= 70 THEN '🔥 BANGER'
            WHEN 100 / (1 + exp(-(value - 50) / 20)) >= 40 THEN '😴 SLEEPER'
            ELSE '💀 FLOP' END AS verdict
FROM events""", doubles=["hit_potential"])
def x01_score_stream(spark, sf):
    stage = _stage_events(spark, sf, False)
    schema = FX.table(spark, sf, "events").schema
    sink, ckpt = scratch_path(spark, "x1-sink"), scratch_path(spark, "x1-ckpt")
    X.score_stream(X.file_stream(spark, stage, schema, 4), stream_scorer, sink, ckpt)
    return spark.read.parquet(sink)


@register("x02_history_stats_stream", """
WITH d AS (SELECT DISTINCT event_id, ts, event_type, value / 100 AS score FROM events)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       avg(score) AS mean_score, max(score) AS max_score,
       count(*) FILTER (WHERE score >= 0.5) AS n_positive,
       avg(CAST(event_type = 'purchase' AS DOUBLE)) AS label_rate
FROM d GROUP BY 1""", doubles=["mean_score", "max_score", "label_rate"])
def x02_history_stats_stream(spark, sf):
    stage = _stage_events(spark, sf, True)
    schema = FX.table(spark, sf, "events").schema
    src = X.file_stream(spark, stage, schema, 4).withColumn("score", F.col("value") / 100)
    sink, ckpt = scratch_path(spark, "x2-sink"), scratch_path(spark, "x2-ckpt")
    X.history_stats_stream(src, "ts", "event_id", "score", F.col("event_type") == "purchase",
                           sink, ckpt)
    return X.latest_per_window(spark, sink)


def _event_bundle(spark, sf, rows, root, c):
    """A model of purchases by value, published as the next version."""
    from harrow.ml import models as M
    from harrow.ml.bundle import bundle_metadata
    model = M.fit_pipeline(rows, ["value"], [], "bought", "event_id", "logistic_regression",
                           "balanced", {"C": c})
    return X.publish_bundle(model.pipeline(), bundle_metadata(rows, ["value"], [], "bought"),
                            {"model_name": "logistic_regression"}, root)


@register("x01_score_stream_bundle", """
SELECT event_id, CAST(1 + event_id % 2 AS INTEGER) AS bundle_version, CAST(0 AS DOUBLE) AS gap,
       1 AS times FROM events""", doubles=["gap"])
def x01_score_stream_bundle(spark, sf):
    """A stream scored by saved bundles: even events arrive, are scored by version 1, a restart
    finds nothing new; then version 2 is published and odd events arrive.  Per event: the
    version, how far its score is from scoring the whole table with that version, and how often
    it was scored."""
    from harrow.ml.models import probability_of_positive
    from harrow.sources.io import load_bundle
    ev = FX.table(spark, sf, "events").withColumn(
        "bought", (F.col("event_type") == "purchase").cast("int"))
    root, stage, sink, ckpt = (scratch_path(spark, f"x1-{n}") for n in ("root", "stage", "sink", "ckpt"))
    for part, c in ((0, 1.0), (1, 0.0001)):
        _event_bundle(spark, sf, ev, root, c)
        ev.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(stage)
        for _ in range(2):
            X.score_stream_bundle(X.file_stream(spark, stage, ev.schema, 4), root, sink, ckpt)
    whole = None
    for version in (1, 2):
        x = load_bundle(spark, f"{root}/v{version:06d}")[0].transform(ev)
        x = x.select("event_id", F.lit(version).alias("bundle_version"),
                     probability_of_positive(x).alias("p"))
        whole = x if whole is None else whole.unionByName(x)
    return (X.read_scores(spark, sink).join(whole, ["event_id", "bundle_version"])
            .groupBy("event_id", "bundle_version")
            .agg(F.max(F.abs(F.col("hit_potential") - F.col("p"))).alias("gap"),
                 F.count(F.lit(1)).cast("int").alias("times")))


@register("w07_stream_consecutive_repeats", with_ctes(REPEAT_SQL) + """,
s AS (SELECT *, lag(mode) OVER w AS pm, lag(score) OVER w AS ps, lag(detail) OVER w AS pd,
             lag(1) OVER w AS has_prev
      FROM rep WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, id))
SELECT id, user_id, mode, score, detail FROM s
WHERE has_prev IS NULL OR NOT (mode IS NOT DISTINCT FROM pm AND score IS NOT DISTINCT FROM ps
                               AND detail IS NOT DISTINCT FROM pd)""",
          doubles=["score"])
def w07_stream_consecutive_repeats(spark, sf):
    """W7 over the log as a stream of many micro-batches, stopped and started again."""
    log = repeated_log(spark, sf)
    stage = _stage_slices(spark, log, F.col("timestamp"))
    sink, ckpt = scratch_path(spark, "w7-sink"), scratch_path(spark, "w7-ckpt")
    for _ in range(2):
        X.drop_repeats_stream(X.file_stream(spark, stage, log.schema, 4), ["user_id"],
                              ["timestamp", "id"], ["mode", "score", "detail"], sink, ckpt)
    return spark.read.schema(log.schema).parquet(sink).select("id", "user_id", "mode", "score", "detail")
