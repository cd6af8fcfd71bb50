"""Catalog enrichment: nested records flattened and joined back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.functions.columns import add_label, parse_release_date
from harrow.operators.joins import lookup_join

# Nested record shapes of the catalog (fixed values).
TRACK_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("preview_url", T.StringType()),
    T.StructField("artists", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))),
    T.StructField("album", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("images", T.ArrayType(T.StructType([
            T.StructField("url", T.StringType())])))])),
])
ARTIST_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("followers", T.StructType([T.StructField("total", T.LongType())])),
    T.StructField("genres", T.ArrayType(T.StringType())),
])


def parse_records(df: DataFrame, text_col: str, schema: T.StructType,
                  alias: str = "r") -> DataFrame:
    """JSON text to a typed struct; null or unparseable records are dropped."""
    parsed = df.select(F.from_json(F.col(text_col), schema).alias(alias))
    return parsed.filter(F.col(alias).isNotNull() & F.col(f"{alias}.id").isNotNull())


def read_records(spark, path: str, schema: T.StructType) -> DataFrame:
    """Newline-delimited JSON files with a fixed schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def first_artist_id(track: str = "track") -> Column:
    return F.get(F.col(f"{track}.artists"), 0).getField("id")


def lookup_first_artist(tracks: DataFrame, artists: DataFrame, track: str = "track",
                        artist: str = "artist") -> DataFrame:
    """Attach the record of each track's first artist; absent gives nulls that
    the flattening step turns into defaults.  Artists are de-duplicated by id first.

    One join: a track without artists takes a key of its own that no artist has, so such tracks
    are spread over the exchange, and the catalog is read once."""
    own = F.concat(F.lit("\u0000"), F.xxhash64(F.col(f"{track}.id")).cast("string"))
    keyed = tracks.withColumns({"__aid": F.coalesce(first_artist_id(track), own),
                                "__has": first_artist_id(track).isNotNull()})
    one = (artists.where(F.col(f"{artist}.id").isNotNull())
           .groupBy(F.col(f"{artist}.id").alias("__id")).agg(F.min(F.col(artist)).alias(artist)))
    same = (F.col("__aid") == F.col("__id")) & F.col("__has")
    return keyed.join(one, same, "left").drop("__aid", "__has", "__id")


def flatten_catalog(joined: DataFrame, track: str = "track", artist: str = "artist") -> DataFrame:
    """One flat row per track with the reference's defaults for absent fields."""
    t = lambda f: F.col(f"{track}.{f}")
    a = lambda f: F.col(f"{artist}.{f}")
    year, month = parse_release_date(F.coalesce(t("album.release_date"), F.lit("")))
    preview = t("preview_url")
    return joined.select(
        t("id").alias("track_id"),
        F.coalesce(t("popularity"), F.lit(0)).alias("track_popularity"),
        F.coalesce(a("popularity"), F.lit(0)).alias("artist_popularity"),
        F.coalesce(a("followers.total"), F.lit(0)).cast("long").alias("artist_followers"),
        F.coalesce(t("duration_ms"), F.lit(0)).cast("long").alias("duration_ms"),
        F.coalesce(t("explicit"), F.lit(False)).cast("int").alias("is_explicit"),
        year.alias("release_year"), month.alias("release_month"),
        F.size(F.coalesce(t("artists"), F.array())).alias("num_artists"),
        F.coalesce(F.get(a("genres"), 0), F.lit("")).alias("primary_genre"),
        (preview.isNotNull() & (preview != "")).cast("int").alias("has_preview"),
    )


def first_per_key(meta: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (then the remaining columns).

    ``min(struct)`` is an aggregate with map-side combine, so a key repeated in a
    third of the rows is reduced before the shuffle."""
    rest = [c for c in meta.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    return (meta.groupBy(key).agg(F.min(packed).alias("__m"))
            .select(key, *[F.col(f"__m.{c}").alias(c) for c in list(order) + rest]))


def enrich_left_join(facts: DataFrame, meta: DataFrame, key: str, order: Sequence[str],
                     keep: Sequence[str] | None = None, score_col: str = "track_popularity",
                     threshold: float = 70, hot_share: float | None = None) -> DataFrame:
    """Meta reduced to one row per key, left-joined to facts, then labelled.

    Where the key of ``facts`` may be hot, ``hot_share`` has keys of that share of the rows
    spread (``lookup_join``, two more passes over the key column); without it the planner
    decides, which is right for keys that are unique or nearly so."""
    one = first_per_key(meta, key, order)
    if keep is not None:
        one = one.select(key, *[c for c in keep if c != key])
    joined = (facts.join(one, key, "left") if hot_share is None
              else lookup_join(facts, one, key, hot_share))
    return add_label(joined, score_col, threshold, "hit")
