"""Nested catalog records (JSON text) derived from ``orders`` and ``customer``.

Tracks come from orders, artists from customers; absent artists, null followers,
empty genre lists, release dates as ``YYYY``, ``YYYY-MM``, ``YYYY-MM-DD``, empty and
non-numeric text are all produced from the keys.  The SQL twins compute the
flattened values straight from the source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.plans.fixtures import table


def track_json(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    k = F.col("o_orderkey")
    release = (F.when(k % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
               .when(k % 5 == 1, F.date_format("o_orderdate", "yyyy"))
               .when(k % 5 == 2, F.date_format("o_orderdate", "yyyy-MM"))
               .when(k % 5 == 3, F.lit("")).otherwise(F.lit("unknown")))
    artists = F.when(k % 10 == 7, F.array().cast("array<struct<id:string,name:string>>")) \
        .otherwise(F.array(F.struct(F.concat(F.lit("a"), F.col("o_custkey").cast("string"))
                                    .alias("id"), F.col("c_name").alias("name"))))
    rec = F.struct(
        F.concat(F.lit("t"), k.cast("string")).alias("id"),
        F.concat(F.lit("track "), k.cast("string")).alias("name"),
        (F.col("o_totalprice") / 5000).cast("int").alias("popularity"),
        (F.col("o_custkey") * 1000).alias("duration_ms"),
        (k % 2 == 0).alias("explicit"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("http://p/"), k.cast("string"))).alias("preview_url"),
        artists.alias("artists"),
        F.struct(F.lit("album").alias("name"), release.alias("release_date"),
                 F.array().cast("array<struct<url:string>>").alias("images")).alias("album"))
    return j.select(F.to_json(rec).alias("value"))


def artist_json(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    rec = F.struct(
        F.concat(F.lit("a"), k.cast("string")).alias("id"),
        (F.col("c_nationkey") * 4).alias("popularity"),
        F.when(k % 7 == 0, F.lit(None).cast("struct<total:bigint>"))
        .otherwise(F.struct((k * 10).alias("total"))).alias("followers"),
        F.when(k % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("c_mktsegment"))).alias("genres"))
    # Customers with key % 11 == 3 are missing from the artist catalog.
    return c.filter(k % 11 != 3).select(F.to_json(rec).alias("value"))


def _digits(expr: str) -> str:
    return f"CASE WHEN regexp_full_match({expr}, '[0-9]+') THEN CAST({expr} AS INTEGER) ELSE 0 END"


RELEASE_SQL = """CASE WHEN o.o_orderkey % 5 = 0 THEN strftime(o.o_orderdate, '%Y-%m-%d')
                   WHEN o.o_orderkey % 5 = 1 THEN strftime(o.o_orderdate, '%Y')
                   WHEN o.o_orderkey % 5 = 2 THEN strftime(o.o_orderdate, '%Y-%m')
                   WHEN o.o_orderkey % 5 = 3 THEN '' ELSE 'unknown' END"""

FLAT_SQL = f"""
rel AS (SELECT o.*, {RELEASE_SQL} AS rd FROM orders o),
art AS (SELECT 'a' || CAST(c_custkey AS VARCHAR) AS aid, c_nationkey * 4 AS popularity,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey * 10 END AS followers,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS genre0
        FROM customer WHERE c_custkey % 11 != 3),
flat AS (
  SELECT 't' || CAST(o.o_orderkey AS VARCHAR) AS track_id,
         CAST(trunc(o.o_totalprice / 5000) AS INTEGER) AS track_popularity,
         coalesce(a.popularity, 0) AS artist_popularity,
         CAST(coalesce(a.followers, 0) AS BIGINT) AS artist_followers,
         CAST(o.o_custkey * 1000 AS BIGINT) AS duration_ms,
         CAST(o.o_orderkey % 2 = 0 AS INTEGER) AS is_explicit,
         {_digits("split_part(rd, '-', 1)")} AS release_year,
         {_digits("split_part(rd, '-', 2)")} AS release_month,
         CASE WHEN o.o_orderkey % 10 = 7 THEN 0 ELSE 1 END AS num_artists,
         coalesce(CASE WHEN o.o_orderkey % 10 = 7 THEN NULL ELSE a.genre0 END, '') AS primary_genre,
         CASE WHEN o.o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS has_preview
  FROM rel o
  LEFT JOIN art a ON a.aid = CASE WHEN o.o_orderkey % 10 = 7 THEN NULL
                                  ELSE 'a' || CAST(o.o_custkey AS VARCHAR) END)"""
