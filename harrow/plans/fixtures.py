"""Stand-ins for the reference's inputs, derived from the driver tables.

The driver tables carry no nulls, duplicates, text dates or scores, so the frames
below inject them deterministically from the keys.  Every builder has an SQL twin
(DuckDB dialect) so the oracle sees exactly the same rows.

* ``raw_tracks``  - the "track table": orders x customer x nation, plus per-order
  line aggregates (left join: some orders have no lines, so real nulls appear),
  mixed-format text dates, injected nulls and exact duplicate rows.
* ``clean_tracks`` - ``raw_tracks`` after the cleaning step (P6) at ``NOW``.
* ``scored``      - a scored holdout without a model: label from the price,
  score from the customer balance (ties within a customer), a group column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values for the driver-table mapping.
NOW = dt.datetime(2000, 12, 31)
NOW_SQL = "TIMESTAMP '2000-12-31 00:00:00'"
LABEL_THRESHOLD = 400000.0
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy")
DATE_FORMATS_SQL = ("%Y-%m-%d", "%m/%d/%Y")
SEED = 42

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(key, mod: int, rem: int, value):
    return F.when(key % mod == rem, F.lit(None)).otherwise(value)


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = (table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"),
                  F.sum("l_quantity").alias("qty"),
                  F.max("l_discount").alias("max_disc"),
                  F.min("l_tax").alias("min_tax"),
                  F.max("l_extendedprice").alias("max_price")))
    joined = (orders
              .join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, customer.c_nationkey == nation.n_nationkey)
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    key = F.col("o_orderkey")
    first_week = (F.when(key % 97 == 5, F.lit("n/a"))
                  .when(key % 3 == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
                  .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    base = joined.select(
        key.alias("track_key"),
        F.col("o_custkey").alias("artist_key"),
        F.col("c_name").alias("artist"),
        first_week.alias("first_week"),
        F.col("o_totalprice").alias("popularity"),
        _null_when(key, 9, 4, F.col("o_orderpriority")).alias("genre"),
        F.col("n_name").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_acctbal").alias("acctbal"),
        _null_when(key, 6, 0, F.col("qty")).alias("energy"),
        _null_when(key, 6, 0, F.col("max_disc")).alias("danceability"),
        _null_when(key, 6, 0, F.col("min_tax")).alias("loudness"),
        _null_when(key, 6, 0, F.col("max_price")).alias("tempo"),
        F.col("n_lines"),
    )
    # Exact duplicates for every 50th key, made in the same pass (no second scan).
    copies = F.when(F.col("track_key") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return base.withColumn("__copy", F.explode(copies)).drop("__copy")


RAW_TRACKS_CTE = """
li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, max(l_discount) AS max_disc,
         min(l_tax) AS min_tax, max(l_extendedprice) AS max_price
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey AS track_key, o.o_custkey AS artist_key, c.c_name AS artist,
         CASE WHEN o.o_orderkey % 97 = 5 THEN 'n/a'
              WHEN o.o_orderkey % 3 = 1 THEN strftime(o.o_orderdate, '%m/%d/%Y')
              ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS first_week,
         o.o_totalprice AS popularity,
         CASE WHEN o.o_orderkey % 9 = 4 THEN NULL ELSE o.o_orderpriority END AS genre,
         n.n_name AS nation, c.c_mktsegment AS segment, o.o_orderstatus AS status,
         c.c_acctbal AS acctbal,
         CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE li.qty END AS energy,
         CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE li.max_disc END AS danceability,
         CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE li.min_tax END AS loudness,
         CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE li.max_price END AS tempo,
         li.n_lines AS n_lines
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey),
raw_tracks AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE track_key % 50 = 0)
"""

PARSE_DATE_SQL = ("coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'))")

CLEAN_TRACKS_CTE = RAW_TRACKS_CTE + """,
dedup AS (SELECT DISTINCT * FROM raw_tracks),
clean_tracks AS (
  SELECT * REPLACE (""" + PARSE_DATE_SQL.format(c="first_week") + """ AS first_week)
  FROM dedup
  WHERE """ + PARSE_DATE_SQL.format(c="first_week") + """ IS NOT NULL
    AND """ + PARSE_DATE_SQL.format(c="first_week") + " <= " + NOW_SQL + """)
"""

# Labelled, cleaned track table: the usual model input.
LABELLED_CTE = CLEAN_TRACKS_CTE + """,
labelled AS (SELECT *, CAST(coalesce(popularity >= 400000.0, false) AS INTEGER) AS hit
             FROM clean_tracks)
"""


def clean_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harrow.operators.clean import clean
    return clean(raw_tracks(spark, sf_dir), "first_week", NOW, DATE_FORMATS)


def labelled_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harrow.functions.columns import add_label
    return add_label(clean_tracks(spark, sf_dir), "popularity", LABEL_THRESHOLD, "hit")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored holdout stand-in: y_true, y_pred, y_score, group (nullable), cust_group."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .join(nation, customer.c_nationkey == nation.n_nationkey))
    score = (F.col("c_acctbal") + 1000) / 11000
    key = F.col("o_orderkey")
    return j.select(
        key.alias("row_key"),
        (F.col("o_totalprice") >= LABEL_THRESHOLD).cast("int").alias("y_true"),
        (score >= 0.5).cast("int").alias("y_pred"),
        score.alias("y_score"),
        _null_when(key, 9, 4, F.col("n_name")).alias("group"),
        F.col("o_custkey").cast("string").alias("cust_group"),
    )


SCORED_CTE = """
scored AS (
  SELECT o.o_orderkey AS row_key,
         CAST(o.o_totalprice >= 400000.0 AS INTEGER) AS y_true,
         CAST((c.c_acctbal + 1000) / 11000 >= 0.5 AS INTEGER) AS y_pred,
         (c.c_acctbal + 1000) / 11000 AS y_score,
         CASE WHEN o.o_orderkey % 9 = 4 THEN NULL ELSE n.n_name END AS "group",
         CAST(o.o_custkey AS VARCHAR) AS cust_group
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""
