"""Structured Streaming variants of batch operators.

Both read a file source incrementally and write with a checkpoint in the shared
checkpoint folder, so a restarted query resumes exactly where it stopped.  X2 is a
windowed aggregate with a watermark and de-duplication within the watermark; its
updates are appended per micro-batch and the reader keeps the latest row per window,
which makes the sink idempotent under retries.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from harrow.functions.columns import verdict_band
from harrow.sources.io import load_bundle, path_exists, save_bundle


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int = 1) -> DataFrame:
    """An incremental parquet source (new files are picked up per trigger)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], sink: str,
                 checkpoint: str, available_now: bool = True):
    """A per-row scorer (M12 + P16) applied to every micro-batch, appended to a
    parquet sink (exactly once through the sink's commit log)."""
    scored = scorer(stream)
    writer = (scored.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def history_stats_stream(stream: DataFrame, ts: str, id_col: str, score: str, label: Column,
                         sink: str, checkpoint: str, window: str = "1 day",
                         watermark: str = "1 day", available_now: bool = True):
    """Per tumbling window: count, mean, max, count at or above 0.5 and the label
    rate, after dropping repeated ids within the watermark."""
    events = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    deduped = events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([id_col])
    agg = (deduped.groupBy(F.window(ts, window).alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
                F.max(score).alias("max_score"),
                F.count_if(F.col(score) >= 0.5).alias("n_positive"),
                F.avg(label.cast("double")).alias("label_rate")))
    out = agg.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                     "n", "mean_score", "max_score", "n_positive", "label_rate")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(sink)

    writer = (out.writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def latest_per_window(spark: SparkSession, sink: str, key: str = "window_start") -> DataFrame:
    """Read X2's update log and keep the last update of each window."""
    log = spark.read.parquet(sink)
    cols = [c for c in log.columns if c not in (key, "batch_id")]
    best = log.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("s"))
    return best.select(key, *[F.col(f"s.{c}").alias(c) for c in cols])


# X1 from saved bundles -------------------------------------------------------------
def publish_bundle(model, metadata: DataFrame, info: dict, root: str) -> int:
    """S6 as a numbered version under ``root``; the marker that makes it visible to running
    streams is written last.  One publisher at a time."""
    spark = metadata.sparkSession
    version = (newest_bundle(spark, root) or 0) + 1
    save_bundle(model, metadata, info, f"{root}/v{version:06d}")
    spark.createDataFrame([(version,)], "version int").write.mode("append").parquet(
        f"{root}/published")
    return version


def newest_bundle(spark: SparkSession, root: str) -> int | None:
    """The highest published version, if any."""
    if not path_exists(spark, f"{root}/published"):
        return None
    return spark.read.schema("version int").parquet(f"{root}/published").agg(F.max("version")).first()[0]


def score_stream_bundle(stream: DataFrame, root: str, sink: str, checkpoint: str,
                        available_now: bool = True):
    """X1 with S6: every micro-batch is scored by the newest bundle published under ``root``.

    A batch notes its version before it scores and writes to a folder of its own, which a replay
    replaces using the noted version: after a restart nothing is scored twice, and no batch mixes
    versions.  Adds ``hit_potential``, ``predicted_hit``, ``verdict`` and ``bundle_version``; read
    the rows with ``read_scores``."""
    loaded: dict[int, object] = {}

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = f"{sink}/versions/batch_id={batch_id}"
        if path_exists(spark, f"{note}/_SUCCESS"):
            version = spark.read.parquet(note).first()["version"]
        else:
            version = newest_bundle(spark, root)
            if version is None:
                raise FileNotFoundError(f"no bundle published in {root}")
            spark.createDataFrame([(version,)], "version int").write.mode("overwrite").parquet(note)
        if version not in loaded:
            loaded.clear()
            loaded[version] = load_bundle(spark, f"{root}/v{version:06d}")[0]
        x = loaded[version].transform(batch)
        p = vector_to_array(F.col("probability"))[1]
        (x.select(*batch.columns, p.alias("hit_potential"), (p >= 0.5).cast("int").alias("predicted_hit"),
                  verdict_band(p).alias("verdict"), F.lit(version).alias("bundle_version"))
         .write.mode("overwrite").parquet(f"{sink}/scores/batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_scores(spark: SparkSession, sink: str) -> DataFrame:
    """All scored rows of ``score_stream_bundle``, with their ``batch_id``."""
    return spark.read.parquet(f"{sink}/scores")


# W7 over a live log -----------------------------------------------------------------
# Groups of partitions; fixed, since a running stream's state is kept by them.
BUCKETS = 1024


def drop_repeats_stream(stream: DataFrame, partition: Sequence[str], order: Sequence[str],
                        signature: Sequence[str], sink: str, checkpoint: str,
                        forget_after_ms: int | None = None, available_now: bool = True):
    """W7 as a stateful stream: a record whose signature equals that of the record before it in
    its partition is dropped (null-safe), also when that one came in an earlier micro-batch.

    The state of a partition is a digest of its last signature; partitions share ``BUCKETS``
    groups by hash, so that Python is called for a group of many and not for each.  Within a
    micro-batch records are taken in ``order``; one that arrives later than its successors is
    compared with the last one seen.  With ``forget_after_ms`` an idle partition's state is
    dropped, and its next record is a first one.  The parquet sink's commit log makes the result
    exactly once."""
    def digest(cols: Sequence[str]) -> Column:
        return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)

    marked = stream.withColumns({"__s": digest(signature), "__p": digest(partition)})
    marked = marked.withColumn("__b", F.pmod(F.xxhash64("__p"), F.lit(BUCKETS)))

    def keep(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Last signature of each partition and when it came.
        last = json.loads(state.get[0]) if state.exists else {}
        now = state.getCurrentProcessingTimeMs() if forget_after_ms else 0
        if forget_after_ms:
            last = {p: v for p, v in last.items() if v[1] + forget_after_ms > now}
        rows = None
        if not state.hasTimedOut:
            rows = pd.concat(list(batches), ignore_index=True)
            rows = rows.sort_values(["__p", *order], kind="stable")
            p, before = rows["__p"], rows["__s"].shift(1)
            first, end = p != p.shift(1), p != p.shift(-1)
            before[first] = [last.get(k, (None,))[0] for k in p[first]]
            last.update({k: (v, now) for k, v in zip(p[end], rows["__s"][end], strict=True)})
            rows = rows[rows["__s"] != before].drop(columns=["__s", "__p", "__b"])
        if not last:
            state.remove()
        else:
            state.update((json.dumps(last),))
            if forget_after_ms:
                state.setTimeoutDuration(forget_after_ms)
        if rows is not None:
            yield rows

    timeout = (GroupStateTimeout.ProcessingTimeTimeout if forget_after_ms
               else GroupStateTimeout.NoTimeout)
    kept = marked.groupBy("__b").applyInPandasWithState(
        keep, stream.schema, "signatures string", "append", timeout)
    writer = (kept.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
