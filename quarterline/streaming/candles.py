"""HLCV candles from a tick stream with event-time windows and a watermark.

The aggregation runs in ``update`` mode: every micro-batch emits the current candle of
each (contract, window) it touched, tagged with the batch id, and the state of windows
older than the watermark is dropped. The latest version of each candle is the result
(``latest_candles``), exact for ticks inside the lateness bound.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contracts import contract_name_for_int
from ..functions.ordering import time_seq_key
from ..session import ensure_utc


def candle_stream(ticks: DataFrame, window: str = "15 minutes", lateness: str = "30 minutes") -> DataFrame:
    """ticks: streaming (asset, ts, price, seq) -> (asset, window start, high, low, close, volume)."""
    return (ticks.withWatermark("ts", lateness)
            .groupBy("asset", F.window("ts", window).alias("w"))
            .agg(F.max("price").alias("high"), F.min("price").alias("low"),
                 F.max_by("price", time_seq_key("ts", "seq")).alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume"))
            .select("asset", F.col("w.start").alias("ts"), "high", "low", "close", "volume"))


def stream_event_candles(spark: SparkSession, events_path: str, out: str, checkpoint: str,
                         window: str = "15 minutes", n_contracts: int = 24, lateness: str = "30 minutes",
                         max_files_per_trigger: int | None = None) -> int:
    """Run the candle stream over the ``events`` files (availableNow) into an append-only table
    of candle versions (asset, ts, ..., batch_id); returns the rows that came too late.

    Without ``max_files_per_trigger`` the whole backlog is one micro-batch: files in any order of
    time are complete, since the watermark moves only between batches. With a limit, files should
    arrive in order of time up to ``lateness``; what is later is dropped by the watermark and counted.
    """
    ensure_utc(spark)
    schema = spark.read.parquet(events_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a file source streams a folder: the table's own, or a single file's with a filter on its name
    folder, _, name = events_path.rstrip("/").rpartition("/")
    if events_path.rstrip("/") in {f.rstrip("/") for f in _plain(spark.read.parquet(events_path).inputFiles(), events_path)}:
        ev = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        ev = reader.parquet(events_path)
    ticks = ev.select(contract_name_for_int(F.pmod(F.col("user_id"), F.lit(n_contracts))).alias("asset"),
                      F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"),
                      F.col("event_id").alias("seq"))
    candles = candle_stream(ticks, window, lateness)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    # the progress of every batch is kept for the count of late rows, not of the last hundred
    keep, before = "spark.sql.streaming.numRecentProgressUpdates", spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None)
    spark.conf.set(keep, "1000000")
    try:
        q = (candles.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(sink).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(keep) if before is None else spark.conf.set(keep, before)
    return sum(int(s["numRowsDroppedByWatermark"]) for p in q.recentProgress for s in p["stateOperators"])


def _plain(files: list[str], like: str) -> list[str]:
    """Input files in the form of ``like``: a plain path names no scheme."""
    return files if "://" in like or like.startswith("file:") else [re.sub(r"^file:/+", "/", f) for f in files]


def latest_candles(versions: DataFrame) -> DataFrame:
    """Final candle per (contract, window): the version from the latest micro-batch.

    One ``max_by`` per field keyed by the batch id (unique per candle), so the buffers stay
    fixed-width and the aggregate is a hash aggregate.
    """
    return versions.groupBy("asset", "ts").agg(
        *[F.max_by(c, "batch_id").alias(c) for c in ("high", "low", "close", "volume")])
