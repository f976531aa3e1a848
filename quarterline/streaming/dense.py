"""T2 + J1 as a stream: candles on a dense grid, zero candles for slots without ticks.

Ticks are reduced to candles by event-time windows (partial aggregates, so a hot contract is no hot task); a
closed candle goes on to a stateful processor per contract that keeps one number, the next slot to come out.
It fills the slots before a candle with zero candles, and an event-time timer does so for a contract that has
no ticks for a while, once the watermark has passed the slot. What comes out is final and in order, and each
slot comes out once, so the sink appends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import time_seq_key
from ..schema import TARGETS
from ..session import ensure_utc

_OUT = "asset string, ts timestamp, high double, low double, close double, volume double"
#: The processor's state lives in RocksDB: what state with timers needs, and larger than memory if it must be.
_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _dense_processor(origin_ms: int, step_ms: int):
    # the class is made here so that it travels to the workers by value
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class DenseCandles(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.next = handle.getValueState("next", "slot long")

        def _out(self, asset, slots, values=None):
            n = len(slots)
            frame = {"asset": [asset] * n, "ts": pd.to_datetime(pd.Series(slots, dtype="int64"), unit="ms", utc=True)}
            return pd.DataFrame({**frame, **{c: (values[c] if values is not None else [0.0] * n) for c in ("high", "low", "close", "volume")}})

        def _silent(self, asset, slot, closed_ms):
            """Zero candles for the slots that the watermark has passed, and the slot after them."""
            n = max(0, (closed_ms - slot) // step_ms)
            for k in range(0, n, 10_000):
                yield self._out(asset, [slot + i * step_ms for i in range(k, min(k + 10_000, n))])
            slot += n * step_ms
            self.next.update((slot,))
            self.handle.registerTimer(slot + step_ms)

        def handleInputRows(self, key, rows, timerValues):
            asset = key[0]
            if asset is None:  # clock rows only move the watermark
                for _ in rows:
                    pass
                return
            slot = self.next.get()[0] if self.next.exists() else origin_ms
            got = pd.concat(list(rows)).sort_values("slot_ms")
            for c in got.itertuples(index=False):
                if c.slot_ms < slot:
                    continue  # before the grid
                yield from self._filled(asset, slot, c)
                slot = c.slot_ms + step_ms
            yield from self._silent(asset, slot, timerValues.getCurrentWatermarkInMs())

        def _filled(self, asset, slot, c):
            n = (c.slot_ms - slot) // step_ms
            for k in range(0, n, 10_000):
                yield self._out(asset, [slot + i * step_ms for i in range(k, min(k + 10_000, n))])
            yield self._out(asset, [c.slot_ms], {"high": [c.high], "low": [c.low], "close": [c.close], "volume": [c.volume]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            if self.next.exists():
                yield from self._silent(key[0], self.next.get()[0], timerValues.getCurrentWatermarkInMs())

        def close(self) -> None:
            pass

    return DenseCandles()


def dense_candle_stream(ticks: DataFrame, origin_ms: int, step_seconds: int = 900, lateness: str = "30 minutes") -> DataFrame:
    """ticks: streaming (asset, ts, price, seq) -> (asset, ts, high, low, close, volume) of every slot from ``origin_ms``
    (epoch milliseconds, a slot's start) to the watermark.

    Rows without a contract are clock rows: they move the watermark and nothing else. Ticks later than
    ``lateness`` are dropped by the watermark."""
    window = f"{step_seconds} seconds"
    closed = (ticks.withWatermark("ts", lateness)
              .groupBy("asset", F.window("ts", window).alias("w"))
              .agg(F.max("price").alias("high"), F.min("price").alias("low"),
                   F.max_by("price", time_seq_key("ts", "seq")).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))
              .select("asset", F.window_time("w").alias("t"), F.unix_millis(F.col("w.start")).alias("slot_ms"), *TARGETS))
    return closed.groupBy("asset").transformWithStateInPandas(
        statefulProcessor=_dense_processor(origin_ms, step_seconds * 1000), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")


def stream_dense_candles(spark: SparkSession, landing: str, out: str, checkpoint: str, origin_ms: int, step_seconds: int = 900,
                         lateness: str = "30 minutes", max_files_per_trigger: int | None = None) -> None:
    """Run the dense candle stream over the tick files in ``landing`` (Parquet: asset, ts, price, seq) into the
    append-only table ``out``; a restart with the same ``checkpoint`` goes on where it stopped."""
    ensure_utc(spark)
    reader = spark.readStream.schema("asset string, ts timestamp, price double, seq long")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        q = (dense_candle_stream(reader.parquet(landing), origin_ms, step_seconds, lateness)
             .writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
        q.awaitTermination()
    finally:
        spark.conf.unset(_STORE[0]) if before is None else spark.conf.set(_STORE[0], before)


def write_tick_files(ticks: DataFrame, landing: str, n_files: int, order: Sequence[int], lateness_seconds: int, step_seconds: int = 900) -> int:
    """``ticks`` as ``n_files`` stretches of time written one after the other in ``order``, then a clock row that closes
    the last slot; returns the first slot's start in epoch milliseconds."""
    spark = ticks.sparkSession
    b = ticks.agg(F.min(F.unix_millis("ts")).alias("lo"), F.max(F.unix_millis("ts")).alias("hi")).first()
    step = step_seconds * 1000
    width = (b["hi"] - b["lo"]) // n_files + 1
    for k in order:
        part = ticks.filter(F.floor((F.unix_millis("ts") - b["lo"]) / F.lit(width)) == k)
        part.coalesce(1).write.mode("append").parquet(landing)
    end = (b["hi"] // step + 1) * step + lateness_seconds * 1000
    clock = spark.sql(f"SELECT CAST(NULL AS STRING) AS asset, timestamp_millis({end}) AS ts, 0.0D AS price, 0L AS seq")
    clock.coalesce(1).write.mode("append").parquet(landing)
    return b["lo"] // step * step
