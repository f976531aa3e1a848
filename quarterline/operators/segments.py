"""Trading segments and boundary context.

All per-contract scans share the window ``partitionBy(asset).orderBy(ts)``; the
panel is hash-partitioned by contract once and every operator here reuses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import with_is_trading
from .chunks import boundary_flag_chunked, with_segments_chunked


def by_asset(keys=("asset",)):
    return Window.partitionBy(*keys).orderBy("ts")


def with_changes(df: DataFrame, keys=("asset",)) -> DataFrame:
    """First difference of ``is_trading`` with an initial 0: +1 start, -1 stop.

    ``keys`` is the series key (e.g. ``("split", "asset")`` to treat each split on its own)."""
    df = with_is_trading(df, "volume")
    return df.withColumn("change", F.col("is_trading") - F.lag("is_trading", 1, 0).over(by_asset(keys)))


def with_position(df: DataFrame, col: str = "pos") -> DataFrame:
    """0-based row position per contract in time order."""
    return df.withColumn(col, (F.row_number().over(by_asset()) - 1).cast("long"))


def with_segments(df: DataFrame, keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """W5 (without the length filter): ``segment_id`` (running count of starts) for trading rows,
    and ``segment_length`` = rows of that island. Non-trading rows get NULLs.

    True islands of consecutive trading rows, including one that begins on the first row.
    With ``chunk_seconds`` a contract's rows are spread over (contract, chunk) tasks (:mod:`chunks`).
    """
    if chunk_seconds:
        return with_segments_chunked(df, keys, chunk_seconds)
    df = with_changes(df, keys)
    running_ = by_asset(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_sid", F.sum((F.col("change") == 1).cast("long")).over(running_))
    seg = F.when(F.col("is_trading") == 1, F.col("_sid"))
    df = df.withColumn("segment_id", seg)
    # partitioned by (keys, segment_id): satisfied by the existing hash partitioning on the keys
    length = F.count(F.lit(1)).over(Window.partitionBy(*keys, "segment_id"))
    return df.withColumn("segment_length", F.when(F.col("is_trading") == 1, length).cast("long")).drop("_sid")


def trading_segments(df: DataFrame, min_segment_length: int = 96, keys=("asset",),
                     chunk_seconds: int | None = None) -> DataFrame:
    """Rows of trading islands with at least ``min_segment_length`` rows (U2: the
    segments of a contract are simply its rows with a segment id)."""
    return with_segments(df, keys, chunk_seconds).filter(F.col("segment_length") >= min_segment_length)


def segment_stats(df: DataFrame, min_segment_length: int = 96, chunk_seconds: int | None = None) -> DataFrame:
    """A10: per contract total rows, rows in kept segments, number of kept segments,
    average kept length and the original trading ratio; contracts without a kept segment omitted."""
    s = with_segments(df, chunk_seconds=chunk_seconds)
    kept = F.col("segment_length") >= min_segment_length
    per_asset = s.groupBy("asset").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(kept, 1).otherwise(0)).cast("long").alias("trading_rows"),
        F.sum(F.when(kept & (F.col("change") == 1), 1).otherwise(0)).cast("long").alias("n_segments"),
        F.avg("is_trading").alias("trading_ratio_original"))
    return (per_asset.filter(F.col("n_segments") > 0)
            .withColumn("avg_segment_length", F.col("trading_rows") / F.col("n_segments"))
            .select("asset", "total_rows", "trading_rows", "n_segments", "avg_segment_length",
                    "trading_ratio_original"))


def select_best(stats: DataFrame, target_total_rows: int = 50_000, target_n_assets: int = 5) -> DataFrame:
    """Contracts by kept trading rows (desc, name asc on ties); take them in order while
    fewer than N are taken, stopping once the running total reaches the target.

    Runs on the per-contract summary (one row per contract).
    """
    order = Window.orderBy(F.desc("trading_rows"), "asset")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (stats.withColumn("rank", F.row_number().over(order))
                   .withColumn("rows_before", F.coalesce(F.sum("trading_rows").over(before), F.lit(0)).cast("long")))
    chosen = ranked.filter((F.col("rank") <= target_n_assets) & (F.col("rows_before") < target_total_rows))
    return chosen.withColumn("cumulative_rows", F.col("rows_before") + F.col("trading_rows")).drop("rows_before")


def boundary_flag(df: DataFrame, window_before: int = 4, window_after: int = 4, keys=("asset",),
                  chunk_seconds: int | None = None) -> DataFrame:
    """``keep_boundary`` = trading row, or within ``before`` rows ahead of a start,
    or the stop row and the ``after`` rows following it."""
    if chunk_seconds:
        return boundary_flag_chunked(df, window_before, window_after, keys, chunk_seconds)
    df = with_changes(df, keys)
    start = (F.col("change") == 1).cast("int")
    stop = (F.col("change") == -1).cast("int")
    near_start = F.max(start).over(by_asset(keys).rowsBetween(0, window_before)) == 1
    after_stop = F.max(stop).over(by_asset(keys).rowsBetween(-window_after, 0)) == 1
    return df.withColumn("keep_boundary", (F.col("is_trading") == 1) | near_start | after_stop)


def window_counts(df: DataFrame, input_chunk_length: int, output_chunk_length: int) -> DataFrame:
    """Windows per contract max(0, n - L_in - L_out + 1)."""
    span = input_chunk_length + output_chunk_length
    return (df.groupBy("asset").agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("n_windows", F.greatest(F.lit(0), F.col("n_rows") - F.lit(span - 1)).cast("long")))
