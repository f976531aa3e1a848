"""Supervised windows and batching.

Windows are cut by row position per contract. Building arrays multiplies the data by
``L_in + L_out``; metric paths use :mod:`quarterline.operators.forecast` instead,
which reads future values with ``lead`` and never materialises arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import WindowParams
from .segments import with_position


def by_asset():
    return Window.partitionBy("asset").orderBy("ts")


# window_id = contract index * 2^32 + start position
ID_SHIFT = 1 << 32


def window_id(idx: Column, start: Column) -> Column:
    return idx.cast("long") * F.lit(ID_SHIFT) + start.cast("long")


def with_asset_index(df: DataFrame) -> DataFrame:
    from .features import asset_dimension
    from ..functions.joins import join_small
    dim = asset_dimension(df).select("asset", "idx")
    return join_small(df, dim, on="asset", how="left")


def window_starts(df: DataFrame, p: WindowParams) -> DataFrame:
    """Rows that start a window: position % stride == 0 and enough rows follow.

    Adds ``pos``, ``n_rows`` and ``start_pos``; contracts shorter than ``min_rows`` are skipped.
    """
    span = p.input_chunk_length + p.output_chunk_length
    d = with_position(df).withColumn("n_rows", F.count(F.lit(1)).over(Window.partitionBy("asset")))
    ok = ((F.col("pos") % p.stride == 0) & (F.col("pos") + span <= F.col("n_rows"))
          & (F.col("n_rows") >= p.min_rows))
    return d.withColumn("is_start", ok)


def supervised_windows(df: DataFrame, p: WindowParams = WindowParams()) -> DataFrame:
    """W8 + R1 + R2: one row per window with past/future value arrays [L, C] (FLOAT),
    masks (is_trading repeated over the C targets) and the past timestamps.

    The frame ``rowsBetween(0, L-1)`` collects the window starting at each row; only
    start rows are kept. ``contiguous=True`` keeps windows that stay inside one trading segment.
    """
    L_in, L_out = p.input_chunk_length, p.output_chunk_length
    span = L_in + L_out
    targets = list(p.target_cols)
    d = window_starts(df, p)
    row = F.struct(F.col("ts").alias("ts"), F.col("is_trading").cast("float").alias("m"),
                   F.array(*[F.col(t).cast("float") for t in targets]).alias("v"))
    frame = by_asset().rowsBetween(0, span - 1)
    d = d.withColumn("_w", F.collect_list(row).over(frame))
    if p.contiguous:
        d = d.withColumn("_gap", F.max(F.when(F.col("is_trading") == 0, 1).otherwise(0)).over(frame))
        d = d.filter(F.col("_gap") == 0)
    d = d.filter("is_start")  # implies that the frame holds span rows
    if "idx" not in d.columns:
        d = with_asset_index(d)
    past = F.slice("_w", 1, L_in)
    fut = F.slice("_w", L_in + 1, L_out)
    C = len(targets)
    return d.select(
        window_id(F.col("idx"), F.col("pos")).alias("window_id"),
        "asset", F.col("pos").alias("start_pos"),
        F.transform(past, lambda r: r["v"]).alias("past"),
        F.transform(past, lambda r: F.array_repeat(r["m"], C)).alias("past_mask"),
        F.transform(fut, lambda r: r["v"]).alias("future"),
        F.transform(fut, lambda r: F.array_repeat(r["m"], C)).alias("future_mask"),
        F.transform(past, lambda r: r["ts"]).alias("past_ts"))


def transpose(arr: Column, n_channels: int) -> Column:
    """[T, C] -> [C, T]."""
    return F.transform(F.sequence(F.lit(1), F.lit(n_channels)),
                       lambda c: F.transform(arr, lambda row: F.element_at(row, c)))


def with_batches(windows: DataFrame, batch_size: int, stride: int = 1) -> DataFrame:
    """``batch_id`` = floor(ordinal / B) in (contract, start) order, without a global sort.

    Ordinals come from per-contract window counts (one row per contract) turned into
    offsets, then added to each window's rank inside its contract.
    """
    counts = windows.groupBy("asset").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("asset").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    from ..functions.joins import join_small
    w = join_small(windows, offs.select("asset", "_off"), on="asset", how="left")
    ordinal = F.col("_off") + (F.col("start_pos") / F.lit(stride)).cast("long")
    return w.withColumn("batch_id", (ordinal / F.lit(batch_size)).cast("long")).drop("_off")


def shuffle_key(seed: int = 1234, epoch: int = 0) -> Column:
    """Deterministic per-epoch shuffle order of windows (order by this column)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed + epoch)), F.col("asset"), F.col("start_pos").cast("string")))


def assign_shards(windows: DataFrame, n_shards: int) -> DataFrame:
    """Contracts dealt round-robin to ``n_shards`` workers by their index."""
    if "idx" not in windows.columns:
        windows = with_asset_index(windows)
    return windows.withColumn("shard", F.pmod(F.col("idx"), F.lit(n_shards)).cast("int"))


def reclock(df: DataFrame, start: str = "2020-01-01 00:00:00", step_minutes: int = 15) -> DataFrame:
    """Continuous synthetic clock after filtering: start + (row_number - 1) * step."""
    n = F.row_number().over(by_asset()) - 1
    return df.withColumn("ts", F.to_timestamp(F.lit(start)) + F.make_dt_interval(
        F.lit(0), F.lit(0), (n * step_minutes).cast("int"), F.lit(0)))
