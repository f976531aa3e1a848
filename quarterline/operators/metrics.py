"""Scores over the long evaluation frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import masked_smape


def masked_smape_col(eps: float = 1e-6):
    """A13 as an aggregate column over an evaluation frame (y, p, m)."""
    return masked_smape("y", "p", "m", eps)


def smape(ev: DataFrame, by: Sequence[str] = (), eps: float = 1e-6, percent: bool = False) -> DataFrame:
    """Masked smoothed sMAPE (element weighted), overall or per group."""
    s = masked_smape("y", "p", "m", eps)
    if percent:
        s = s * 100.0
    agg = [s.alias("smape"), F.sum("m").alias("n_scored")]
    return ev.groupBy(*by).agg(*agg) if by else ev.agg(*agg)


def with_window_batches(ev: DataFrame, batch_size: int, stride: int = 1) -> DataFrame:
    """R5 on the evaluation frame: batch id of each window in (contract, start) order."""
    wins = ev.filter(F.col("h") == 1).select("asset", "start_pos").distinct()
    counts = wins.groupBy("asset").agg(F.count(F.lit(1)).alias("_n"), F.min("start_pos").alias("_first"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("asset").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    from ..functions.joins import join_small
    e = join_small(ev, offs.select("asset", "_off", "_first"), on="asset", how="left")
    ordinal = F.col("_off") + ((F.col("start_pos") - F.col("_first")) / F.lit(stride)).cast("long")
    return e.withColumn("batch_id", (ordinal / F.lit(batch_size)).cast("long")).drop("_off", "_first")


def macro_smape(ev: DataFrame, batch_size: int = 64, max_batches: int | None = None,
                eps: float = 1e-6) -> DataFrame:
    """A15 (+K5): mean over batches of the per-batch masked sMAPE, x100; all-masked batches
    count as 0; no batches -> +inf."""
    b = with_window_batches(ev, batch_size)
    if max_batches is not None:
        b = b.filter(F.col("batch_id") < max_batches)
    per = b.groupBy("batch_id").agg(masked_smape("y", "p", "m", eps).alias("s"))
    return per.agg(F.coalesce(F.avg("s") * 100.0, F.lit(float("inf"))).alias("macro_smape"),
                   F.count(F.lit(1)).alias("n_batches"))


def smape_asset_summary(ev: DataFrame, eps: float = 1e-6) -> DataFrame:
    """sMAPE per contract x target, then mean and median over contracts per target
    and over all (target = 'ALL')."""
    per = ev.groupBy("asset", "target").agg(masked_smape("y", "p", "m", eps).alias("s"))
    return (per.rollup("target")
               .agg(F.avg("s").alias("mean_smape"), F.median("s").alias("median_smape"),
                    F.count(F.lit(1)).alias("n_pairs"))
               .withColumn("target", F.coalesce(F.col("target"), F.lit("ALL"))))


def inverse_scaled(ev: DataFrame, scalers: DataFrame) -> DataFrame:
    """Bring truths and predictions back to original units before scoring."""
    s = scalers.select("asset", "target", F.col("mean").alias("_m"), F.col("scale").alias("_s"))
    from ..functions.joins import join_small
    e = join_small(ev, s, on=["asset", "target"], how="left")
    m, sc = F.coalesce(F.col("_m"), F.lit(0.0)), F.coalesce(F.col("_s"), F.lit(1.0))
    return e.withColumns({"y": F.col("y") * sc + m, "p": F.col("p") * sc + m}).drop("_m", "_s")


def scaled(ev: DataFrame, scalers: DataFrame) -> DataFrame:
    """Truths and predictions in scaled space (what the reference's evaluation scores)."""
    s = scalers.select("asset", "target", F.col("mean").alias("_m"), F.col("scale").alias("_s"))
    from ..functions.joins import join_small
    e = join_small(ev, s, on=["asset", "target"], how="left")
    m, sc = F.coalesce(F.col("_m"), F.lit(0.0)), F.coalesce(F.col("_s"), F.lit(1.0))
    return e.withColumns({"y": (F.col("y") - m) / sc, "p": (F.col("p") - m) / sc}).drop("_m", "_s")


def model_comparison(scores: DataFrame, baseline_models: Sequence[str]) -> DataFrame:
    """baseline = min score over ``baseline_models`` (+inf when none); flag the others.

    ``scores`` has one row per model, so the whole-table window is on a tiny input.
    """
    base = F.min(F.when(F.col("model").isin(list(baseline_models)), F.col("smape"))).over(Window.partitionBy())
    return (scores.withColumn("baseline_smape", F.coalesce(base, F.lit(float("inf"))))
                  .withColumn("beats_baseline", F.col("smape") < F.col("baseline_smape")))


def error_by_dimension(ev_with_ts: DataFrame, buckets: DataFrame | None = None, eps: float = 1e-6) -> DataFrame:
    """(dimension, value, smape) by hour of day, weekday and, with ``buckets`` (asset, bucket: one row per
    contract), liquidity bucket of the target row; one pass with grouping sets, values as text."""
    cols = {"hour": F.hour("target_ts").cast("string"), "weekday": F.weekday("target_ts").cast("string")}
    d = ev_with_ts
    if buckets is not None:
        d = d.join(buckets.select("asset", F.col("bucket").alias("_bucket")), "asset")
        cols["liquidity"] = F.col("_bucket")
    d = d.select("y", "p", "m", *[c.alias(n) for n, c in cols.items()])
    names = list(cols)
    g = d.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names]).agg(
        masked_smape("y", "p", "m", eps).alias("smape"), *[F.grouping(n).alias(f"_g_{n}") for n in names])
    dimension = F.coalesce(*[F.when(F.col(f"_g_{n}") == 0, F.lit(n)) for n in names])
    return g.select(dimension.alias("dimension"), F.coalesce(*names).alias("value"), "smape")


def error_by_calendar(ev_with_ts: DataFrame, eps: float = 1e-6) -> DataFrame:
    """sMAPE by hour of day and by weekday of the target row."""
    return error_by_dimension(ev_with_ts, None, eps).withColumn("value", F.col("value").cast("int"))


def join_forecasts(forecasts: DataFrame, truths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forecasts <-> truths on (window_id, h, target); also returns the unmatched forecasts."""
    keys = ["window_id", "h", "target"]
    matched = forecasts.join(truths, on=keys, how="inner")
    unmatched = forecasts.join(truths.select(*keys), on=keys, how="left_anti")
    return matched, unmatched
