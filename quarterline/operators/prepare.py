"""Training-set preparation compositions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_small
from ..functions.cleaning import covariate_columns, drop_time_zone, non_finite_to_null
from ..schema import TARGETS
from .chunks import fill_series_chunked, reclock_chunked
from .sampling import apply_strategy
from .segments import select_best, with_segments
from .windows import reclock


def by_asset():
    return Window.partitionBy("asset").orderBy("ts")


def fill_series(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("asset",),
                chunk_seconds: int | None = None) -> DataFrame:
    """F15 + W1 + W2: non-finite -> NULL, forward fill, then backward fill, then 0.

    The backward fill only matters before a series' first value, and there it is the first value
    of the whole series: one pass per partition instead of a frame evaluated anew for each row.
    With ``chunk_seconds`` the rows of a series are spread over (series, chunk) tasks (:mod:`chunks`)."""
    if chunk_seconds:
        return fill_series_chunked(df, cols, by, chunk_seconds)
    w = Window.partitionBy(*by).orderBy("ts")
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df.withColumns({c: non_finite_to_null(c) for c in cols})
    return out.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(before),
                                          F.first(c, ignorenulls=True).over(whole), F.lit(0.0))
                            for c in cols})


def min_length_both_sides(df: DataFrame, min_rows: int, splits: Sequence[str] = ("train", "val")) -> DataFrame:
    """J7 + length filter: keep contracts with >= ``min_rows`` rows in every split listed."""
    counts = (df.groupBy("asset").pivot("split", list(splits)).agg(F.count(F.lit(1)))
                .fillna(0, subset=list(splits)))
    ok = counts.filter(reduce(lambda a, b: a & b, [F.col(s) >= min_rows for s in splits])).select("asset")
    return df.join(ok, "asset", "left_semi")


def prepare_series(featured: DataFrame, strategy: str, input_chunk_length: int, output_chunk_length: int,
                   starts: dict[str, str] | None = None, step_minutes: int = 15,
                   targets: Sequence[str] = TARGETS, chunk_seconds: int | None = None, as_float: bool = False,
                   naive_time: bool = False, **strategy_kw) -> DataFrame:
    """Strategy per split -> contracts long enough on both sides (L_in + L_out + 10) ->
    clean and fill every numeric column -> continuous synthetic clock per split (W9).

    One pass: every per-series window is keyed by (split, asset), so the splits share one
    exchange instead of a filter + union branch per split (which would recompute the input).
    ``as_float`` casts the numeric columns to FLOAT (F16), ``naive_time`` drops the time zone (F17)."""
    starts = starts or {"train": "2020-01-01 00:00:00", "val": "2021-01-01 00:00:00"}
    keys = ("split", "asset")
    sampled = apply_strategy(featured.filter(F.col("split").isin(list(starts))), strategy,
                             keys=keys, chunk_seconds=chunk_seconds, **strategy_kw)
    sampled = min_length_both_sides(sampled, input_chunk_length + output_chunk_length + 10, list(starts))
    num = [*targets, *[c for c in covariate_columns(sampled, targets) if c not in ("idx", "n_assets")]]
    num = [c for c in num if dict(sampled.dtypes).get(c) in ("double", "float", "int", "bigint")]
    filled = fill_series(sampled, num, keys, chunk_seconds).withColumn("orig_ts", F.col("ts"))
    if as_float:
        filled = filled.withColumns({c: F.col(c).cast("float") for c in num})
    start = F.coalesce(*[F.when(F.col("split") == s, F.to_timestamp(F.lit(t0))) for s, t0 in starts.items()])
    out = reclock_by(filled, start, step_minutes, keys, chunk_seconds)
    return drop_time_zone(drop_time_zone(out, "ts"), "orig_ts") if naive_time else out


def reclock_by(df: DataFrame, start, step_minutes: int, by: Sequence[str] = ("asset",),
               chunk_seconds: int | None = None) -> DataFrame:
    """W9 per series: ``start`` (a timestamp string or column) + position * step."""
    if chunk_seconds:
        return reclock_chunked(df, start, step_minutes, by, chunk_seconds)
    t0 = F.to_timestamp(F.lit(start)) if isinstance(start, str) else start
    n = F.row_number().over(Window.partitionBy(*by).orderBy("ts")) - 1
    return df.withColumn("ts", t0 + F.make_dt_interval(
        F.lit(0), F.lit(0), (n * step_minutes).cast("int"), F.lit(0)))


def _segment_choice(train: DataFrame, val: DataFrame, min_segment_length: int, target_total_rows: int,
                    target_n_assets: int) -> tuple[DataFrame, DataFrame]:
    """Rows of both splits with ``kept`` (in a long enough segment of their split), and one row per
    chosen contract (W7): trading_rows, _va_seg, _va_all. One window keyed by (split, contract)."""
    both = (train.withColumn("split", F.lit("train"))
            .unionByName(val.withColumn("split", F.lit("val")), allowMissingColumns=True))
    seg = with_segments(both, keys=("split", "asset")).withColumn(
        "kept", F.coalesce(F.col("segment_length") >= min_segment_length, F.lit(False)))
    is_tr, is_va = F.col("split") == "train", F.col("split") == "val"
    per_asset = (seg.groupBy("asset")
                 .agg(F.count_if(is_tr & F.col("kept")).alias("trading_rows"),
                      F.count_if(is_tr & F.col("kept") & (F.col("change") == 1)).alias("n_segments"),
                      F.count_if(is_va & F.col("kept")).alias("_va_seg"),
                      F.count_if(is_va).alias("_va_all"))
                 .filter(F.col("n_segments") > 0))
    return seg, select_best(per_asset, target_total_rows, target_n_assets)


def segment_training_set(train: DataFrame, val: DataFrame, min_segment_length: int, target_total_rows: int,
                         target_n_assets: int, input_chunk_length: int, output_chunk_length: int) -> DataFrame:
    """P8, counts: rows and window counts (A11) per split and chosen contract; validation = its segments,
    or the full validation rows when it has none, or the training rows when it is missing (J8)."""
    _, chosen = _segment_choice(train, val, min_segment_length, target_total_rows, target_n_assets)
    val_rows = (F.when(F.col("_va_seg") > 0, F.col("_va_seg"))
                 .when(F.col("_va_all") > 0, F.col("_va_all"))
                 .otherwise(F.col("trading_rows")))
    counts = chosen.select("asset", F.inline(F.array(
        F.struct(F.lit("train").alias("split"), F.col("trading_rows").alias("n_rows")),
        F.struct(F.lit("val").alias("split"), val_rows.alias("n_rows")))))
    span = input_chunk_length + output_chunk_length
    return (counts.filter(F.col("n_rows") > 0)
                  .select("split", "asset", "n_rows",
                          F.greatest(F.lit(0), F.col("n_rows") - F.lit(span - 1)).cast("long").alias("n_windows")))


def segment_training_rows(train: DataFrame, val: DataFrame, min_segment_length: int, target_total_rows: int,
                          target_n_assets: int, starts: dict[str, str] | None = None, step_minutes: int = 15,
                          targets: Sequence[str] = TARGETS) -> DataFrame:
    """P8, rows: the chosen contracts' segment rows (train) and validation rows by the same rules,
    numeric columns cleaned and filled (F15, W1, W2), as FLOAT (F16), on a continuous clock (W9)."""
    starts = starts or {"train": "2020-01-01 00:00:00", "val": "2021-01-01 00:00:00"}
    seg, chosen = _segment_choice(train, val, min_segment_length, target_total_rows, target_n_assets)
    j = join_small(seg, chosen.select("asset", "_va_seg", "_va_all"), "asset", "inner", known_rows=target_n_assets)
    is_tr, is_va = F.col("split") == "train", F.col("split") == "val"
    by_segment, whole = F.col("_va_seg") > 0, (F.col("_va_seg") == 0) & (F.col("_va_all") > 0)
    sides = F.array_compact(F.array(
        F.when(is_tr & F.col("kept"), F.lit("train")),
        F.when(is_va & ((by_segment & F.col("kept")) | whole), F.lit("val")),
        F.when(is_tr & F.col("kept") & ~by_segment & ~whole, F.lit("val"))))
    rows = j.withColumn("split", F.explode(sides)).drop("kept", "_va_seg", "_va_all", "change", "segment_id", "segment_length")
    num = [*targets, *[c for c in covariate_columns(rows, targets) if c not in ("idx", "n_assets")]]
    num = [c for c in num if dict(rows.dtypes).get(c) in ("double", "float", "int", "bigint")]
    filled = fill_series(rows, num, by=("split", "asset")).withColumn("orig_ts", F.col("ts"))
    filled = filled.withColumns({c: F.col(c).cast("float") for c in num})
    start = F.coalesce(*[F.when(F.col("split") == s, F.to_timestamp(F.lit(t0))) for s, t0 in starts.items()])
    return reclock_by(filled, start, step_minutes, by=("split", "asset"))
