"""Forecasters and the narrow evaluation frame.

A forecast is issued at a window's origin row (the last context row). Point forecasts
stay columns on the origin row; future truths are read with ``lead(x, h)`` in the same
per-contract window, so scoring needs neither window arrays nor a forecast-truth join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import zero_to_null
from ..functions.joins import join_small
from ..schema import FORECAST, TARGETS, WindowParams
from .windows import window_id


def by_asset():
    return Window.partitionBy("asset").orderBy("ts")


def with_origins(df: DataFrame, p: WindowParams) -> DataFrame:
    """Mark window origins: start = pos - L_in + 1 with start % stride == 0 and L_out rows after."""
    from .segments import with_position
    L_in, L_out = p.input_chunk_length, p.output_chunk_length
    d = with_position(df).withColumn("n_rows", F.count(F.lit(1)).over(Window.partitionBy("asset")))
    start = F.col("pos") - F.lit(L_in - 1)
    ok = ((start >= 0) & (start % p.stride == 0) & (F.col("pos") + L_out < F.col("n_rows"))
          & (F.col("n_rows") >= p.min_rows))
    d = d.withColumn("start_pos", start).withColumn("is_origin", ok)
    if "idx" not in d.columns:
        from .windows import with_asset_index
        d = with_asset_index(d)
    return d.withColumn("window_id", window_id(F.col("idx"), F.col("start_pos")))


def naive_last_value(df: DataFrame, L_in: int, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Last non-zero value of each target inside the context window, 0 if none; flat horizon."""
    ctx = by_asset().rowsBetween(-(L_in - 1), 0)
    return df.withColumns({f"f_{t}": F.coalesce(F.last(zero_to_null(t), ignorenulls=True).over(ctx), F.lit(0.0))
                           for t in targets})


def calendar_profile(train: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Mean of each target per contract, month, weekday and hour on the training rows."""
    return (train.groupBy("asset", F.month("ts").alias("_mon"), F.weekday("ts").alias("_dow"),
                          F.hour("ts").alias("_hr"))
            .agg(*[F.avg(t).alias(f"g_{t}") for t in targets]))


def with_calendar_mean(df: DataFrame, profile: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """R13 forecast for each row as a target row; slots absent from training give 0.

    The profile has at most contracts x 12 x 7 x 24 rows, so it is broadcast behind a size check.
    """
    d = df.withColumns({"_mon": F.month("ts"), "_dow": F.weekday("ts"), "_hr": F.hour("ts")})
    d = join_small(d, profile, on=["asset", "_mon", "_dow", "_hr"], how="left")
    return d.withColumns({f"g_{t}": F.coalesce(F.col(f"g_{t}"), F.lit(0.0)) for t in targets}).drop(
        "_mon", "_dow", "_hr")


def quantile_context(df: DataFrame, L_in: int, levels: Sequence[float],
                     targets: Sequence[str] = TARGETS) -> DataFrame:
    """Empirical quantiles of each target over the context window (exact, linear
    interpolation); ``q_<target>`` is an array aligned with ``levels``."""
    ctx = by_asset().rowsBetween(-(L_in - 1), 0)
    lv = F.array(*[F.lit(float(x)) for x in levels])

    def between(a: Column, q: Column) -> Column:
        n = F.size(a)
        at = q * (n - 1)
        lo, hi = F.floor(at).cast("int"), F.ceil(at).cast("int")
        x, y = F.get(a, lo), F.get(a, hi)
        return F.when(n > 0, F.when(lo == hi, x).otherwise((hi - at) * x + (at - lo) * y))

    # the context's values are sorted once per row, and all levels read from that array
    d = df.withColumns({f"_s_{t}": F.collect_list(F.col(t).cast("double")).over(ctx) for t in targets})
    return d.withColumns({f"q_{t}": F.transform(F.array(F.array_sort(f"_s_{t}")), lambda a: F.transform(
        lv, lambda q: between(a, q)))[0] for t in targets}).drop(*[f"_s_{t}" for t in targets])


def quantile_forecasts_long(df: DataFrame, levels: Sequence[float],
                            targets: Sequence[str] = TARGETS) -> DataFrame:
    """A6 long form of flat quantile forecasts: (window_id, h NULL, target, quantile, value)."""
    items = [F.struct(F.lit(t).alias("target"), F.lit(float(q)).alias("quantile"),
                      F.element_at(F.col(f"q_{t}"), i + 1).alias("value"))
             for t in targets for i, q in enumerate(levels)]
    return (df.filter("is_origin").select("window_id", "asset", F.inline(F.array(*items)))
              .select("window_id", "asset", F.lit(None).cast("int").alias("h"), "target", "quantile", "value"))


def point_forecasts_long(df: DataFrame, horizon: int, prefix: str = "f_",
                         targets: Sequence[str] = TARGETS) -> DataFrame:
    """A6 long form of flat point forecasts: one row per (window, h, target), quantile NULL."""
    items = [F.struct(F.lit(t).alias("target"), F.col(f"{prefix}{t}").alias("value")) for t in targets]
    return (df.filter("is_origin")
              .select("window_id", "asset", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"),
                      F.inline(F.array(*items)))
              .select("window_id", "asset", "h", "target", F.lit(None).cast("double").alias("quantile"), "value"))


def align_to_median(forecasts: DataFrame, levels: Sequence[float], horizon: int) -> DataFrame:
    """Any long forecast -> one value per (window, h, target): the quantile at index
    len(levels)//2, a flat (h NULL) forecast repeated over the horizon, the mean (quantile NULL)
    as fallback."""
    med = float(sorted(levels)[len(levels) // 2]) if levels else None
    f = forecasts
    rank = (F.when(F.col("quantile") == F.lit(med), 0) if med is not None else F.lit(None)).otherwise(
        F.when(F.col("quantile").isNull(), 1))
    f = f.withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    f = f.withColumn("h", F.explode(F.when(F.col("h").isNull(), F.sequence(F.lit(1), F.lit(horizon)))
                                     .otherwise(F.array(F.col("h")))))
    return (f.groupBy("window_id", "asset", "h", "target")
             .agg(F.min_by("value", "_rank").alias("value")))


def evaluation_frame(df: DataFrame, p: WindowParams, flat: dict[str, Column] | None = None,
                     per_row: dict[str, Column] | None = None,
                     targets: Sequence[str] = TARGETS) -> DataFrame:
    """Long (window_id, asset, start_pos, h, target, target_ts, y, p, m) for every window and step.

    ``flat[t]``: forecast issued on the origin row (same for all h);
    ``per_row[t]``: forecast attached to each row as a target row.
    The next ``L_out`` rows of each origin are gathered by one sliding frame
    ``rowsBetween(1, L_out)`` of the per-contract window (no join, no arrays kept).
    """
    L_out = p.output_chunk_length
    fields = [F.col("ts").alias("ts"), F.col("is_trading").cast("double").alias("m"),
              *[F.col(t).alias(t) for t in targets]]
    if per_row:
        fields += [per_row[t].cast("double").alias(f"_p_{t}") for t in targets if t in per_row]
    nxt = F.collect_list(F.struct(*fields)).over(by_asset().rowsBetween(1, L_out))
    keep = ["window_id", "asset", "start_pos", *[f"_f_{t}" for t in targets if not (per_row and t in per_row)]]
    d = (df.withColumns({f"_f_{t}": flat[t].cast("double") for t in targets if not (per_row and t in per_row)})
           .withColumn("_next", nxt).filter("is_origin").select(*keep, "_next"))
    d = d.select(*keep, F.posexplode("_next").alias("_h0", "_r"))
    items = []
    for t in targets:
        pred = F.col("_r").getField(f"_p_{t}") if per_row and t in per_row else F.col(f"_f_{t}")
        items.append(F.struct(F.lit(t).alias("target"), F.col("_r").getField(t).alias("y"), pred.alias("p")))
    return d.select("window_id", "asset", "start_pos", (F.col("_h0") + 1).cast("int").alias("h"),
                    F.col("_r.ts").alias("target_ts"), F.col("_r.m").alias("m"), F.inline(F.array(*items))
                    ).select("window_id", "asset", "start_pos", "h", "target", "target_ts", "y", "p", "m")


def score_external(windows: DataFrame, forecaster: Callable, levels: Sequence[float],
                   horizon: int, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Pluggable quantile model run with ``mapInPandas`` on Arrow batches of windows.

    ``forecaster(past: np.ndarray[B, L_in, C], horizon, levels) -> np.ndarray[B, C, horizon, Q]``.
    Output is the long forecast table (window_id, h, target, quantile, value).
    """
    import numpy as np

    tlist, qlist = list(targets), [float(q) for q in levels]

    def run(batches):
        import pandas as pd
        for pdf in batches:
            if pdf.empty:
                continue
            past = np.stack([np.stack(list(x)) for x in pdf["past"]]).astype("float64")
            out = np.asarray(forecaster(past, horizon, qlist), dtype="float64")  # [B, C, H, Q]
            B, C, H, Q = out.shape
            wid = np.repeat(pdf["window_id"].to_numpy(), C * H * Q)
            tgt = np.tile(np.repeat(np.array(tlist[:C], dtype=object), H * Q), B)
            hh = np.tile(np.repeat(np.arange(1, H + 1, dtype="int32"), Q), B * C)
            qq = np.tile(np.array(qlist[:Q]), B * C * H)
            yield pd.DataFrame({"window_id": wid, "h": hh, "target": tgt, "quantile": qq,
                                "value": out.reshape(-1)})

    return windows.select("window_id", "past").mapInPandas(run, FORECAST)


def empirical_quantile_model(past, horizon, levels):
    """Reference scorer for :func:`score_external`: context quantiles repeated over the horizon."""
    import numpy as np
    q = np.quantile(past, levels, axis=1)            # [Q, B, C]
    q = np.transpose(q, (1, 2, 0))[:, :, None, :]    # [B, C, 1, Q]
    return np.repeat(q, horizon, axis=2)
