"""Time and cross-contract features.

Plan shape: panel -> broadcast join of the small asset dimension -> one window
by asset (forward fill, J3) -> one window by timestamp ordered by the neighbour
index (J4). All twelve neighbour lookups share that single exchange; there is
no self-join per neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, is_trading
from ..functions.cleaning import fill_missing, mask_when_not_trading, zero_to_null
from ..functions.contracts import parse_contract, time_to_delivery
from ..functions.joins import join_small
from ..schema import TARGETS, FeatureParams


def by_asset():
    return Window.partitionBy("asset").orderBy("ts")


def up_to_now():
    return by_asset().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def by_slot():
    return Window.partitionBy("ts").orderBy("idx")


def asset_dimension(panel: DataFrame, order: str = "name") -> DataFrame:
    """(asset, idx, n_assets, delivery struct) on the distinct assets only.

    order="name": lexicographic (the reference); order="delivery": by weekday, hour, minute.
    """
    dim = panel.select("asset").distinct().withColumn("delivery", parse_contract("asset"))
    if order == "delivery":
        w = Window.orderBy(F.col("delivery.dow"), F.col("delivery.hour"), F.col("delivery.minute"), "asset")
    else:
        w = Window.orderBy("asset")
    return (dim.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))
               .withColumn("n_assets", F.count(F.lit(1)).over(Window.partitionBy()).cast("long")))


def with_time_features(panel: DataFrame, dim: DataFrame | None = None, rule: str = "sum") -> DataFrame:
    """F2-F10 on the long panel. The delivery slot is parsed once per asset in ``dim``."""
    if dim is None:
        dim = asset_dimension(panel)
    out = join_small(panel, dim, on="asset", how="left")
    cols = calendar_columns("ts")
    cols["is_trading"] = is_trading(out, rule)
    cols["time_to_delivery"] = time_to_delivery(
        "ts", F.col("delivery.dow"), F.col("delivery.hour"), F.col("delivery.minute"))
    return out.withColumns(cols)


def last_nonzero(col: str) -> Column:
    """Last non-zero value at or before the row (as-of join, backward, inclusive)."""
    return F.last(zero_to_null(col), ignorenulls=True).over(up_to_now())


def last_nonzero_chunked(df: DataFrame, cols: list[str], chunk_seconds: int,
                         out: dict[str, str] | None = None) -> DataFrame:
    """J3/W1 in two phases, for contracts too large for one task.

    1. fill inside (contract, time chunk) partitions, so a hot contract spreads over many tasks;
    2. carry the last non-zero value of earlier chunks in from a per-chunk summary
       (contracts x chunks rows), broadcast behind a size check.
    Exactly equal to :func:`last_nonzero`.
    """
    out = out or {c: f"last_{c}" for c in cols}
    chunk = F.floor(F.unix_seconds("ts") / F.lit(chunk_seconds)).cast("long")
    d = df.withColumn("_chunk", chunk)
    local = Window.partitionBy("asset", "_chunk").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_loc_{c}": F.last(zero_to_null(c), ignorenulls=True).over(local) for c in cols})
    # last non-zero value per chunk: (asset, ts) is unique, and max_by skips rows whose key is
    # NULL (zero / missing values), with fixed-width buffers (hash aggregate)
    summary = d.groupBy("asset", "_chunk").agg(*[
        F.max_by(F.col(c), F.when(zero_to_null(c).isNotNull(), F.col("ts"))).alias(f"_end_{c}") for c in cols])
    before = Window.partitionBy("asset").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select("asset", "_chunk", *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}")
                                                for c in cols])
    d = join_small(d, carry, on=["asset", "_chunk"], how="left")
    d = d.withColumns({out[c]: F.coalesce(F.col(f"_loc_{c}"), F.col(f"_carry_{c}")) for c in cols})
    return d.drop("_chunk", *[f"_loc_{c}" for c in cols], *[f"_carry_{c}" for c in cols])


def _neighbour(k: int) -> Column:
    # the row of the asset k ranks away at the same timestamp; NULL when there is none
    return F.first(F.col("_state")).over(by_slot().rangeBetween(k, k))


def with_cross_contract_features(df: DataFrame, params: FeatureParams = FeatureParams()) -> DataFrame:
    """J2-J5, A9, F13, F14 on a panel that already carries idx / n_assets / is_trading."""
    K = params.num_surrounding
    extra = list(params.neighbour_extra)
    if params.ffill_chunk_seconds:
        df = last_nonzero_chunked(df, ["close", "volume", *extra], params.ffill_chunk_seconds,
                                  {c: f"_last_{c}" for c in ["close", "volume", *extra]})
    else:
        df = df.withColumns({"_last_close": last_nonzero("close"), "_last_volume": last_nonzero("volume"),
                             **{f"_last_{c}": last_nonzero(c) for c in extra}})
    df = df.withColumn("_state", F.struct(
        F.col("_last_close").alias("lc"), F.col("_last_volume").alias("lv"),
        F.col("close").alias("c"), F.col("volume").alias("v"),
        *[F.col(f"_last_{c}").alias(f"l_{c}") for c in extra]))
    nb = {}
    for k in range(1, K + 1):
        nb[f"_prev{k}"] = _neighbour(-k)
        nb[f"_next{k}"] = _neighbour(k)
    df = df.withColumns(nb)

    idx, n = F.col("idx"), F.col("n_assets")
    feats = {}
    for k in range(1, K + 1):
        has_next, has_prev = idx + k < n, idx - k >= 0
        nxt, prv = F.col(f"_next{k}"), F.col(f"_prev{k}")
        if params.side == "prev":
            pick = F.when(has_prev, prv)
        elif params.side == "next":
            pick = F.when(has_next, nxt)
        else:  # the next neighbour wins; the previous only where no next exists
            pick = F.when(has_next, nxt).when(has_prev, prv)
        feats[f"close_lag_adj_{k}"] = pick.getField("lc")
        feats[f"close_delta_adj_{k}"] = F.col("close") - pick.getField("lc")
        feats[f"volume_adj_{k}"] = pick.getField("lv")
        for c in extra:  # the neighbours' last high / low as extra features
            feats[f"{c}_lag_adj_{k}"] = pick.getField(f"l_{c}")

    # Nearest neighbour trading at this slot, order prev1, next1, prev2, next2, ...
    order = []
    for k in range(1, K + 1):
        for side in ("_prev", "_next"):
            s = F.col(f"{side}{k}")
            order.append(F.when(s.getField("v") > 0, s.getField("c")))
    feats["nearest_liquid_contract_close"] = F.coalesce(*order)

    # Mean of all existing neighbours' last closes, skipping NULLs
    closes = F.filter(F.array(*[F.col(f"{side}{k}").getField("lc")
                                for k in range(1, K + 1) for side in ("_prev", "_next")]),
                      lambda x: x.isNotNull())
    feats["cross_contract_mean"] = F.when(
        F.size(closes) > 0,
        F.aggregate(closes, F.lit(0.0), lambda acc, x: acc + x) / F.size(closes))

    df = df.withColumns(feats)
    df = mask_when_not_trading(df, list(feats))
    return df.drop("_state", "_last_close", "_last_volume", *[f"_last_{c}" for c in extra], *nb.keys())


FEATURE_ORDER = ["hour_of_day", "day_of_week", "week_of_year", "month", "is_weekend",
                 "is_trading", "time_to_delivery"]


def feature_column_names(k_max: int = 6, extra: tuple = ()) -> list[str]:
    cols = []
    for k in range(1, k_max + 1):
        cols += [f"close_lag_adj_{k}", f"close_delta_adj_{k}", f"volume_adj_{k}"]
    cols += [f"{c}_lag_adj_{k}" for c in extra for k in range(1, k_max + 1)]
    return cols + ["nearest_liquid_contract_close", "cross_contract_mean"]


def rolling_nonzero_mean(col: str, steps: int) -> Column:
    """Mean of the non-zero values among the last ``steps`` rows (NULL if none)."""
    return F.avg(zero_to_null(col)).over(by_asset().rowsBetween(-(steps - 1), 0))


def featurize(panel: DataFrame, params: FeatureParams = FeatureParams(), fill: bool = True) -> DataFrame:
    """The featured table (A3): asset, ts, HLCV, calendar, delivery, 6 x 3 neighbour columns,
    nearest liquid close and cross-contract mean; NULL -> fill value as the last projection (F12).
    """
    dim = asset_dimension(panel, params.order)
    df = with_time_features(panel, dim, params.trading_rule)
    df = with_cross_contract_features(df, params)
    cols = ["asset", "ts", *TARGETS, *FEATURE_ORDER,
            *feature_column_names(params.num_surrounding, tuple(params.neighbour_extra))]
    out = df.select(*cols)
    if fill:
        out = fill_missing(out, params.fill_value, [c for c in cols if c not in ("asset", "ts")])
    return out
