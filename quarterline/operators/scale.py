"""Per-contract standard scaling.

The scaler is a table ``(asset, target, mean, scale, n)``, one row per contract and
target, small enough (contracts x 4) to broadcast behind a size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_small
from ..schema import TARGETS


def fit_scalers(train: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Mean and population std over trading rows of the training split; zero std -> 1.

    Contracts with no trading rows get no scaler (they pass through unscaled).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for t in targets:
        aggs += [F.avg(t).alias(f"m_{t}"), F.stddev_pop(t).alias(f"s_{t}")]
    wide = train.filter(F.col("is_trading") == 1).groupBy("asset").agg(*aggs)
    stack = ", ".join(f"'{t}', m_{t}, s_{t}" for t in targets)
    long = wide.selectExpr("asset", "n", f"stack({len(targets)}, {stack}) AS (target, mean, std)")
    return long.select(
        "asset", "target", F.col("mean").cast("double").alias("mean"),
        F.when((F.col("std") == 0) | F.col("std").isNull(), F.lit(1.0)).otherwise(F.col("std")).alias("scale"),
        F.col("n").cast("long").alias("n"))


def scaler_wide(scalers: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    aggs = []
    for t in targets:
        aggs += [F.max(F.when(F.col("target") == t, F.col("mean"))).alias(f"_mean_{t}"),
                 F.max(F.when(F.col("target") == t, F.col("scale"))).alias(f"_scale_{t}")]
    return scalers.groupBy("asset").agg(*aggs)


def apply_scalers(df: DataFrame, scalers: DataFrame, targets: Sequence[str] = TARGETS,
                  inverse: bool = False) -> DataFrame:
    """R3 ``(x - mean) / scale`` or R4 ``x * scale + mean`` per contract and target;
    a contract without a scaler is left unchanged (J6: mean 0, scale 1)."""
    joined = join_small(df, scaler_wide(scalers, targets), on="asset", how="left")
    exprs = {}
    for t in targets:
        m = F.coalesce(F.col(f"_mean_{t}"), F.lit(0.0))
        s = F.coalesce(F.col(f"_scale_{t}"), F.lit(1.0))
        exprs[t] = F.col(t) * s + m if inverse else (F.col(t) - m) / s
    out = joined.withColumns(exprs)
    return out.drop(*[c for c in out.columns if c.startswith("_mean_") or c.startswith("_scale_")])


