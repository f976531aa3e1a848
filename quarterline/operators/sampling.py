"""Exact-size subsampling strategies (P1-P5) and their comparison.

Sampling is deterministic and exact in size: rows are ranked inside
``(asset, is_trading)`` by ``md5(seed | asset | epoch seconds)`` and the first
floor(fraction * n) are kept. ``sample()`` would give only approximate sizes.

With ``chunk_seconds`` no task gets all rows of a contract: the same rows are chosen by histograms of the
hash (:mod:`selection`) on a written table, and boundary rows come from chunked scans (:mod:`chunks`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import pct, reduction_pct
from ..session import materialize
from .segments import boundary_flag
from .selection import smallest_by_hash

# Fixed value: seed of the strategy experiment.
SEED = 827


def sample_key(seed: int | Column = SEED) -> Column:
    s = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws("|", s, F.col("asset"), F.unix_seconds("ts").cast("string")))


def _exact_fraction(eligible: Column, fraction: float, seed: int | Column, keys=("asset",)) -> Column:
    """True for exactly floor(fraction * n) eligible rows per series (n = eligible rows)."""
    grp = Window.partitionBy(*keys, "_elig")
    rank = F.row_number().over(grp.orderBy(sample_key(seed), "ts"))
    n = F.count(F.lit(1)).over(grp)
    return F.col("_elig") & (rank <= F.floor(n * F.lit(float(fraction))))


def trading_only(df: DataFrame, keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """P1 (row-wise; ``keys`` and ``chunk_seconds`` only for a uniform signature)."""
    return df.filter(F.col("is_trading") == 1)


def stratified_flag(df: DataFrame, non_trading_fraction: float = 0.1, seed: int = SEED,
                    keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    if chunk_seconds:
        d = smallest_by_hash(materialize(df), F.col("is_trading") == 0, sample_key(seed), non_trading_fraction, keys, "_picked")
        return d.withColumn("keep_stratified", (F.col("is_trading") == 1) | F.col("_picked")).drop("_picked")
    d = df.withColumn("_elig", F.col("is_trading") == 0)
    picked = _exact_fraction(F.col("_elig"), non_trading_fraction, seed, keys)
    return d.withColumn("keep_stratified", (F.col("is_trading") == 1) | picked).drop("_elig")


def stratified(df: DataFrame, non_trading_fraction: float = 0.1, seed: int = SEED,
               keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """All trading rows plus exactly floor(f * n_non_trading) non-trading rows per contract."""
    d = stratified_flag(df, non_trading_fraction, seed, keys, chunk_seconds)
    return d.filter("keep_stratified").drop("keep_stratified")


def stratified_by(df: DataFrame, non_trading_fraction: float, seed: Column, keys) -> DataFrame:
    """P2 with the seed in a column: several draws in one pass, ``keys`` tells them apart."""
    d = df.withColumn("_elig", F.col("is_trading") == 0)
    d = d.withColumn("_picked", _exact_fraction(F.col("_elig"), non_trading_fraction, seed, keys))
    return d.filter((F.col("is_trading") == 1) | F.col("_picked")).drop("_elig", "_picked")


def boundary_aware(df: DataFrame, window_before: int = 4, window_after: int = 4,
                   keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """P3 (W6)."""
    return (boundary_flag(df, window_before, window_after, keys, chunk_seconds).filter("keep_boundary")
            .drop("keep_boundary", "change"))


def hybrid_flag(df: DataFrame, non_trading_fraction: float = 0.05, window_before: int = 4,
                window_after: int = 4, seed: int = SEED, keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    d = boundary_flag(df, window_before, window_after, keys, chunk_seconds)
    if chunk_seconds:
        d = smallest_by_hash(materialize(d), (F.col("is_trading") == 0) & ~F.col("keep_boundary"), sample_key(seed),
                             non_trading_fraction, keys, "_picked")
        return d.withColumn("keep_hybrid", F.col("keep_boundary") | F.col("_picked")).drop("_picked")
    d = d.withColumn("_elig", (F.col("is_trading") == 0) & ~F.col("keep_boundary"))
    picked = _exact_fraction(F.col("_elig"), non_trading_fraction, seed, keys)
    return d.withColumn("keep_hybrid", F.col("keep_boundary") | picked).drop("_elig")


def hybrid(df: DataFrame, non_trading_fraction: float = 0.05, window_before: int = 4,
           window_after: int = 4, seed: int = SEED, keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """Boundary-aware rows plus exactly floor(f * remaining) of the other non-trading rows."""
    d = hybrid_flag(df, non_trading_fraction, window_before, window_after, seed, keys, chunk_seconds)
    return d.filter("keep_hybrid").drop("keep_hybrid", "keep_boundary", "change")


def original(df: DataFrame, keys=("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """All rows (the arguments are for a uniform signature)."""
    return df


STRATEGIES: dict[str, Callable[..., DataFrame]] = {
    "original": original,
    "trading_only": trading_only,
    "stratified": stratified,
    "boundary_aware": boundary_aware,
    "hybrid": hybrid,
}
ALIASES = {"trading-only": "trading_only", "boundary-aware": "boundary_aware"}


def apply_strategy(df: DataFrame, name: str, **kwargs) -> DataFrame:
    """Dispatch by name (case and dash insensitive); unknown names raise."""
    key = name.strip().lower().replace(" ", "_")
    key = ALIASES.get(key, key.replace("-", "_"))
    if key not in STRATEGIES:
        raise ValueError(f"unknown strategy {name!r}; known: {sorted(STRATEGIES)}")
    return STRATEGIES[key](df, **kwargs)


def strategy_flags(df: DataFrame, stratified_fraction: float = 0.1, hybrid_fraction: float = 0.05,
                   window_before: int = 4, window_after: int = 4, seed: int = SEED) -> DataFrame:
    """Keep flags of all four strategies in one pass over the panel."""
    d = stratified_flag(df, stratified_fraction, seed)
    d = hybrid_flag(d, hybrid_fraction, window_before, window_after, seed)
    return d.withColumn("keep_trading_only", F.col("is_trading") == 1)


def compare_strategies(df: DataFrame, **kwargs) -> DataFrame:
    """Rows, trading, non-trading, trading % and size reduction % per strategy vs the original."""
    d = strategy_flags(df, **kwargs)
    t = F.col("is_trading") == 1

    def cnt(flag: Column | None, trading: bool | None) -> Column:
        c = F.lit(True) if flag is None else flag
        if trading is True:
            c = c & t
        elif trading is False:
            c = c & ~t
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")

    names = {"Original": None, "Trading-Only": F.col("keep_trading_only"),
             "Stratified": F.col("keep_stratified"), "Boundary-Aware": F.col("keep_boundary"),
             "Hybrid": F.col("keep_hybrid")}
    aggs = [F.count(F.lit(1)).alias("orig_total")]
    for i, (_, flag) in enumerate(names.items()):
        aggs += [cnt(flag, None).alias(f"t{i}"), cnt(flag, True).alias(f"tr{i}")]
    one = d.agg(*aggs)
    stack = ", ".join(f"'{n}', t{i}, tr{i}" for i, n in enumerate(names))
    long = one.selectExpr("orig_total", f"stack({len(names)}, {stack}) AS (strategy, total_rows, trading_rows)")
    return long.select(
        "strategy", "total_rows", "trading_rows",
        (F.col("total_rows") - F.col("trading_rows")).alias("non_trading_rows"),
        pct("trading_rows", "total_rows").alias("trading_pct"),
        reduction_pct("total_rows", "orig_total").alias("size_reduction_pct"))
