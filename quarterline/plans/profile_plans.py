"""Plans for profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as PR
from ..operators.features import featurize
from ..sources.candles import brand_panel, events_panel
from . import oracle as O
from .catalog import register
from .segment_plans import TRADED_1H, traded_panel

TRADED_15M = O.traded_sql(O.event_panel_sql(900))


def _r6(c):
    return F.round(c, 6)


@register("a01_liquidity", f"SELECT asset, avg(is_trading) AS liquidity FROM ({TRADED_15M}) GROUP BY asset")
def a01_liquidity(spark, sf_dir):
    """A1: fraction of trading slots per contract (15-minute candles), least liquid first."""
    return PR.liquidity(traded_panel(spark, sf_dir, 900))


A2_SQL = f"""
    SELECT asset, count(*) AS total_rows, sum(is_trading)::BIGINT AS trading_rows,
           count(*) - sum(is_trading)::BIGINT AS non_trading_rows, 100.0::DOUBLE * sum(is_trading) / count(*) AS trading_pct
    FROM ({TRADED_1H}) GROUP BY asset"""


@register("a02_trading_distribution", A2_SQL)
def a02_trading_distribution(spark, sf_dir):
    """A2: total / trading / non-trading rows and trading % per contract."""
    return PR.trading_distribution(traded_panel(spark, sf_dir))


@register("a02_trading_distribution_first10", f"""
    SELECT * FROM ({A2_SQL}) WHERE asset IN (SELECT DISTINCT asset FROM ({TRADED_1H}) ORDER BY asset LIMIT 10)""")
def a02_trading_distribution_first10(spark, sf_dir):
    """A2 + S16: the distribution restricted to the first 10 contracts by name (max_assets)."""
    return PR.trading_distribution(PR.first_assets(traded_panel(spark, sf_dir), 10))


@register("a03_distribution_summary", f"""
    SELECT round(avg(trading_pct), 6) AS avg_trading_pct, round(min(trading_pct), 6) AS min_trading_pct,
           round(max(trading_pct), 6) AS max_trading_pct, sum(total_rows)::BIGINT AS total_rows,
           sum(trading_rows)::BIGINT AS total_trading_rows, sum(non_trading_rows)::BIGINT AS total_non_trading_rows,
           count(*) AS n_assets
    FROM ({A2_SQL})""")
def a03_distribution_summary(spark, sf_dir):
    """A3: unweighted mean / min / max of per-contract trading % and total row counts."""
    s = PR.distribution_summary(PR.trading_distribution(traded_panel(spark, sf_dir)))
    return s.withColumns({c: _r6(F.col(c)) for c in ("avg_trading_pct", "min_trading_pct", "max_trading_pct")})


DESCRIBE_COLS = ["high", "low", "close", "volume", "is_trading", "time_to_delivery",
                 "close_lag_adj_1", "volume_adj_1", "nearest_liquid_contract_close", "cross_contract_mean"]


def _describe_sql():
    feats = O.features_sql(O.event_panel_sql(3600))
    u = " UNION ALL ".join(f"SELECT asset, '{c}' AS column_name, {c}::DOUBLE AS value FROM f" for c in DESCRIBE_COLS)
    return f"""
    WITH f AS ({feats}), l AS ({u})
    SELECT asset, column_name, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
           min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
           round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
    FROM l GROUP BY asset, column_name"""


@register("a04_describe", _describe_sql())
def a04_describe(spark, sf_dir):
    """A4: describe() per contract for the raw and engineered columns of the featured table."""
    from .feature_plans import _rounded_features
    d = PR.describe(_rounded_features(events_panel(spark, sf_dir, 3600)), DESCRIBE_COLS)
    return d.withColumns({c: _r6(F.col(c)) for c in ("mean", "std", "p25", "p50", "p75")})


@register("a05_null_counts", f"""
    WITH f AS ({O.features_sql(O.event_panel_sql(3600), fill="NULL")})
    {" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM f"
                        for c in ["close_lag_adj_1", "close_lag_adj_6", "volume_adj_3", "nearest_liquid_contract_close",
                                  "cross_contract_mean", "time_to_delivery", "close"])}""")
def a05_null_counts(spark, sf_dir):
    """A5: missing values per column of the featured table before the -1 fill."""
    f = featurize(events_panel(spark, sf_dir, 3600), fill=False)
    return PR.null_counts(f, ["close_lag_adj_1", "close_lag_adj_6", "volume_adj_3", "nearest_liquid_contract_close",
                              "cross_contract_mean", "time_to_delivery", "close"])


CORR_COLS = ["high", "low", "close", "volume", "time_to_delivery", "hour_of_day"]


def _corr_sql(a, b, src="f", by_asset=True):
    return (f"CASE WHEN stddev_pop({a}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) "
            f"* stddev_pop({b}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) = 0 THEN NULL "
            f"ELSE round(corr({a}, {b}), 6) END")


@register("a06_within_asset_corr", f"""
    WITH f AS ({O.features_sql(O.event_panel_sql(3600))})
    {" UNION ALL ".join(f"SELECT asset, '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr FROM f GROUP BY asset"
                        for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:])}""")
def a06_within_asset_corr(spark, sf_dir):
    """Pearson correlations between numeric columns inside each contract (constant -> NULL)."""
    from .feature_plans import _rounded_features
    c = PR.correlation_matrix(_rounded_features(events_panel(spark, sf_dir, 3600)), CORR_COLS)
    return c.withColumn("corr", _r6(F.col("corr")))


@register("a07_cross_asset_corr", f"""
    WITH p AS ({O.event_panel_sql(3600)})
    SELECT x.asset AS asset_a, y.asset AS asset_b,
           CASE WHEN stddev_pop(x.close) * stddev_pop(y.close) = 0 THEN NULL ELSE round(corr(x.close, y.close), 6) END
             AS corr
    FROM p x JOIN p y ON x.ts = y.ts AND x.asset < y.asset GROUP BY 1, 2""")
def a07_cross_asset_corr(spark, sf_dir):
    """Correlation of close between every pair of contracts, aligned on the slot."""
    return PR.cross_asset_correlation(events_panel(spark, sf_dir, 3600)).withColumn("corr", _r6(F.col("corr")))


def sparse_corr_sql(contracts: int) -> str:
    few = f"SELECT * FROM c WHERE asset IN (SELECT DISTINCT asset FROM c ORDER BY asset LIMIT {contracts})"
    return f"""
    WITH c AS MATERIALIZED ({O.brand_candles_sql()}), p AS ({few if contracts else "SELECT * FROM c"})
    SELECT x.asset AS asset_a, y.asset AS asset_b,
           CASE WHEN stddev_pop(x.close) * stddev_pop(y.close) = 0 THEN NULL ELSE round(corr(x.close, y.close), 6) END
             AS corr
    FROM p x JOIN p y ON x.ts = y.ts AND x.asset < y.asset GROUP BY 1, 2"""


@register("a07_sparse_corr", sparse_corr_sql(0))
def a07_sparse_corr(spark, sf_dir):
    """A7 on the undensified brand candles: pairs over the days on which both traded."""
    return PR.cross_asset_correlation(brand_panel(spark, sf_dir, dense=False)).withColumn("corr", _r6(F.col("corr")))


@register("a07_sparse_corr_first6", sparse_corr_sql(6))
def a07_sparse_corr_first6(spark, sf_dir):
    """A7 on the undensified candles of the first six contracts (S16: the limit is the feature)."""
    few = PR.first_assets(brand_panel(spark, sf_dir, dense=False), 6)
    return PR.cross_asset_correlation(few).withColumn("corr", _r6(F.col("corr")))


@register("k03_first_trading_rows", f"""
    SELECT asset, ts, high, low, close, volume, is_trading, row_in_asset FROM (
      SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) AS row_in_asset
      FROM ({TRADED_15M}) WHERE is_trading = 1) WHERE row_in_asset <= 10""")
def k03_first_trading_rows(spark, sf_dir):
    """K3: the first 10 trading rows of every contract."""
    return PR.first_rows(traded_panel(spark, sf_dir, 900), 10).select(
        "asset", "ts", "high", "low", "close", "volume", "is_trading", "row_in_asset")
