"""Plans over the featured table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.features import featurize, last_nonzero
from ..sources.candles import brand_panel, events_panel
from . import oracle as O
from .catalog import register

HOUR = 3600


def _rounded_features(panel):
    return featurize(panel).withColumn("cross_contract_mean", F.round("cross_contract_mean", 6))


@register("features_1h", O.features_sql(O.event_panel_sql(HOUR)))
def features_1h(spark, sf_dir):
    """Flagship: the 32-column featured table on hourly event candles (24 contracts)."""
    return _rounded_features(events_panel(spark, sf_dir, HOUR))


@register("features_brands_daily", O.features_sql(O.brand_panel_sql(), joined=False))
def features_brands_daily(spark, sf_dir):
    """The featured table on daily brand candles (25 contracts, 1995-2001)."""
    return _rounded_features(brand_panel(spark, sf_dir))


@register("j03_asof_last_nonzero", f"""
    WITH panel AS ({O.event_panel_sql(900)}),
    ticks AS (SELECT asset, ts, close, volume FROM panel)
    SELECT p.asset, p.ts, c.close AS last_close, v.volume AS last_volume
    FROM panel p
    ASOF LEFT JOIN (SELECT asset, ts, close FROM ticks WHERE close <> 0) c
      ON c.asset = p.asset AND c.ts <= p.ts
    ASOF LEFT JOIN (SELECT asset, ts, volume FROM ticks WHERE volume <> 0) v
      ON v.asset = p.asset AND v.ts <= p.ts""")
def j03_asof_last_nonzero(spark, sf_dir):
    """Each contract's last non-zero close and volume at or before every 15-minute slot."""
    p = events_panel(spark, sf_dir, 900)
    return p.select("asset", "ts", last_nonzero("close").alias("last_close"),
                    last_nonzero("volume").alias("last_volume"))


@register("j03_asof_chunked_15m", f"""
    WITH panel AS ({O.event_panel_sql(900)}),
    ticks AS (SELECT asset, ts, close, volume FROM panel)
    SELECT p.asset, p.ts, c.close AS last_close, v.volume AS last_volume
    FROM panel p
    ASOF LEFT JOIN (SELECT asset, ts, close FROM ticks WHERE close <> 0) c
      ON c.asset = p.asset AND c.ts <= p.ts
    ASOF LEFT JOIN (SELECT asset, ts, volume FROM ticks WHERE volume <> 0) v
      ON v.asset = p.asset AND v.ts <= p.ts""")
def j03_asof_chunked_15m(spark, sf_dir):
    """J3 two-phase: fill per (contract, day) chunk, then carry earlier days in from a per-chunk summary."""
    from ..operators.features import last_nonzero_chunked
    p = events_panel(spark, sf_dir, 900)
    return last_nonzero_chunked(p, ["close", "volume"], 86400).select("asset", "ts", "last_close", "last_volume")


@register("features_1h_chunked_fill", O.features_sql(O.event_panel_sql(HOUR)))
def features_1h_chunked_fill(spark, sf_dir):
    """The flagship table with the two-phase (6-hour chunk) as-of fill; identical result."""
    from ..schema import FeatureParams
    f = featurize(events_panel(spark, sf_dir, HOUR), FeatureParams(ffill_chunk_seconds=6 * 3600))
    return f.withColumn("cross_contract_mean", F.round("cross_contract_mean", 6))
