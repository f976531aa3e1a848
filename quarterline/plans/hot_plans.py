"""Plans on an undensified panel where one contract holds more than a third of the rows: per-contract scans,
exact sampling and exact percentiles whose work is spread by (contract, chunk) or by histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as S
from ..operators.prepare import fill_series, prepare_series, reclock_by
from ..operators.rolling import score_contexts, smape_of
from ..operators.segments import boundary_flag, segment_stats, with_segments
from ..operators.selection import describe_refined
from ..operators.split import split_by_dates
from ..schema import TARGETS
from ..session import scratch_path
from ..sources.candles import hot_panel
from ..sources.panel_io import write_trading_segments
from . import oracle as O
from .catalog import register
from .model_plans import LEVELS, VAL_START

DAY = 86400  # chunk width: the events cover one month
HOT = O.hot_panel_sql()
MIN_SEG = 3
_ROW = "asset, ts, high, low, close, volume, is_trading"


@register("w03_hot_changes", f"""
    SELECT asset, ts, is_trading,
           is_trading - coalesce(lag(is_trading) OVER (PARTITION BY asset ORDER BY ts), 0) AS change FROM ({HOT})""")
def w03_hot_changes(spark, sf_dir):
    """Starts and stops, across chunk edges."""
    return with_segments(hot_panel(spark, sf_dir), chunk_seconds=DAY).select("asset", "ts", "is_trading", "change")


@register("w05_hot_segments", f"""
    SELECT asset, ts, island_no AS segment_id, island_len AS segment_length
    FROM ({O.islands_sql(HOT)}) WHERE is_trading = 1""")
def w05_hot_segments(spark, sf_dir):
    """Islands and their lengths, over any number of days."""
    return with_segments(hot_panel(spark, sf_dir), chunk_seconds=DAY).filter("is_trading = 1").select(
        "asset", "ts", "segment_id", "segment_length")


@register("a10_hot_segment_stats", f"""
    WITH s AS ({O.islands_sql(HOT)}),
    a AS (SELECT asset, count(*) AS total_rows, count(*) FILTER (WHERE island_len >= {MIN_SEG}) AS trading_rows,
                 count(DISTINCT island_no) FILTER (WHERE island_len >= {MIN_SEG}) AS n_segments,
                 avg(is_trading) AS trading_ratio_original
          FROM s GROUP BY asset)
    SELECT asset, total_rows, trading_rows, n_segments, trading_rows / n_segments AS avg_segment_length,
           trading_ratio_original
    FROM a WHERE n_segments > 0""")
def a10_hot_segment_stats(spark, sf_dir):
    """A10 on chunked islands."""
    return segment_stats(hot_panel(spark, sf_dir), MIN_SEG, DAY)


@register("w06_hot_boundary", f"SELECT asset, ts, is_trading, keep_boundary FROM ({O.boundary_sql(HOT)})")
def w06_hot_boundary(spark, sf_dir):
    """Neighbours of starts and stops, across chunk edges."""
    return boundary_flag(hot_panel(spark, sf_dir), chunk_seconds=DAY).select("asset", "ts", "is_trading", "keep_boundary")


@register("p02_hot_stratified", f"SELECT {_ROW} FROM ({O.stratified_sql(HOT)})")
def p02_hot_stratified(spark, sf_dir):
    """Exactly floor(0.1 n) non-trading rows per contract, by histograms of the hash."""
    return S.stratified(hot_panel(spark, sf_dir), 0.1, chunk_seconds=DAY).select(*_ROW.split(", "))


@register("p04_hot_hybrid", f"SELECT {_ROW} FROM ({O.hybrid_sql(HOT)})")
def p04_hot_hybrid(spark, sf_dir):
    """Boundary rows and exactly floor(0.05 n) of the others."""
    return S.hybrid(hot_panel(spark, sf_dir), 0.05, chunk_seconds=DAY).select(*_ROW.split(", "))


def _split_islands(split: str, cond: str) -> str:
    rows = f"SELECT * FROM ({HOT}) WHERE ts {cond} TIMESTAMP '{VAL_START}'"
    return (f"SELECT asset, ts, '{split}' AS split, island_no AS segment_id FROM ({O.islands_sql(rows)}) "
            f"WHERE is_trading = 1 AND island_len >= {MIN_SEG}")


@register("s18_hot_segment_writer", f"{_split_islands('train', '<')} UNION ALL {_split_islands('val', '>=')}")
def s18_hot_segment_writer(spark, sf_dir):
    """Segments of each split by chunks, written per split and contract."""
    out = scratch_path(spark, "segments")
    write_trading_segments(split_by_dates(hot_panel(spark, sf_dir), VAL_START), out, MIN_SEG, chunk_seconds=DAY)
    return spark.read.parquet(out).select("asset", "ts", "split", "segment_id")


_SPARSE = ", ".join(f"CASE WHEN is_trading = 1 THEN {c} END AS {c}" for c in TARGETS)


@register("w02_hot_fill", f"""
    SELECT asset, ts, {", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER w, first_value({c} IGNORE NULLS) OVER a, 0) AS {c}" for c in TARGETS)}
    FROM (SELECT asset, ts, {_SPARSE} FROM ({HOT}))
    WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           a AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def w02_hot_fill(spark, sf_dir):
    """W1 + W2: values of trading slots filled forward, then backward."""
    p = hot_panel(spark, sf_dir)
    sparse = p.select("asset", "ts", *[F.when(F.col("is_trading") == 1, F.col(c)).alias(c) for c in TARGETS])
    return fill_series(sparse, list(TARGETS), chunk_seconds=DAY)


@register("w09_hot_reclock", f"""
    SELECT asset, ts AS orig_ts, TIMESTAMP '2020-01-01 00:00:00'
           + (row_number() OVER (PARTITION BY asset ORDER BY ts) - 1) * INTERVAL 15 MINUTE AS ts
    FROM ({HOT}) WHERE is_trading = 1""")
def w09_hot_reclock(spark, sf_dir):
    """W9 on the trading rows."""
    d = S.trading_only(hot_panel(spark, sf_dir)).withColumn("orig_ts", F.col("ts"))
    return reclock_by(d, "2020-01-01 00:00:00", 15, chunk_seconds=DAY).select("asset", "orig_ts", "ts")


def _p7_sql():
    split = f"SELECT *, CASE WHEN ts < TIMESTAMP '{VAL_START}' THEN 'train' ELSE 'val' END AS split FROM ({HOT})"
    parts = [O.hybrid_sql(f"SELECT * FROM ({split}) WHERE split = '{s}'") for s in ("train", "val")]
    return f"""
    WITH s AS (({parts[0]}) UNION ALL ({parts[1]})),
    ok AS (SELECT asset FROM s GROUP BY asset
           HAVING count(*) FILTER (WHERE split = 'train') >= 44 AND count(*) FILTER (WHERE split = 'val') >= 44)
    SELECT split, asset, ts AS orig_ts,
           CASE split WHEN 'train' THEN TIMESTAMP '2020-01-01 00:00:00' ELSE TIMESTAMP '2021-01-01 00:00:00' END
             + (row_number() OVER (PARTITION BY split, asset ORDER BY ts) - 1) * INTERVAL 15 MINUTE AS ts,
           high, low, close, volume
    FROM s WHERE asset IN (SELECT asset FROM ok)"""


@register("p07_hot_prepare_series", _p7_sql())
def p07_hot_prepare_series(spark, sf_dir):
    """P7 in chunks: Hybrid per split, contracts long enough on both sides, filled, on a continuous clock."""
    out = prepare_series(split_by_dates(hot_panel(spark, sf_dir), VAL_START), "Hybrid", 24, 10, chunk_seconds=DAY)
    return out.select("split", "asset", "orig_ts", "ts", *TARGETS)


@register("p07_original_series", f"""
    WITH s AS (SELECT *, CASE WHEN ts < TIMESTAMP '{VAL_START}' THEN 'train' ELSE 'val' END AS split FROM ({HOT})),
    ok AS (SELECT asset FROM s GROUP BY asset
           HAVING count(*) FILTER (WHERE split = 'train') >= 44 AND count(*) FILTER (WHERE split = 'val') >= 44)
    SELECT split, asset, ts AS orig_ts,
           CASE split WHEN 'train' THEN TIMESTAMP '2020-01-01 00:00:00' ELSE TIMESTAMP '2021-01-01 00:00:00' END
             + (row_number() OVER (PARTITION BY split, asset ORDER BY ts) - 1) * INTERVAL 15 MINUTE AS ts,
           high::FLOAT::DOUBLE AS high, low::FLOAT::DOUBLE AS low, close::FLOAT::DOUBLE AS close, volume::FLOAT::DOUBLE AS volume
    FROM s WHERE asset IN (SELECT asset FROM ok)""")
def p07_original_series(spark, sf_dir):
    """P7 with the Original strategy (all rows), FLOAT values (F16) and times without a zone."""
    out = prepare_series(split_by_dates(hot_panel(spark, sf_dir), VAL_START), "Original", 24, 10, chunk_seconds=DAY, as_float=True, naive_time=True)
    return out.select("split", "asset", "orig_ts", "ts", *[F.col(c).cast("double").alias(c) for c in TARGETS])


@register("f08_flag_by_volume", f"""
    SELECT asset, ts, is_trading, island_len AS segment_length FROM ({O.islands_sql(HOT)}) WHERE is_trading = 1""")
def f08_flag_by_volume(spark, sf_dir):
    """F8: a panel without the flag column; segments take volume > 0."""
    p = hot_panel(spark, sf_dir).drop("is_trading")
    return with_segments(p, chunk_seconds=DAY).filter("is_trading = 1").select("asset", "ts", "is_trading", "segment_length")


@register("r16_hot_lookback", " UNION ALL ".join(f"""
    SELECT '{fc}' AS forecaster, {n} AS max_context_length, round({O.smape_agg_sql()}, 6) AS smape
    FROM ({O.eval_sql(HOT, n, 10, kind, LEVELS)})""" for n in (24, 96) for fc, kind in (("naive", "naive"), ("quantile_median", "quantile"))))
def r16_hot_lookback(spark, sf_dir):
    """R16 where one contract holds a third of the rows: positions and contexts by chunks."""
    s = score_contexts(hot_panel(spark, sf_dir), (24, 96), LEVELS, chunk_seconds=DAY, chunk_rows=512)
    return smape_of(s, ["forecaster", "max_context_length"]).select("forecaster", "max_context_length", F.round("smape", 6).alias("smape"))


@register("a04_hot_describe", f"""
    SELECT asset, column_name, count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min,
           quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max
    FROM (UNPIVOT (SELECT asset, high, low, close, volume FROM ({HOT})) ON high, low, close, volume INTO NAME column_name VALUE x)
    GROUP BY asset, column_name""")
def a04_hot_describe(spark, sf_dir):
    """A4 with exact percentiles from histograms that are refined."""
    return describe_refined(hot_panel(spark, sf_dir), list(TARGETS))
