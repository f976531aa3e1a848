"""Plans for segments, boundary context and subsampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import is_trading
from ..operators import sampling as S
from ..operators.segments import (boundary_flag, segment_stats, select_best, trading_segments,
                                  window_counts, with_changes, with_segments)
from ..sources.candles import events_panel
from . import oracle as O
from .catalog import register

HOUR = 3600
TRADED_1H = O.traded_sql(O.event_panel_sql(HOUR))
MIN_SEG = 4  # no island reaches 96 hourly rows at sf0.01; the reference default is 96


def traded_panel(spark, sf_dir, bucket=HOUR):
    p = events_panel(spark, sf_dir, bucket)
    return p.withColumn("is_trading", is_trading(p))


@register("w03_change_points", f"""
    SELECT asset, ts, is_trading,
           is_trading - coalesce(lag(is_trading) OVER (PARTITION BY asset ORDER BY ts), 0) AS change
    FROM ({TRADED_1H})""")
def w03_change_points(spark, sf_dir):
    """+1 where trading starts, -1 where it stops (initial state 0)."""
    return with_changes(traded_panel(spark, sf_dir)).select("asset", "ts", "is_trading", "change")


@register("w05_trading_segments", f"""
    SELECT asset, ts, island_no AS segment_id, island_len AS segment_length
    FROM ({O.islands_sql(TRADED_1H)}) WHERE is_trading = 1 AND island_len >= {MIN_SEG}""")
def w05_trading_segments(spark, sf_dir):
    """Rows of trading islands of at least 4 hourly rows, with island id and length."""
    return trading_segments(traded_panel(spark, sf_dir), MIN_SEG).select(
        "asset", "ts", "segment_id", "segment_length")


@register("w05_segments_15m_first_row", f"""
    SELECT asset, ts, island_no AS segment_id, island_len AS segment_length
    FROM ({O.islands_sql(O.traded_sql(O.event_panel_sql(900)))}) WHERE is_trading = 1""")
def w05_segments_15m_first_row(spark, sf_dir):
    """W5 without a length filter on 15-minute candles: islands at both ends of the grid."""
    return with_segments(traded_panel(spark, sf_dir, 900)).filter("is_trading = 1").select(
        "asset", "ts", "segment_id", "segment_length")


A10_SQL = f"""
    WITH s AS ({O.islands_sql(TRADED_1H)}),
    a AS (SELECT asset, count(*) AS total_rows,
                 count(*) FILTER (WHERE island_len >= {MIN_SEG}) AS trading_rows,
                 count(DISTINCT island_no) FILTER (WHERE island_len >= {MIN_SEG}) AS n_segments,
                 avg(is_trading) AS trading_ratio_original
          FROM s GROUP BY asset)
    SELECT asset, total_rows, trading_rows, n_segments, trading_rows / n_segments AS avg_segment_length,
           trading_ratio_original
    FROM a WHERE n_segments > 0"""


@register("a10_segment_stats", A10_SQL)
def a10_segment_stats(spark, sf_dir):
    """A10: per-contract segment statistics (contracts without kept segments omitted)."""
    return segment_stats(traded_panel(spark, sf_dir), MIN_SEG)


@register("w07_select_best_segments", f"""
    WITH a AS ({A10_SQL}),
    r AS (SELECT *, row_number() OVER (ORDER BY trading_rows DESC, asset) AS rank,
                 coalesce(sum(trading_rows) OVER (ORDER BY trading_rows DESC, asset
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM a)
    SELECT asset, total_rows, trading_rows, n_segments, avg_segment_length, trading_ratio_original,
           rank, before + trading_rows AS cumulative_rows
    FROM r WHERE rank <= 5 AND before < 300""")
def w07_select_best_segments(spark, sf_dir):
    """Top contracts by kept rows until 5 contracts or 300 rows are reached."""
    return select_best(segment_stats(traded_panel(spark, sf_dir), MIN_SEG), 300, 5)


@register("w06_boundary_keep", f"""
    SELECT asset, ts, is_trading, keep_boundary FROM ({O.boundary_sql(TRADED_1H)})""")
def w06_boundary_keep(spark, sf_dir):
    """Trading rows, the 4 rows before each start, each stop row and the 4 after it."""
    return boundary_flag(traded_panel(spark, sf_dir)).select("asset", "ts", "is_trading", "keep_boundary")


_ROW = "asset, ts, high, low, close, volume, is_trading"


@register("p01_trading_only", f"SELECT {_ROW} FROM ({TRADED_1H}) WHERE is_trading = 1")
def p01_trading_only(spark, sf_dir):
    return S.trading_only(traded_panel(spark, sf_dir)).select(*_ROW.split(", "))


STRAT_SQL = f"""
    SELECT {_ROW} FROM (
      SELECT *, row_number() OVER (PARTITION BY asset, is_trading ORDER BY {O.md5_key_sql()}, ts) AS rk,
             count(*) OVER (PARTITION BY asset, is_trading) AS n
      FROM ({TRADED_1H}))
    WHERE is_trading = 1 OR rk <= floor(n * 0.1::DOUBLE)"""


@register("p02_stratified", STRAT_SQL)
def p02_stratified(spark, sf_dir):
    """All trading rows + exactly floor(0.1 * n) non-trading rows per contract (md5 order)."""
    return S.stratified(traded_panel(spark, sf_dir), 0.1).select(*_ROW.split(", "))


@register("p03_boundary_aware", f"SELECT {_ROW} FROM ({O.boundary_sql(TRADED_1H)}) WHERE keep_boundary")
def p03_boundary_aware(spark, sf_dir):
    return S.boundary_aware(traded_panel(spark, sf_dir)).select(*_ROW.split(", "))


HYBRID_SQL = f"""
    WITH b AS ({O.boundary_sql(TRADED_1H)}),
    rest AS (SELECT asset, ts,
                    row_number() OVER (PARTITION BY asset ORDER BY {O.md5_key_sql()}, ts) AS rk,
                    count(*) OVER (PARTITION BY asset) AS n
             FROM b WHERE is_trading = 0 AND NOT keep_boundary)
    SELECT {", ".join("b." + c for c in _ROW.split(", "))} FROM b LEFT JOIN rest USING (asset, ts)
    WHERE b.keep_boundary OR rest.rk <= floor(rest.n * 0.05::DOUBLE)"""


@register("p04_hybrid", HYBRID_SQL)
def p04_hybrid(spark, sf_dir):
    """Boundary-aware rows + exactly floor(0.05 * remaining) other non-trading rows."""
    return S.hybrid(traded_panel(spark, sf_dir), 0.05).select(*_ROW.split(", "))


@register("p05_strategy_dispatch", f"SELECT {_ROW} FROM ({STRAT_SQL})")
def p05_strategy_dispatch(spark, sf_dir):
    """P5: strategy chosen by name through the registry (here the recommended 'Stratified')."""
    return S.apply_strategy(traded_panel(spark, sf_dir), "Stratified").select(*_ROW.split(", "))


def _cmp_sql():
    parts = [("Original", f"SELECT {_ROW} FROM ({TRADED_1H})"),
             ("Trading-Only", f"SELECT {_ROW} FROM ({TRADED_1H}) WHERE is_trading = 1"),
             ("Stratified", STRAT_SQL),
             ("Boundary-Aware", f"SELECT {_ROW} FROM ({O.boundary_sql(TRADED_1H)}) WHERE keep_boundary"),
             ("Hybrid", HYBRID_SQL)]
    u = " UNION ALL ".join(f"SELECT '{n}' AS strategy, is_trading FROM ({q})" for n, q in parts)
    return f"""
    WITH u AS ({u}), o AS (SELECT count(*) AS orig FROM ({TRADED_1H}))
    SELECT strategy, count(*) AS total_rows, sum(is_trading)::BIGINT AS trading_rows,
           count(*) - sum(is_trading)::BIGINT AS non_trading_rows,
           100.0::DOUBLE * sum(is_trading) / count(*) AS trading_pct,
           100.0::DOUBLE * (1.0::DOUBLE - count(*) / any_value(o.orig)) AS size_reduction_pct
    FROM u CROSS JOIN o GROUP BY strategy"""


@register("a12_strategy_comparison", _cmp_sql())
def a12_strategy_comparison(spark, sf_dir):
    """Size and trading share of each strategy's output vs the original panel."""
    return S.compare_strategies(traded_panel(spark, sf_dir))


@register("a11_window_counts", f"""
    SELECT asset, count(*) AS n_rows, greatest(0, count(*) - 24 - 10 + 1) AS n_windows
    FROM ({TRADED_1H}) WHERE is_trading = 1 GROUP BY asset""")
def a11_window_counts(spark, sf_dir):
    """Supervised windows per contract (L_in 24, L_out 10) on the trading-only rows."""
    return window_counts(S.trading_only(traded_panel(spark, sf_dir)), 24, 10)
