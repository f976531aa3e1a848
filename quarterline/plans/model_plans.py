"""Plans for splits, scalers, forecasts and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators.features import featurize
from ..operators.scale import apply_scalers, fit_scalers
from ..operators.split import liquidity_buckets, seasonal_blocks, split_by_dates, split_by_years
from ..schema import TARGETS, WindowParams
from ..sources.candles import brand_panel
from . import oracle as O
from .catalog import register
from .segment_plans import TRADED_1H, traded_panel

VAL_START = "2024-01-22"
SPLIT_1H = O.split_dates_sql(TRADED_1H, VAL_START)
EVAL = WindowParams(input_chunk_length=24, output_chunk_length=10)
LEVELS = (0.1, 0.5, 0.9)


def split_panel(spark, sf_dir):
    return split_by_dates(traded_panel(spark, sf_dir), VAL_START)


def _r6(c):
    return F.round(c, 6)


@register("p06_date_split_features", f"""
    SELECT *, CASE WHEN ts < TIMESTAMP '{VAL_START}' THEN 'train' ELSE 'val' END AS split
    FROM ({O.features_sql(O.event_panel_sql(3600))})""")
def p06_date_split_features(spark, sf_dir):
    """Features computed over the whole panel, then split by date (state carries over)."""
    from .feature_plans import _rounded_features
    from ..sources.candles import events_panel
    return split_by_dates(_rounded_features(events_panel(spark, sf_dir, 3600)), VAL_START)


@register("p06_year_split_brands", f"""
    SELECT * FROM (SELECT *, CASE WHEN year(ts) BETWEEN 1995 AND 1998 THEN 'train'
                                  WHEN year(ts) = 1999 THEN 'val' END AS split
                   FROM ({O.features_sql(O.brand_panel_sql(), joined=False)})) WHERE split IS NOT NULL""")
def p06_year_split_brands(spark, sf_dir):
    """P6 with year sets: 1995-1998 train, 1999 val, other years dropped."""
    from .feature_plans import _rounded_features
    return split_by_years(_rounded_features(brand_panel(spark, sf_dir)), (1995, 1996, 1997, 1998), (1999,))


@register("p09_test_split_brands", f"""
    SELECT asset, ts, split FROM (
      SELECT asset, ts, CASE WHEN year(ts) BETWEEN 1995 AND 1998 THEN 'train' WHEN year(ts) = 1999 THEN 'val'
                             WHEN year(ts) = 2000 THEN 'test' END AS split FROM ({O.brand_panel_sql()}))
    WHERE split IS NOT NULL""")
def p09_test_split_brands(spark, sf_dir):
    """Third (test) period."""
    return split_by_years(brand_panel(spark, sf_dir), (1995, 1996, 1997, 1998), (1999,), (2000,)).select(
        "asset", "ts", "split")


@register("p10_liquidity_buckets", f"""
    WITH l AS (SELECT asset, avg(is_trading) AS liquidity FROM ({O.traded_sql(O.event_panel_sql(900))}) GROUP BY asset),
    r AS (SELECT *, row_number() OVER (ORDER BY liquidity DESC, asset) AS rk, count(*) OVER () AS n FROM l),
    b AS (SELECT *, CASE WHEN rk <= ceil(n * 0.2) THEN 'top' WHEN rk > n - ceil(n * 0.2) THEN 'bottom'
                         ELSE 'mid' END AS bucket FROM r)
    SELECT asset, liquidity, bucket, bucket_rank,
           (bucket_rank <= CASE bucket WHEN 'top' THEN 3 WHEN 'mid' THEN 3 ELSE 2 END)::INTEGER AS representative
    FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY liquidity DESC, asset) AS bucket_rank FROM b)""")
def p10_liquidity_buckets(spark, sf_dir):
    """P10: top 20 / mid 60 / bottom 20 % liquidity buckets and 3/3/2 representatives."""
    return liquidity_buckets(traded_panel(spark, sf_dir, 900))


@register("a08_scalers", f"""
    SELECT asset, target, round(mean, 6) AS mean, round(scale, 6) AS scale, n FROM ({O.scalers_sql(SPLIT_1H)})""")
def a08_scalers(spark, sf_dir):
    """Per contract x target mean / population std over trading rows of the training split."""
    s = fit_scalers(split_panel(spark, sf_dir).filter("split = 'train'"))
    return s.withColumns({"mean": _r6(F.col("mean")), "scale": _r6(F.col("scale"))})


def _scaled_val_sql(inverse_roundtrip: bool = False) -> str:
    sel = []
    for t in TARGETS:
        m = f"coalesce(s_{t}.mean, 0)"
        sc = f"coalesce(s_{t}.scale, 1)"
        expr = f"(v.{t} - {m}) / {sc}"
        if inverse_roundtrip:
            expr = f"({expr}) * {sc} + {m}"
        sel.append(f"round({expr}, 6) AS {t}")
    joins = " ".join(f"LEFT JOIN s s_{t} ON s_{t}.asset = v.asset AND s_{t}.target = '{t}'" for t in TARGETS)
    return f"""
    WITH s AS ({O.scalers_sql(SPLIT_1H)})
    SELECT v.asset, v.ts, {", ".join(sel)}, v.is_trading
    FROM (SELECT * FROM ({SPLIT_1H}) WHERE split = 'val') v {joins}"""


@register("r03_scaled_val", _scaled_val_sql())
def r03_scaled_val(spark, sf_dir):
    """R3 + J6: validation rows scaled with the training scalers (contracts without one unchanged)."""
    sp = split_panel(spark, sf_dir)
    s = fit_scalers(sp.filter("split = 'train'"))
    out = apply_scalers(sp.filter("split = 'val'"), s)
    return out.select("asset", "ts", *[_r6(F.col(t)).alias(t) for t in TARGETS], "is_trading")


@register("r04_inverse_roundtrip", _scaled_val_sql(inverse_roundtrip=True))
def r04_inverse_roundtrip(spark, sf_dir):
    """inverse(scale(x)) returns the original values."""
    sp = split_panel(spark, sf_dir)
    s = fit_scalers(sp.filter("split = 'train'"))
    back = apply_scalers(apply_scalers(sp.filter("split = 'val'"), s), s, inverse=True)
    return back.select("asset", "ts", *[_r6(F.col(t)).alias(t) for t in TARGETS], "is_trading")


def val_rows(spark, sf_dir):
    return split_panel(spark, sf_dir).filter("split = 'val'").drop("split")


def naive_eval(spark, sf_dir):
    d = FC.naive_last_value(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length)
    return FC.evaluation_frame(d, EVAL, flat={t: F.col(f"f_{t}") for t in TARGETS})


def quantile_eval(spark, sf_dir):
    d = FC.quantile_context(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length, LEVELS)
    med = len(LEVELS) // 2 + 1
    return FC.evaluation_frame(d, EVAL, flat={t: F.element_at(F.col(f"q_{t}"), med) for t in TARGETS})


def calendar_eval(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    prof = FC.calendar_profile(sp.filter("split = 'train'"))
    d = FC.with_calendar_mean(FC.with_origins(val_rows(spark, sf_dir), EVAL), prof)
    return FC.evaluation_frame(d, EVAL, per_row={t: F.col(f"g_{t}") for t in TARGETS})


VAL_ROWS_SQL = f"SELECT * EXCLUDE (split) FROM ({SPLIT_1H}) WHERE split = 'val'"
NAIVE_EVAL_SQL = O.eval_sql(VAL_ROWS_SQL, 24, 10, "naive")


@register("r12_naive_forecasts", f"""
    SELECT window_id, h, target, NULL::DOUBLE AS quantile, p AS value FROM ({NAIVE_EVAL_SQL})""")
def r12_naive_forecasts(spark, sf_dir):
    """R12 in the long forecast layout (A6): last non-zero context value, flat over 10 steps."""
    d = FC.naive_last_value(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length)
    return FC.point_forecasts_long(d, EVAL.output_chunk_length).drop("asset")


@register("r11_quantile_forecasts", f"""
    WITH v AS ({VAL_ROWS_SQL.replace('SELECT *', 'SELECT *', 1)}),
    o AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS pos,
                 count(*) OVER (PARTITION BY asset) AS n_rows FROM v),
    d AS (SELECT asset, row_number() OVER (ORDER BY asset) - 1 AS idx FROM (SELECT DISTINCT asset FROM v)),
    q AS (SELECT o.*, d.idx,
                 {", ".join(f"quantile_cont({t}, [{', '.join(map(str, LEVELS))}]) OVER c AS q_{t}" for t in TARGETS)}
          FROM o JOIN d USING (asset)
          WINDOW c AS (PARTITION BY o.asset ORDER BY o.ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
    SELECT idx * 4294967296 + (pos - 23) AS window_id, tg.target, lv.quantile,
           round(CASE tg.target {" ".join(f"WHEN '{t}' THEN q_{t}[lv.i]" for t in TARGETS)} END, 6) AS value
    FROM q CROSS JOIN (VALUES ('high'), ('low'), ('close'), ('volume')) tg(target)
    CROSS JOIN (VALUES {", ".join(f"({i + 1}, {q})" for i, q in enumerate(LEVELS))}) lv(i, quantile)
    WHERE pos >= 23 AND pos + 10 < n_rows AND n_rows >= 34""")
def r11_quantile_forecasts(spark, sf_dir):
    """Empirical context quantiles (0.1, 0.5, 0.9) per target; flat forecasts (h is NULL
    for every row of the long layout, so the registered output leaves it out)."""
    d = FC.quantile_context(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length, LEVELS)
    return FC.quantile_forecasts_long(d, LEVELS).drop("asset", "h").withColumn("value", _r6(F.col("value")))


@register("r09_align_median", f"""
    SELECT window_id, h, target, round(p, 6) AS value FROM ({O.eval_sql(VAL_ROWS_SQL, 24, 10, 'quantile', LEVELS)})""")
def r09_align_median(spark, sf_dir):
    """Quantile forecasts -> the median level, flat forecasts repeated over h = 1..10."""
    d = FC.quantile_context(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length, LEVELS)
    al = FC.align_to_median(FC.quantile_forecasts_long(d, LEVELS), LEVELS, EVAL.output_chunk_length)
    return al.select("window_id", "h", "target", _r6(F.col("value")).alias("value"))


@register("a13_smape_naive", f"""
    SELECT target, round({O.smape_agg_sql()}, 6) AS smape, sum(m) AS n_scored FROM ({NAIVE_EVAL_SQL}) GROUP BY target
    UNION ALL
    SELECT 'ALL', round({O.smape_agg_sql()}, 6), sum(m) FROM ({NAIVE_EVAL_SQL})""")
def a13_smape_naive(spark, sf_dir):
    """Masked sMAPE of the naive forecaster per target and overall (element weighted)."""
    ev = naive_eval(spark, sf_dir)
    per = M.smape(ev, ["target"])
    allr = M.smape(ev).withColumn("target", F.lit("ALL"))
    return per.unionByName(allr).withColumn("smape", _r6(F.col("smape")))


@register("a15_macro_smape_naive", f"""
    WITH e AS ({NAIVE_EVAL_SQL}),
    w AS (SELECT asset, start_pos, min(start_pos) OVER (PARTITION BY asset) AS first_pos,
                 count(*) OVER (PARTITION BY asset) AS n FROM (SELECT DISTINCT asset, start_pos FROM e)),
    off AS (SELECT asset, coalesce(sum(n) OVER (ORDER BY asset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
            FROM (SELECT DISTINCT asset, n FROM w)),
    b AS (SELECT e.*, (off.o + e.start_pos - w.first_pos) // 64 AS batch_id
          FROM e JOIN w USING (asset, start_pos) JOIN off USING (asset)),
    s AS (SELECT batch_id, {O.smape_agg_sql()} AS s FROM b GROUP BY batch_id)
    SELECT round(coalesce(avg(s) * 100.0, 'inf'::DOUBLE), 6) AS macro_smape, count(*) AS n_batches FROM s""")
def a15_macro_smape_naive(spark, sf_dir):
    """Mean of per-batch sMAPE x 100 over batches of 64 windows (reference's macro score)."""
    r = M.macro_smape(naive_eval(spark, sf_dir), 64)
    return r.withColumn("macro_smape", _r6(F.col("macro_smape")))


@register("a20_smape_asset_summary", f"""
    WITH per AS (SELECT asset, target, {O.smape_agg_sql()} AS s FROM ({NAIVE_EVAL_SQL}) GROUP BY asset, target)
    SELECT target, round(avg(s), 6) AS mean_smape, round(median(s), 6) AS median_smape, count(*) AS n_pairs
    FROM per GROUP BY target
    UNION ALL SELECT 'ALL', round(avg(s), 6), round(median(s), 6), count(*) FROM per""")
def a20_smape_asset_summary(spark, sf_dir):
    """sMAPE per contract x target, then mean and median over contracts."""
    r = M.smape_asset_summary(naive_eval(spark, sf_dir))
    return r.withColumns({"mean_smape": _r6(F.col("mean_smape")), "median_smape": _r6(F.col("median_smape"))})


def _calendar_eval_sql():
    prof = f"""SELECT asset, month(ts) AS mon, isodow(ts) - 1 AS dow, hour(ts) AS hr,
                      {", ".join(f"avg({t}) AS g_{t}" for t in TARGETS)}
               FROM ({SPLIT_1H}) WHERE split = 'train' GROUP BY ALL"""
    base = O.eval_sql(VAL_ROWS_SQL, 24, 10, "naive")
    p = "CASE e.target " + " ".join(f"WHEN '{t}' THEN coalesce(pr.g_{t}, 0)" for t in TARGETS) + " END"
    return f"""
    SELECT e.window_id, e.asset, e.start_pos, e.h, e.target, e.target_ts, e.y, {p} AS p, e.m
    FROM ({base}) e LEFT JOIN ({prof}) pr ON pr.asset = e.asset AND pr.mon = month(e.target_ts)
         AND pr.dow = isodow(e.target_ts) - 1 AND pr.hr = hour(e.target_ts)"""


MODELS_SQL = f"""
    SELECT 'naive' AS model, {O.smape_agg_sql()} AS smape FROM ({NAIVE_EVAL_SQL})
    UNION ALL SELECT 'calendar_mean', {O.smape_agg_sql()} FROM ({_calendar_eval_sql()})
    UNION ALL SELECT 'quantile_median', {O.smape_agg_sql()} FROM ({O.eval_sql(VAL_ROWS_SQL, 24, 10, 'quantile', LEVELS)})"""


@register("a16_model_comparison", f"""
    SELECT model, round(smape, 6) AS smape, round(min(smape) FILTER (WHERE model IN ('naive', 'calendar_mean')) OVER (), 6)
           AS baseline_smape,
           smape < min(smape) FILTER (WHERE model IN ('naive', 'calendar_mean')) OVER () AS beats_baseline
    FROM ({MODELS_SQL})""")
def a16_model_comparison(spark, sf_dir):
    """A16 (+R13): naive, calendar-mean and quantile-median scores; baseline = best of the first two."""
    scores = (M.smape(naive_eval(spark, sf_dir)).withColumn("model", F.lit("naive"))
              .unionByName(M.smape(calendar_eval(spark, sf_dir)).withColumn("model", F.lit("calendar_mean")))
              .unionByName(M.smape(quantile_eval(spark, sf_dir)).withColumn("model", F.lit("quantile_median")))
              .select("model", "smape"))
    r = M.model_comparison(scores, ["naive", "calendar_mean"])
    return r.select("model", _r6(F.col("smape")).alias("smape"), _r6(F.col("baseline_smape")).alias("baseline_smape"),
                    "beats_baseline")


@register("a22_error_by_calendar", f"""
    SELECT 'hour' AS dimension, hour(target_ts) AS value, round({O.smape_agg_sql()}, 6) AS smape
    FROM ({NAIVE_EVAL_SQL}) GROUP BY 2
    UNION ALL
    SELECT 'weekday', isodow(target_ts) - 1, round({O.smape_agg_sql()}, 6) FROM ({NAIVE_EVAL_SQL}) GROUP BY 2""")
def a22_error_by_calendar(spark, sf_dir):
    """Naive-forecast error by hour of day and weekday of the forecast target."""
    return M.error_by_calendar(naive_eval(spark, sf_dir)).withColumn("smape", _r6(F.col("smape")))


@register("a22_error_by_liquidity", f"""
    WITH e AS MATERIALIZED ({NAIVE_EVAL_SQL}),
    l AS (SELECT asset, avg(is_trading) AS liquidity FROM ({TRADED_1H}) GROUP BY asset),
    r AS (SELECT *, row_number() OVER (ORDER BY liquidity DESC, asset) AS rk, count(*) OVER () AS n FROM l),
    b AS (SELECT asset, CASE WHEN rk <= ceil(n * 0.2) THEN 'top' WHEN rk > n - ceil(n * 0.2) THEN 'bottom' ELSE 'mid' END AS bucket FROM r)
    SELECT 'hour' AS dimension, hour(target_ts)::VARCHAR AS value, round({O.smape_agg_sql()}, 6) AS smape FROM e GROUP BY 2
    UNION ALL SELECT 'weekday', (isodow(target_ts) - 1)::VARCHAR, round({O.smape_agg_sql()}, 6) FROM e GROUP BY 2
    UNION ALL SELECT 'liquidity', bucket, round({O.smape_agg_sql()}, 6) FROM e JOIN b USING (asset) GROUP BY 2""")
def a22_error_by_liquidity(spark, sf_dir):
    """Error by hour, weekday and liquidity bucket in one pass."""
    buckets = liquidity_buckets(traded_panel(spark, sf_dir))
    return M.error_by_dimension(naive_eval(spark, sf_dir), buckets).withColumn("smape", _r6(F.col("smape")))


BLOCK_DAYS, SEED = 28, 827
_SEASON = "((month({}) % 12) // 3)"


@register("p10_seasonal_blocks", f"""
    WITH t AS MATERIALIZED ({O.traded_sql(O.brand_panel_sql())}),
    l AS (SELECT asset, avg(is_trading) AS liquidity FROM t GROUP BY asset),
    r AS (SELECT *, row_number() OVER (ORDER BY liquidity DESC, asset) AS rk, count(*) OVER () AS n FROM l),
    b AS (SELECT *, CASE WHEN rk <= ceil(n * 0.2) THEN 'top' WHEN rk > n - ceil(n * 0.2) THEN 'bottom' ELSE 'mid' END AS bucket FROM r),
    k AS (SELECT asset, bucket, row_number() OVER (PARTITION BY bucket ORDER BY liquidity DESC, asset) AS br FROM b),
    rep AS (SELECT asset, bucket FROM k WHERE br <= CASE bucket WHEN 'top' THEN 3 WHEN 'mid' THEN 3 ELSE 2 END),
    d AS (SELECT t.*, rep.bucket, (epoch(ts)::BIGINT // 86400) // {BLOCK_DAYS} AS block, {_SEASON.format('ts')} AS season_no
          FROM t JOIN rep USING (asset)),
    i AS (SELECT asset, block, min(season_no) AS season_no FROM d GROUP BY asset, block
          HAVING min(season_no) = max(season_no) AND count(DISTINCT epoch(ts)::BIGINT // 86400) = {BLOCK_DAYS}),
    p AS (SELECT *, row_number() OVER (PARTITION BY asset, season_no
                                       ORDER BY md5('{SEED}' || '|' || asset || '|' || block::VARCHAR)) AS n FROM i)
    SELECT d.bucket, d.asset, d.ts, ['winter', 'spring', 'summer', 'autumn'][d.season_no + 1] AS season, d.block, d.close, d.is_trading
    FROM d JOIN p ON p.asset = d.asset AND p.block = d.block WHERE p.n <= 2""")
def p10_seasonal_blocks(spark, sf_dir):
    """P10: of the 3/3/2 representatives two whole 28-day blocks per season, chosen by hash."""
    from ..functions.calendar import is_trading
    p = brand_panel(spark, sf_dir)
    p = p.withColumn("is_trading", is_trading(p))
    reps = liquidity_buckets(p).filter("representative = 1").select("asset", "bucket")
    rows = seasonal_blocks(p.join(reps, "asset"), BLOCK_DAYS, 2, SEED)
    return rows.select("bucket", "asset", "ts", "season", "block", "close", "is_trading")
