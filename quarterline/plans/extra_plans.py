"""Plans for the items the reference specifies only in its documents (D tier):
W11, F25, F26, A21, A23, S20, R14, R15."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import daylight_indicator, minute_of_day
from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators.features import featurize, rolling_nonzero_mean
from ..operators.ml import gbt_forecast
from ..operators.rolling import score_contexts, smape_of
from ..operators.sampling import stratified_by
from ..schema import TARGETS, FeatureParams
from ..session import scratch_path
from ..sources.candles import events_panel
from ..sources.panel_io import export_forecasts_csv
from . import oracle as O
from .catalog import register
from .model_plans import EVAL, LEVELS, NAIVE_EVAL_SQL, SPLIT_1H, VAL_ROWS_SQL, split_panel, val_rows
from .segment_plans import traded_panel

QUARTER = 900
TRADED_15M = O.traded_sql(O.event_panel_sql(QUARTER))


def _r6(c):
    return F.round(c, 6)


@register("w11_rolling_nonzero_mean", f"""
    SELECT asset, ts,
           {", ".join(f"round(avg(nullif({c}, 0)) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING "
                      f"AND CURRENT ROW), 6) AS {c}_mean_{n}" for c in ("close", "volume") for n in (4, 8))}
    FROM ({TRADED_15M})""")
def w11_rolling_nonzero_mean(spark, sf_dir):
    """Rolling mean over 4 and 8 slots of the non-zero close and volume values."""
    p = traded_panel(spark, sf_dir, QUARTER)
    return p.select("asset", "ts", *[_r6(rolling_nonzero_mean(c, n)).alias(f"{c}_mean_{n}")
                                     for c in ("close", "volume") for n in (4, 8)])


@register("f25_minute_daylight", f"""
    SELECT asset, ts, hour(ts) * 60 + minute(ts) AS minute_of_day,
           (CASE WHEN month(ts) BETWEEN 4 AND 9 THEN hour(ts) BETWEEN 6 AND 20
                 ELSE hour(ts) BETWEEN 8 AND 16 END)::INTEGER AS daylight
    FROM ({TRADED_15M})""")
def f25_minute_daylight(spark, sf_dir):
    """minute of day and a month/hour daylight proxy."""
    p = traded_panel(spark, sf_dir, QUARTER)
    return p.select("asset", "ts", minute_of_day("ts").alias("minute_of_day"), daylight_indicator("ts").alias("daylight"))


def _f26_sql(k_max=6):
    joins, sel = [], []
    for k in range(1, k_max + 1):
        joins.append(f"LEFT JOIN ff p{k} ON p{k}.ts = f.ts AND p{k}.idx = f.idx - {k}")
        joins.append(f"LEFT JOIN ff n{k} ON n{k}.ts = f.ts AND n{k}.idx = f.idx + {k}")
    for c in ("high", "low"):
        for k in range(1, k_max + 1):
            pick = f"CASE WHEN f.idx + {k} < f.n_assets THEN n{k}.l_{c} WHEN f.idx - {k} >= 0 THEN p{k}.l_{c} END"
            sel.append(f"coalesce(CASE WHEN f.is_trading = 1 THEN {pick} END, -1.0) AS {c}_lag_adj_{k}")
    return f"""
    WITH panel AS ({O.event_panel_sql(3600)}),
    dim AS ({O.dim_sql('panel')}),
    t AS (SELECT p.*, d.idx, d.n_assets, (p.high + p.low + p.close + p.volume > 0)::INTEGER AS is_trading
          FROM panel p JOIN dim d USING (asset)),
    ff AS (SELECT *, last_value(nullif(high, 0) IGNORE NULLS) OVER w AS l_high,
                     last_value(nullif(low, 0) IGNORE NULLS) OVER w AS l_low
           FROM t WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT f.asset, f.ts, {", ".join(sel)} FROM ff f {" ".join(joins)}"""


F26_COLS = [f"{c}_lag_adj_{k}" for c in ("high", "low") for k in range(1, 7)]


@register("f26_neighbour_high_low", _f26_sql())
def f26_neighbour_high_low(spark, sf_dir):
    """the neighbours' last high and low as extra neighbour features (same precedence, mask, fill)."""
    f = featurize(events_panel(spark, sf_dir, 3600), FeatureParams(neighbour_extra=("high", "low")))
    return f.select("asset", "ts", *F26_COLS)


TEST_START = "2024-01-26"


def _a21_sql():
    parts = []
    for split, cond in (("val", f"ts < TIMESTAMP '{TEST_START}'"), ("test", f"ts >= TIMESTAMP '{TEST_START}'")):
        rows = f"SELECT * FROM ({VAL_ROWS_SQL}) WHERE {cond}"
        for model, kind in (("naive", "naive"), ("quantile_median", "quantile")):
            ev = O.eval_sql(rows, 24, 10, kind, LEVELS)
            parts.append(f"SELECT '{model}' AS model, target, '{split}' AS split, {O.smape_agg_sql()} AS s "
                         f"FROM ({ev}) GROUP BY target")
    return f"""
    WITH s AS ({" UNION ALL ".join(parts)})
    SELECT model, target, round(max(s) FILTER (WHERE split = 'val'), 6) AS val_smape,
           round(max(s) FILTER (WHERE split = 'test'), 6) AS test_smape
    FROM s GROUP BY model, target"""


@register("a21_results_table", _a21_sql())
def a21_results_table(spark, sf_dir):
    """Model x target sMAPE with validation and test periods as columns (pivot)."""
    v = val_rows(spark, sf_dir)
    periods = v.withColumn("period", F.when(F.col("ts") < F.to_timestamp(F.lit(TEST_START)), "val").otherwise("test"))
    scores = score_contexts(periods, [EVAL.input_chunk_length], LEVELS, EVAL.output_chunk_length, ("period", "asset"), ("period",))
    long = smape_of(scores, [F.col("forecaster").alias("model"), "target", "period"])
    wide = long.groupBy("model", "target").pivot("period", ["val", "test"]).agg(F.first("smape"))
    return wide.select("model", "target", _r6(F.col("val")).alias("val_smape"), _r6(F.col("test")).alias("test_smape"))


SEEDS = (827, 828, 829)


def _a23_sql():
    parts = []
    for seed in SEEDS:
        ev = O.eval_sql(O.stratified_sql(VAL_ROWS_SQL, 0.1, seed), 24, 10, "naive")
        parts.append(f"SELECT {seed} AS seed, {O.smape_agg_sql()} AS s FROM ({ev})")
    return f"""
    SELECT 'Stratified' AS strategy, count(*) AS n_seeds, round(avg(s), 6) AS mean_smape,
           round(stddev_samp(s), 6) AS std_smape FROM ({" UNION ALL ".join(parts)})"""


@register("a23_multi_seed_scores", _a23_sql())
def a23_multi_seed_scores(spark, sf_dir):
    """The stratified subsample drawn with three seeds; naive-forecast sMAPE mean +- std."""
    v = val_rows(spark, sf_dir)
    seeds = F.explode(F.array(*[F.lit(x) for x in SEEDS])).alias("seed")
    drawn = stratified_by(v.select("*", seeds), 0.1, F.col("seed"), ("seed", "asset"))
    scores = score_contexts(drawn, [EVAL.input_chunk_length], LEVELS, EVAL.output_chunk_length, ("seed", "asset"), ("seed",))
    s = smape_of(scores.filter("forecaster = 'naive'"), ["seed"])
    return s.agg(F.lit("Stratified").alias("strategy"), F.count(F.lit(1)).alias("n_seeds"),
                 _r6(F.avg("smape")).alias("mean_smape"), _r6(F.stddev_samp("smape")).alias("std_smape"))


@register("s20_forecast_csv_export", f"""
    SELECT window_id, h, target, p AS value FROM ({NAIVE_EVAL_SQL})""")
def s20_forecast_csv_export(spark, sf_dir):
    """Naive forecasts exported as CSV and read back."""
    d = FC.naive_last_value(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length)
    f = FC.point_forecasts_long(d, EVAL.output_chunk_length).select("window_id", "h", "target", "value")
    path = scratch_path(spark, "forecast-csv")
    export_forecasts_csv(f, path)
    return spark.read.schema("window_id long, h int, target string, value double").option("header", True).csv(path)


@register("r14_gbt_forecast")
def r14_gbt_forecast(spark, sf_dir):
    """One gradient-boosted model for all contracts on 24 close lags + calendar + contract;
    one-step-ahead masked sMAPE on validation."""
    from .feature_plans import _rounded_features
    from ..operators.split import split_by_dates
    f = split_by_dates(_rounded_features(events_panel(spark, sf_dir, 3600)), "2024-01-22")
    pred = gbt_forecast(f.filter("split = 'train'"), f.filter("split = 'val'"), "close", 24, 1)
    ev = pred.select(F.col("label").alias("y"), F.col("prediction").alias("p"), F.col("label_mask").alias("m"))
    return M.smape(ev).select(F.lit("gbt").alias("model"), F.lit("close").alias("target"), "smape", "n_scored")


@register("a14_smape_scaled_space", f"""
    WITH e AS ({NAIVE_EVAL_SQL}), s AS ({O.scalers_sql(SPLIT_1H)}),
    z AS (SELECT e.target, e.m, (e.y - coalesce(s.mean, 0)) / coalesce(s.scale, 1) AS y,
                 (e.p - coalesce(s.mean, 0)) / coalesce(s.scale, 1) AS p
          FROM e LEFT JOIN s ON s.asset = e.asset AND s.target = e.target)
    SELECT 'scaled' AS space, target, round({O.smape_agg_sql()}, 6) AS smape FROM z GROUP BY target
    UNION ALL
    SELECT 'original', target, round({O.smape_agg_sql()}, 6) FROM e GROUP BY target""")
def a14_smape_scaled_space(spark, sf_dir):
    """The naive forecast scored in scaled space (what the reference's loop scores) and,
    after the inverse transform, in original units."""
    from ..operators.scale import fit_scalers
    from .model_plans import naive_eval
    sc = fit_scalers(split_panel(spark, sf_dir).filter("split = 'train'"))
    ev = naive_eval(spark, sf_dir)
    z = M.scaled(ev, sc)
    back = M.inverse_scaled(z, sc)
    return (M.smape(z, ["target"]).select(F.lit("scaled").alias("space"), "target", _r6(F.col("smape")).alias("smape"))
            .unionByName(M.smape(back, ["target"]).select(F.lit("original").alias("space"), "target",
                                                          _r6(F.col("smape")).alias("smape"))))


@register("k05_macro_smape_first_batches", f"""
    WITH e AS ({NAIVE_EVAL_SQL}),
    w AS (SELECT asset, start_pos, min(start_pos) OVER (PARTITION BY asset) AS first_pos,
                 count(*) OVER (PARTITION BY asset) AS n FROM (SELECT DISTINCT asset, start_pos FROM e)),
    off AS (SELECT asset, coalesce(sum(n) OVER (ORDER BY asset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
            FROM (SELECT DISTINCT asset, n FROM w)),
    b AS (SELECT e.*, (off.o + e.start_pos - w.first_pos) // 64 AS batch_id
          FROM e JOIN w USING (asset, start_pos) JOIN off USING (asset)),
    s AS (SELECT batch_id, {O.smape_agg_sql()} AS s FROM b WHERE batch_id < 20 GROUP BY batch_id)
    SELECT round(coalesce(avg(s) * 100.0, 'inf'::DOUBLE), 6) AS macro_smape, count(*) AS n_batches FROM s""")
def k05_macro_smape_first_batches(spark, sf_dir):
    """K5: the macro score over the first 20 batches only (evaluation budget)."""
    from .model_plans import naive_eval
    return M.macro_smape(naive_eval(spark, sf_dir), 64, max_batches=20).withColumn(
        "macro_smape", _r6(F.col("macro_smape")))


@register("s17_refresh_check", f"""
    WITH src AS (SELECT count(DISTINCT asset) AS source_assets FROM ({O.traded_sql(O.event_panel_sql(3600))})),
    flt AS (SELECT count(DISTINCT asset) AS filtered_assets FROM ({O.islands_sql(O.traded_sql(O.event_panel_sql(3600)))})
            WHERE is_trading = 1 AND island_len >= 12)
    SELECT source_assets, filtered_assets, filtered_assets < 0.9 * source_assets AS refresh FROM src, flt""")
def s17_refresh_check(spark, sf_dir):
    """The segment-filtered table (segments >= 12 rows) must hold 90 % of the contracts,
    else it is rebuilt."""
    from ..operators.segments import trading_segments
    from ..sources.csv_ingest import needs_refresh
    p = traded_panel(spark, sf_dir)
    return needs_refresh(p, trading_segments(p, 12))


@register("j09_positional_corr", f"""
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) AS pos FROM ({O.event_panel_sql(3600)}))
    SELECT x.asset AS asset_a, y.asset AS asset_b,
           CASE WHEN stddev_pop(x.close) * stddev_pop(y.close) = 0 THEN NULL ELSE round(corr(x.close, y.close), 6) END
             AS corr
    FROM p x JOIN p y ON x.pos = y.pos AND x.asset < y.asset GROUP BY 1, 2""")
def j09_positional_corr(spark, sf_dir):
    """J9 + A7: close correlation with contracts aligned by row position (the reference's EDA)."""
    from ..operators.profile import cross_asset_correlation
    return cross_asset_correlation(events_panel(spark, sf_dir, 3600), align="position").withColumn(
        "corr", _r6(F.col("corr")))
