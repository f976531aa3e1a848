"""Plans for pluggable forecasters and the join of forecasts with truths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import metrics as M
from ..schema import QUANTILE_SETS
from .catalog import register
from .model_plans import EVAL, NAIVE_EVAL_SQL, naive_eval, val_rows
from .window_plans import _WIN_BASE, trading_windows

LEVELS = QUANTILE_SETS["medium"]


@register("x02_external_quantiles", f"""{_WIN_BASE},
    q AS (SELECT w.window_id, tg.target, quantile_cont(CASE tg.target WHEN 'high' THEN v.high::FLOAT::DOUBLE
              WHEN 'low' THEN v.low::FLOAT::DOUBLE WHEN 'close' THEN v.close::FLOAT::DOUBLE
              ELSE v.volume::FLOAT::DOUBLE END, {LEVELS}) AS qs
          FROM w JOIN v ON v.asset = w.asset AND v.pos BETWEEN w.start_pos AND w.start_pos + 23
          CROSS JOIN (VALUES ('high'), ('low'), ('close'), ('volume')) tg(target)
          GROUP BY w.window_id, tg.target)
    SELECT window_id, target, unnest({LEVELS}::DOUBLE[]) AS quantile, round(unnest(qs), 4) AS value,
           10::BIGINT AS steps, 0::DOUBLE AS spread FROM q""")
def x02_external_quantiles(spark, sf_dir):
    """X2 + R11b + R10: the context-quantile model as an external forecaster over all windows (Arrow
    batches), the medium set of levels; each forecast is flat over the 10 steps."""
    long = FC.score_external(trading_windows(spark, sf_dir), FC.empirical_quantile_model, LEVELS, 10)
    return long.groupBy("window_id", "target", "quantile").agg(
        F.round(F.min("value"), 4).alias("value"), F.count_distinct("h").alias("steps"),
        (F.max("value") - F.min("value")).alias("spread"))


@register("j11_unmatched_forecasts", f"""
    SELECT target, count(*) FILTER (m = 1) AS matched, count(*) FILTER (m <> 1) AS unmatched,
           round(avg(abs(y - p)) FILTER (m = 1), 6) AS mae
    FROM ({NAIVE_EVAL_SQL}) GROUP BY target""")
def j11_unmatched_forecasts(spark, sf_dir):
    """Forecasts joined with the truths that count (m = 1) on (window, step, target); forecasts
    without such a truth are reported instead of dropped."""
    d = FC.naive_last_value(FC.with_origins(val_rows(spark, sf_dir), EVAL), EVAL.input_chunk_length)
    forecasts = FC.point_forecasts_long(d, EVAL.output_chunk_length).select("window_id", "h", "target", "value")
    truths = naive_eval(spark, sf_dir).filter("m = 1").select("window_id", "h", "target", "y")
    matched, unmatched = M.join_forecasts(forecasts, truths)
    both = (matched.select("target", F.lit(1).alias("hit"), F.abs(F.col("y") - F.col("value")).alias("e"))
            .unionByName(unmatched.select("target", F.lit(0).alias("hit"), F.lit(None).cast("double").alias("e"))))
    return both.groupBy("target").agg(F.count_if(F.col("hit") == 1).alias("matched"), F.count_if(F.col("hit") == 0).alias("unmatched"),
                                      F.round(F.avg("e"), 6).alias("mae"))
