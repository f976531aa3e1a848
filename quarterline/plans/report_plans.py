"""Plans for experiment reports: strategy experiment (A17, P5/X1), lookback study
and study summaries (A18, K4, K6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import metrics as M
from ..operators import reports as RP
from ..operators.rolling import score_contexts, smape_of
from ..operators.sampling import apply_strategy
from ..schema import TARGETS, WindowParams
from . import oracle as O
from .catalog import register
from .model_plans import EVAL, LEVELS, VAL_ROWS_SQL, val_rows
from .segment_plans import TRADED_1H, traded_panel

STRATEGY_NAMES = ["Trading-Only", "Stratified", "Boundary-Aware", "Hybrid"]


def strategy_scores(spark, sf_dir) -> DataFrame:
    """Each strategy applied to the validation rows (as the reference does), then the naive
    forecaster scored on the windows of the filtered rows."""
    v = val_rows(spark, sf_dir)
    parts = []
    for name in STRATEGY_NAMES:
        rows = apply_strategy(v, name)
        d = FC.naive_last_value(FC.with_origins(rows, EVAL), EVAL.input_chunk_length)
        ev = FC.evaluation_frame(d, EVAL, flat={t: F.col(f"f_{t}") for t in TARGETS})
        parts.append(ev.agg(M.masked_smape_col().alias("val_loss"),
                            F.count_distinct("window_id").alias("n_windows"))
                     .withColumn("strategy", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def _strategy_sql(name: str) -> str:
    rows = O.strategy_rows_sql(VAL_ROWS_SQL, name)
    ev = O.eval_sql(rows, 24, 10, "naive")
    return (f"SELECT '{name}' AS strategy, {O.smape_agg_sql()} AS val_loss, count(DISTINCT window_id) AS n_windows "
            f"FROM ({ev})")


STRATEGY_SQL = " UNION ALL ".join(_strategy_sql(n) for n in STRATEGY_NAMES)


@register("x01_strategy_experiment", f"""
    SELECT strategy, round(val_loss, 6) AS val_loss, n_windows, n_windows > 0 AS success FROM ({STRATEGY_SQL})""")
def x01_strategy_experiment(spark, sf_dir):
    """P5/X1 experiment: the four strategies by name on validation rows, scored by naive-forecast sMAPE."""
    s = strategy_scores(spark, sf_dir)
    return s.select("strategy", F.round("val_loss", 6).alias("val_loss"), "n_windows",
                    (F.col("n_windows") > 0).alias("success"))


@register("a17_best_strategy", f"""
    SELECT arg_min(strategy, val_loss) AS best_strategy, round(min(val_loss), 6) AS best_val_loss,
           count(*) AS n_successful
    FROM ({STRATEGY_SQL}) WHERE n_windows > 0""")
def a17_best_strategy(spark, sf_dir):
    """Arg-min validation loss among successful strategies."""
    r = RP.best_strategy(RP.strategy_results(strategy_scores(spark, sf_dir)))
    return r.withColumn("best_val_loss", F.round("best_val_loss", 6))


LOOKBACKS = (24, 96, 288)
FORECASTERS = ("naive", "quantile_median")


def lookback_trials(spark, sf_dir) -> DataFrame:
    """Study over context length x forecaster on the whole hourly panel, all trials in one pass; each
    trial's value is the element-weighted masked sMAPE; a trial without windows FAILs with NaN."""
    scores = smape_of(score_contexts(traded_panel(spark, sf_dir), LOOKBACKS, LEVELS), ["forecaster", "max_context_length"])
    grid = spark.createDataFrame([(k, L, fc) for k, (L, fc) in enumerate((L, fc) for L in LOOKBACKS for fc in FORECASTERS)],
                                 "trial int, max_context_length int, forecaster string")
    t = grid.join(scores, ["max_context_length", "forecaster"], "left")
    done = F.col("n").isNotNull()
    return t.select(F.lit("lookback").alias("study"), "trial", F.when(done, "COMPLETE").otherwise("FAIL").alias("state"),
                    F.when(done, F.round("smape", 6)).otherwise(F.lit(float("nan"))).alias("value"),
                    F.lit(None).cast("double").alias("duration_s"), F.lit(None).cast("double").alias("lr"),
                    F.lit(None).cast("int").alias("batch_size"), "max_context_length", "forecaster")


def _trials_sql() -> str:
    parts, trial = [], 0
    for L in LOOKBACKS:
        for fc in FORECASTERS:
            ev = O.eval_sql(TRADED_1H, L, 10, "naive" if fc == "naive" else "quantile", LEVELS)
            parts.append(f"""SELECT 'lookback' AS study, {trial} AS trial,
                CASE WHEN count(*) > 0 THEN 'COMPLETE' ELSE 'FAIL' END AS state,
                CASE WHEN count(*) > 0 THEN round({O.smape_agg_sql()}, 6) ELSE 'nan'::DOUBLE END AS value,
                NULL::DOUBLE AS duration_s, NULL::DOUBLE AS lr, NULL::INTEGER AS batch_size,
                {L} AS max_context_length, '{fc}' AS forecaster FROM ({ev})""")
            trial += 1
    return " UNION ALL ".join(parts)


TRIALS_SQL = _trials_sql()


@register("r16_lookback_trials", f"SELECT study, trial, state, value, max_context_length, forecaster FROM ({TRIALS_SQL})")
def r16_lookback_trials(spark, sf_dir):
    """Lookback 24 / 96 / 288 x {naive, quantile median} as a trials table (A7 schema)."""
    return lookback_trials(spark, sf_dir).select("study", "trial", "state", "value", "max_context_length",
                                                 "forecaster")


@register("a18_study_stats", f"""
    WITH t AS ({TRIALS_SQL})
    SELECT study, count(*) AS n_trials, count(*) FILTER (WHERE state = 'COMPLETE') AS n_complete,
           count(*) FILTER (WHERE state = 'PRUNED') AS n_pruned, count(*) FILTER (WHERE state = 'FAIL') AS n_failed,
           min(value) FILTER (WHERE state = 'COMPLETE') AS best_value,
           arg_min(trial, (value, trial)) FILTER (WHERE state = 'COMPLETE') AS best_trial,
           arg_min(max_context_length, (value, trial)) FILTER (WHERE state = 'COMPLETE') AS best_max_context_length
    FROM t GROUP BY study""")
def a18_study_stats(spark, sf_dir):
    """Trial counts by state and the best trial of the lookback study."""
    s = RP.study_stats(lookback_trials(spark, sf_dir))
    return s.select("study", "n_trials", "n_complete", "n_pruned", "n_failed", "best_value", "best_trial",
                    "best_max_context_length")


@register("k04_top_trials", f"""
    SELECT study, trial, value, max_context_length, forecaster, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY study ORDER BY value, trial) AS rank,
             count(*) OVER (PARTITION BY study) AS n
      FROM ({TRIALS_SQL}) WHERE state = 'COMPLETE') WHERE n >= 5 AND rank <= 5""")
def k04_top_trials(spark, sf_dir):
    """K4: five best completed trials (only when at least five completed)."""
    return RP.top_trials(lookback_trials(spark, sf_dir)).select(
        "study", "trial", "value", "max_context_length", "forecaster", "rank")


@register("k06_best_trial", f"""
    SELECT study, trial, value, max_context_length, forecaster FROM (
      SELECT *, row_number() OVER (PARTITION BY study ORDER BY value, lr DESC NULLS LAST,
                                   max_context_length ASC NULLS LAST, trial) AS r
      FROM ({TRIALS_SQL}) WHERE state = 'COMPLETE') WHERE r = 1""")
def k06_best_trial(spark, sf_dir):
    """K6: best trial; ties go to the larger learning rate, then the shorter context."""
    return RP.best_trial(lookback_trials(spark, sf_dir)).select(
        "study", "trial", "value", "max_context_length", "forecaster")
