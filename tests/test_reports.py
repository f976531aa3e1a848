"""Report operators on small inline tables (FIXTURES FX4)."""

import math

from pyspark.sql import functions as F

from quarterline.operators import reports as RP
from quarterline.schema import EPOCH_LOSS, STRATEGY_RESULT, TRIAL


def test_best_strategy_published_rows(spark):
    rows = [("Trading-Only", 0.385, 21, 17.396, False, True), ("Stratified", 0.561, 13, 8.998, True, True),
            ("Boundary-Aware", 0.400, 21, 18.764, False, True), ("Hybrid", 0.547, 17, 11.028, True, True)]
    r = RP.best_strategy(spark.createDataFrame(rows, STRATEGY_RESULT)).first()
    assert r.best_strategy == "Stratified" and r.best_val_loss == 8.998


def trials(spark):
    rows = [("s", 0, "COMPLETE", 9.0, 10.0, 1e-4, 32, 96), ("s", 1, "COMPLETE", 8.5, 12.0, 1e-4, 32, 192),
            ("s", 2, "COMPLETE", 8.5, 11.0, 3e-4, 64, 384), ("s", 3, "COMPLETE", 8.5, 9.0, 3e-4, 16, 96),
            ("s", 4, "PRUNED", None, 3.0, 1e-5, 16, 96), ("s", 5, "FAIL", float("nan"), 1.0, 3e-5, 64, 96),
            ("s", 6, "COMPLETE", 10.0, 8.0, 1e-5, 64, 96)]
    return spark.createDataFrame(rows, TRIAL)


def test_study_stats_and_ties(spark):
    t = trials(spark)
    s = RP.study_stats(t).first()
    assert (s.n_trials, s.n_complete, s.n_pruned, s.n_failed) == (7, 5, 1, 1)
    assert s.best_value == 8.5 and s.best_trial == 1
    assert math.isclose(s.total_duration_s, 54.0)
    best = RP.best_trial(t).first()
    assert best.trial == 3  # tie on 8.5: largest lr (3e-4), then smallest context (96)
    top = RP.top_trials(t).orderBy("rank").collect()
    assert [r.trial for r in top] == [1, 2, 3, 0, 6]


def test_epoch_history_and_stages(spark):
    rows = [("zero", 0, "val", 2.0), ("s1", 0, "train", 1.0), ("s1", 0, "train", 3.0), ("s1", 0, "val", 1.5),
            ("s1", 1, "train", 0.5), ("s2", 0, "train", 0.4)]
    h = RP.epoch_history(spark.createDataFrame(rows, EPOCH_LOSS))
    d = {(r.stage, r.epoch): r for r in h.collect()}
    assert d[("s1", 0)].train_loss == 2.0 and d[("s1", 0)].val_loss == 1.5
    b = RP.stage_boundaries(h, ["zero", "s1", "s2"]).orderBy("global_epoch").collect()
    assert [r.stage for r in b] == ["zero", "s1", "s1", "s2"]
    assert [r.stage_start for r in b] == [True, True, False, True]
