"""Sorted windows and one-pass scores against sorting every context and against the long evaluation frame."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from panel_helpers import panel_df
from pyspark.sql import functions as F

from quarterline.operators import forecast as FC
from quarterline.operators import metrics as M
from quarterline.operators.rolling import rolling_context, score_contexts, smape_of, window_types, with_places
from quarterline.schema import TARGETS, WindowParams

T0 = datetime(2024, 1, 1)
LEVELS = [0.1, 0.5, 0.9]


def panel(spark, sizes=(("Mon00Q1", 260), ("Mon01Q1", 40), ("Mon02Q1", 13), ("Mon03Q1", 3)), seed=1):
    r = random.Random(seed)
    value = lambda: r.choice([0.0, 0.0, 1.0, 2.5, r.gauss(3, 2)])
    rows = [(a, T0 + timedelta(minutes=15 * k), value(), value(), value(), r.choice([0.0, 1.0, 4.0])) for a, n in sizes for k in range(n)]
    r.shuffle(rows)
    return panel_df(spark, rows).withColumn("is_trading", (F.col("volume") > 0).cast("int"))


def test_sorted_window_equals_numpy():
    SortedWindow, LastNonZero = window_types()
    r = random.Random(2)
    values = [r.choice([None, float("nan"), 0.0, -0.0, 1.0, 1.0, r.gauss(0, 1)]) for _ in range(500)]
    for length in (1, 2, 7, 100):
        w, last = SortedWindow(length), LastNonZero(length)
        for k, v in enumerate(values):
            w.push(v)
            last.push(v if v == v else None)
            have = [x for x in values[max(0, k - length + 1):k + 1] if x is not None and x == x]
            for q in (0.0, 0.1, 0.5, 0.77, 1.0):
                assert w.quantile(q) is None if not have else w.quantile(q) == pytest.approx(np.quantile(have, q), abs=1e-12)
            assert last.get() == next((x for x in reversed(have) if x != 0), 0.0)


@pytest.mark.parametrize("chunk_rows", [1, 16, 4096])
def test_contexts_equal_the_sorted_arrays(spark, chunk_rows):
    p = with_places(panel(spark))
    got = rolling_context(p, [5, 24], LEVELS, horizon=3, chunk_rows=chunk_rows)
    for n in (5, 24):
        want = FC.naive_last_value(FC.quantile_context(p, n, LEVELS), n)
        both = got.alias("g").join(want.alias("w"), ["asset", "ts"])
        assert both.count() == p.count() == got.count()
        off = [F.greatest(*[F.abs(F.col(f"g.q{n}_{t}")[i] - F.col(f"w.q_{t}")[i]) for i in range(3)],
                          F.abs(F.col(f"g.f{n}_{t}") - F.col(f"w.f_{t}"))) for t in TARGETS]
        assert both.agg(F.max(F.greatest(*off))).first()[0] < 1e-12
    rest = got.select("pos", "n_rows", F.size("next").alias("k"), F.get("next", F.lit(0))["ts"].alias("t"), "ts").collect()
    assert all(r.k == min(3, r.n_rows - 1 - r.pos) and (r.k == 0 or r.t == r.ts + timedelta(minutes=15)) for r in rest)


@pytest.mark.parametrize("chunk_seconds", [None, 3600])
def test_scores_equal_the_evaluation_frame(spark, chunk_seconds):
    p = panel(spark)
    scores = score_contexts(p, [5, 24], LEVELS, 10, chunk_seconds=chunk_seconds, chunk_rows=32)
    got = {(r.forecaster, r.max_context_length, r.target): (r.smape, r.n) for r in
           smape_of(scores, ["forecaster", "max_context_length", "target"]).collect()}
    for n in (5, 24):
        w = WindowParams(input_chunk_length=n, output_chunk_length=10)
        base = FC.with_origins(p, w)
        frames = {"naive": FC.evaluation_frame(FC.naive_last_value(base, n), w, flat={t: F.col(f"f_{t}") for t in TARGETS}),
                  "quantile_median": FC.evaluation_frame(FC.quantile_context(base, n, LEVELS), w,
                                                         flat={t: F.element_at(F.col(f"q_{t}"), 2) for t in TARGETS})}
        for name, ev in frames.items():
            for r in M.smape(ev, ["target"]).collect():
                assert got[name, n, r.target][0] == pytest.approx(r.smape, abs=1e-12)
            assert got[name, n, "close"][1] == ev.filter("target = 'close' and h = 1").count()
    assert len(got) == 16


def test_no_window_without_origins(spark):
    p = panel(spark, (("Mon00Q1", 12), ("Mon01Q1", 1)))
    assert score_contexts(p, [5], LEVELS, 10).count() == 0
    assert score_contexts(p.limit(0), [5], LEVELS, 10).count() == 0
