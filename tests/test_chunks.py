"""Chunked scans against the whole windows, on panels where one contract holds a third of the rows and more."""

import random
from datetime import datetime, timedelta

import pytest
from panel_helpers import panel_df

from quarterline.operators import chunks as C
from quarterline.operators.prepare import fill_series, reclock_by
from quarterline.operators.segments import boundary_flag, with_position, with_segments

T0 = datetime(2024, 1, 1)


def sparse_panel(spark, seed, runs=(1, 2, 3, 30)):
    """Uneven contracts with gaps in time, long runs of trading and of silence, empty chunks, NULLs and NaN."""
    r = random.Random(seed)
    rows = []
    for name, n in (("Mon00Q1", 300), ("Mon01Q1", 150), ("Tue02Q3", 60), ("Wed03Q2", 1), ("Thu00Q1", 9), ("Fri00Q1", 40)):
        t, on, left = 0, r.random() < 0.5, 0
        for _ in range(n):
            if left == 0:
                on, left = not on, r.choice(runs)
            left -= 1
            t += r.choice([1, 1, 1, 2, 40])
            v = r.choice([None, float("nan"), 1.5, 2.5]) if name != "Fri00Q1" else None
            rows.append((name, T0 + timedelta(minutes=15 * t), v, r.choice([None, 3.0, float("inf")]), 4.0, 1.0 if on else r.choice([0.0, None])))
    r.shuffle(rows)
    return panel_df(spark, rows)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    rows = lambda d: sorted(map(str, (tuple(r) for r in d.select(*cols).collect())))
    assert rows(a) == rows(b)


@pytest.mark.parametrize("seed, chunk", [(1, 3600), (2, 900), (3, 6 * 3600), (4, 10**9)])
def test_scans_equal_the_whole_window(spark, seed, chunk):
    p = sparse_panel(spark, seed)
    same(C.with_segments_chunked(p, chunk_seconds=chunk), with_segments(p))
    same(C.boundary_flag_chunked(p, 4, 4, chunk_seconds=chunk), boundary_flag(p, 4, 4))
    same(C.boundary_flag_chunked(p, 1, 7, chunk_seconds=chunk), boundary_flag(p, 1, 7))
    same(C.with_position_chunked(p, chunk_seconds=chunk), with_position(p))
    same(C.reclock_chunked(p, "2020-01-01 00:00:00", chunk_seconds=chunk), reclock_by(p, "2020-01-01 00:00:00", 15))
    same(C.fill_series_chunked(p, ["high", "low", "close"], chunk_seconds=chunk), fill_series(p, ["high", "low", "close"]))


def test_runs_across_many_chunks_and_two_keys(spark):
    from pyspark.sql import functions as F
    p = sparse_panel(spark, 5, runs=(60, 100)).withColumn("split", F.when(F.col("ts") < "2024-01-10", "train").otherwise("val"))
    keys = ("split", "asset")
    same(C.with_segments_chunked(p, keys, 1800), with_segments(p, keys))
    same(C.boundary_flag_chunked(p, 20, 20, keys, 1800), boundary_flag(p, 20, 20, keys))
    same(C.fill_series_chunked(p, ["high"], keys, 1800), fill_series(p, ["high"], keys))


def test_empty_panel(spark):
    p = panel_df(spark, [])
    assert C.with_segments_chunked(p).count() == C.boundary_flag_chunked(p).count() == C.fill_series_chunked(p, ["high"]).count() == 0


def test_no_window_by_contract_alone(spark):
    import re
    p = sparse_panel(spark, 6)
    for d in (C.with_segments_chunked(p), C.boundary_flag_chunked(p), C.with_position_chunked(p), C.fill_series_chunked(p, ["high"])):
        plan = d._jdf.queryExecution().executedPlan().toString()
        specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
        assert specs and all("_chunk" in s for s in specs)
