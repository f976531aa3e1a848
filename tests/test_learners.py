"""Learners from normal equations against least squares, seasonal blocks, one-pass reports."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from panel_helpers import panel_df
from pyspark.sql import functions as F

from quarterline.operators.linear import bag_weight, direct_inputs, direct_table, normal_sums, predicted, solve_ridge
from quarterline.operators.split import seasonal_blocks
from quarterline.sources.panel_io import subsample_report, write_subsampled

T0 = datetime(2024, 1, 1)


def test_ridge_equals_least_squares_per_group_and_weight(spark):
    r = np.random.default_rng(1)
    rows = [(k % 3, float(a), float(b), float(2 * a - b + k % 3 + e), float(w)) for k, (a, b, e, w) in
            enumerate(zip(r.normal(size=300), r.normal(3, 2, size=300), r.normal(0, 0.1, 300), r.integers(0, 3, 300)))]
    df = spark.createDataFrame(rows, "g int, a double, b double, y double, m double").repartition(4)
    broken = df.unionByName(spark.createDataFrame([(0, None, 1.0, 1.0, 1.0), (1, 1.0, 1.0, None, 1.0)], df.schema))
    coefs = solve_ridge(normal_sums(broken, ["g"], ["a", "b"]), ["g"], 2, penalty=5.0)
    got = {c.g: c.coef for c in coefs.collect()}
    for g in range(3):
        x = np.array([(1, a, b) for k, a, b, y, w in rows if k == g])
        y, w = (np.array([row[i] for row in rows if row[0] == g]) for i in (3, 4))
        want = np.linalg.solve((x * w[:, None]).T @ x + np.diag([0, 5.0, 5.0]), (x * w[:, None]).T @ y)
        assert got[g] == pytest.approx(want.tolist(), abs=1e-9)
    p = predicted(df, coefs, ["g"], ["a", "b"]).first()
    assert p.p == pytest.approx(got[p.g][0] + got[p.g][1] * p.a + got[p.g][2] * p.b)


def test_bag_weights_are_spread_like_a_bootstrap(spark):
    w = spark.range(4000).select(bag_weight(F.lit(827), "id").alias("w")).groupBy("w").count().collect()
    share = {r.w: r["count"] / 4000 for r in w}
    assert [share[k] for k in (0.0, 1.0, 2.0, 3.0)] == pytest.approx([6 / 16, 6 / 16, 3 / 16, 1 / 16], abs=0.03)


def test_direct_table_rows(spark):
    rows = [("Mon00Q1", T0 + timedelta(hours=k), float(k), float(k) + 0.5, float(10 * k), float(k % 2)) for k in range(12)]
    p = panel_df(spark, rows).withColumns({"is_trading": (F.col("volume") > 0).cast("int"), "idx": F.lit(2).cast("long"),
                                           **{f"mean_{t}": F.lit(7.0) for t in ("high", "low", "close", "volume")}})
    t = direct_table(p, lags=3, horizon=2, context=4, extra=["mean"])
    assert t.count() == (12 - 4 - 2 + 1) * 2 * 4
    r = t.filter("target = 'close' AND start_pos = 1 AND h = 2").first()
    assert (r.lag_1, r.lag_2, r.lag_3, r.y, r.m, r.window_id, r.target_ts) == (40.0, 30.0, 20.0, 60.0, 0.0, 2 * 2**32 + 1, T0 + timedelta(hours=6))
    assert set(direct_inputs(3, ["mean"])) <= set(t.columns) and r.x_mean == 7.0
    assert direct_table(p.limit(0), extra=["mean"]).count() == 0


def test_seasonal_blocks_are_whole_and_of_one_season(spark):
    rows = [(a, datetime(2020, 1, 1) + timedelta(days=k), 1.0, 1.0, 1.0, 1.0) for a in ("Mon00Q1", "Mon01Q1") for k in range(800)
            if not (a == "Mon01Q1" and 100 < k < 140)]
    got = seasonal_blocks(panel_df(spark, rows), 28, 2).groupBy("asset", "season", "block").agg(
        F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).collect()
    assert all(r.n == 28 and (r.b - r.a).days == 27 and r.a.month % 12 // 3 == r.b.month % 12 // 3 for r in got)
    per = {}
    for r in got:
        per.setdefault((r.asset, r.season), []).append(r.block)
    assert len(per) == 8 and all(1 <= len(b) <= 2 for b in per.values()) and any(len(b) == 2 for b in per.values())


def test_report_names_skipped_contracts_of_each_split(spark, tmp_path):
    rows = [(a, T0 + timedelta(hours=k), v, v, v, v) for a, v in (("Mon00Q1", 1.0), ("Mon01Q1", 0.0), ("Mon02Q1", 0.0)) for k in range(6)]
    p = panel_df(spark, rows).withColumns({"split": F.when(F.hour("ts") < 3, "train").otherwise("val"),
                                           "is_trading": (F.col("volume") > 0).cast("int")})
    p = p.withColumn("is_trading", F.when((F.col("asset") == "Mon01Q1") & (F.col("split") == "val"), 1).otherwise(F.col("is_trading")))
    got = sorted(map(tuple, subsample_report(p, *write_subsampled(p, str(tmp_path / "o"), "Trading-Only")).collect()))
    assert got == [("train", 1, 3, "Mon01Q1,Mon02Q1"), ("val", 2, 6, "Mon02Q1")]
