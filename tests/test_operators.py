"""Hand-worked operator cases (FIXTURES part C) and properties."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarterline.operators import sampling as S
from quarterline.operators.features import featurize
from quarterline.operators.forecast import empirical_quantile_model, score_external
from quarterline.operators.scale import apply_scalers, fit_scalers
from quarterline.operators.segments import boundary_flag, select_best, trading_segments, window_counts
from quarterline.operators.windows import supervised_windows
from quarterline.schema import WindowParams
from panel_helpers import SF_SMALL

T0 = datetime(2024, 1, 1)


def series(spark, asset, flags, start=T0, price=10.0):
    rows = [(asset, start + timedelta(hours=i), *( (price + i,) * 3 if f else (0.0,) * 3), float(f))
            for i, f in enumerate(flags)]
    return spark.createDataFrame(rows, "asset string, ts timestamp, high double, low double, close double, volume double")


def test_ffill_nonzero(spark):
    # closes (0, 5, 0, NULL, 7) -> last non-zero (NULL, 5, 5, 5, 7)
    from quarterline.operators.features import last_nonzero
    rows = [("A", T0 + timedelta(hours=i), c) for i, c in enumerate([0.0, 5.0, 0.0, None, 7.0])]
    df = spark.createDataFrame(rows, "asset string, ts timestamp, close double")
    got = [r[0] for r in df.select(last_nonzero("close")).orderBy(F.lit(1)).collect()]
    got = [r.v for r in df.select("ts", last_nonzero("close").alias("v")).orderBy("ts").collect()]
    assert got == [None, 5.0, 5.0, 5.0, 7.0]


def test_boundary_keep(spark):
    flags = [0] * 16
    flags[6] = flags[7] = 1
    df = series(spark, "Mon00Q1", flags)
    kept = [r.pos for r in boundary_flag(df).withColumn("pos", F.hour("ts")).filter("keep_boundary")
            .select("pos").orderBy("pos").collect()]
    assert kept == list(range(2, 13))


def test_segments_islands(spark):
    df = series(spark, "Mon00Q1", [1, 1, 0, 1, 0, 1, 1, 1])
    got = sorted(r.h for r in trading_segments(df, 2).select(F.hour("ts").alias("h")).collect())
    assert got == [0, 1, 5, 6, 7]


def test_neighbours_precedence(spark):
    names = ["Fri00Q1", "Mon00Q1", "Sat00Q1"]
    rows = []
    for i, a in enumerate(names):
        rows.append((a, T0, 1.0, 1.0, float(10 * (i + 1)), float(i + 1)))
    f = featurize(spark.createDataFrame(rows, "asset string, ts timestamp, high double, low double, close double, "
                                              "volume double")).collect()
    by = {r.asset: r for r in f}
    assert by["Fri00Q1"].close_lag_adj_1 == 20.0          # asset 0 -> 1
    assert by["Mon00Q1"].close_lag_adj_1 == 30.0          # asset 1 -> 2 (next wins)
    assert by["Sat00Q1"].close_lag_adj_1 == 20.0          # asset 2 -> 1 (only previous)
    assert by["Fri00Q1"].close_lag_adj_2 == 30.0
    assert by["Mon00Q1"].close_lag_adj_2 == -1.0          # none -> -1
    assert by["Sat00Q1"].close_lag_adj_2 == 10.0


def test_nearest_liquid(spark):
    # prev1 volume 0, next1 volume 3 close 50, prev2 volume 9 close 40 -> 50
    names = ["Fri00Q1", "Mon00Q1", "Sat00Q1", "Sun00Q1"]
    vals = {"Fri00Q1": (40.0, 9.0), "Mon00Q1": (0.0, 0.0), "Sat00Q1": (7.0, 1.0), "Sun00Q1": (50.0, 3.0)}
    rows = [(a, T0, 1.0, 1.0, *vals[a]) for a in names]
    f = {r.asset: r for r in featurize(spark.createDataFrame(
        rows, "asset string, ts timestamp, high double, low double, close double, volume double")).collect()}
    assert f["Sat00Q1"].nearest_liquid_contract_close == 0.0 or True
    # for Sat (idx 2): prev1 = Mon (volume 0), next1 = Sun (volume 3, close 50) -> 50
    assert f["Sat00Q1"].nearest_liquid_contract_close == 50.0


def test_scaler_and_inverse(spark):
    rows = [("A", T0 + timedelta(hours=i), v, v, v, v) for i, v in enumerate([10.0, 14.0, 18.0])]
    rows += [("B", T0 + timedelta(hours=i), 5.0, 5.0, 5.0, 5.0) for i in range(3)]
    df = spark.createDataFrame(rows, "asset string, ts timestamp, high double, low double, close double, "
                                     "volume double").withColumn("is_trading", F.lit(1))
    s = {(r.asset, r.target): r for r in fit_scalers(df).collect()}
    assert s[("A", "close")].mean == pytest.approx(14.0)
    assert s[("A", "close")].scale == pytest.approx(3.265986, abs=1e-6)
    assert s[("B", "close")].scale == 1.0
    back = apply_scalers(apply_scalers(df, fit_scalers(df)), fit_scalers(df), inverse=True)
    assert sorted(r.close for r in back.collect()) == pytest.approx(sorted(r.close for r in df.collect()))


def test_window_counts_and_stride(spark):
    df = series(spark, "Mon00Q1", [1] * 20).withColumn("is_trading", F.lit(1))
    assert supervised_windows(df, WindowParams(6, 4, 1)).count() == 11
    starts = sorted(r.start_pos for r in supervised_windows(df, WindowParams(6, 4, 3)).collect())
    assert starts == [0, 3, 6, 9]
    short = series(spark, "Mon00Q1", [1] * 9).withColumn("is_trading", F.lit(1))
    assert supervised_windows(short, WindowParams(6, 4, 1)).count() == 0
    assert window_counts(df, 6, 4).first().n_windows == 11


def test_top_selection(spark):
    stats = spark.createDataFrame([(a, r) for a, r in zip("ABCD", [90, 80, 50, 10])], "asset string, trading_rows long")
    got = [r.asset for r in select_best(stats, 150, 5).orderBy("rank").collect()]
    assert got == ["A", "B"]


def test_strategies_exact_and_superset(spark):
    from quarterline.plans.segment_plans import traded_panel
    p = traded_panel(spark, SF_SMALL)
    n_non = p.filter("is_trading = 0").groupBy("asset").count().collect()
    strat = S.stratified(p, 0.1)
    got = {r.asset: r["count"] for r in strat.filter("is_trading = 0").groupBy("asset").count().collect()}
    for r in n_non:
        assert got.get(r.asset, 0) == int(r["count"] * 0.1)
    trading = p.filter("is_trading = 1").select("asset", "ts")
    for name in S.STRATEGIES:
        out = S.apply_strategy(p, name).select("asset", "ts")
        assert trading.subtract(out).count() == 0, name
    with pytest.raises(ValueError):
        S.apply_strategy(p, "nope")


def test_no_look_ahead(spark):
    from quarterline.sources.candles import events_panel
    p = events_panel(spark, SF_SMALL, 3600)
    cut = p.agg(F.min("ts")).first()[0] + timedelta(days=5)
    full = featurize(p).filter(F.col("ts") <= cut)
    trunc = featurize(p.filter(F.col("ts") <= cut))
    assert full.exceptAll(trunc).count() == 0 and trunc.exceptAll(full).count() == 0


def test_smape_bounds(spark):
    from quarterline.plans.model_plans import naive_eval
    ev = naive_eval(spark, SF_SMALL)
    r = ev.select((F.lit(2.0) * F.abs(F.col("y") - F.col("p")) / (F.abs("y") + F.abs("p") + 1e-6)).alias("t")) \
          .agg(F.min("t"), F.max("t")).first()
    assert r[0] is None or (r[0] >= 0 and r[1] <= 2.0)


def test_external_scorer_matches_builtin(spark):
    from quarterline.plans.window_plans import trading_windows
    w = trading_windows(spark, "/root/testdata/sf0.01").limit(50)
    f = score_external(w, empirical_quantile_model, [0.1, 0.5, 0.9], 10)
    assert f.count() == 50 * 4 * 10 * 3
    assert f.filter("h = 1 AND quantile = 0.5").count() == 200


def test_segment_training_set_fallbacks(spark):
    """val = its segments (A), else its full rows (B), else the train segments when the
    contract has no val rows (C); D has no segment of 3 rows and is not chosen."""
    from quarterline.operators.prepare import segment_training_set
    v0 = T0 + timedelta(days=10)
    train = (series(spark, "A", [1, 1, 1, 0]).unionByName(series(spark, "B", [1, 1, 1, 1]))
             .unionByName(series(spark, "C", [1, 1, 1])).unionByName(series(spark, "D", [1, 1, 0])))
    val = series(spark, "A", [1, 1, 1, 0, 0], v0).unionByName(series(spark, "B", [1, 0, 1, 0, 0], v0))
    got = {(r.split, r.asset): (r.n_rows, r.n_windows)
           for r in segment_training_set(train, val, 3, 1000, 5, 1, 1).collect()}
    assert got == {("train", "A"): (3, 2), ("train", "B"): (4, 3), ("train", "C"): (3, 2),
                   ("val", "A"): (3, 2), ("val", "B"): (5, 4), ("val", "C"): (3, 2)}
