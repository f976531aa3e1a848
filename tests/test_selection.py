"""Exact samples and percentiles by histograms, against whole windows and sorted values."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from panel_helpers import panel_df
from pyspark.sql import functions as F

from quarterline.operators import sampling as S
from quarterline.operators import selection
from quarterline.operators.profile import describe
from quarterline.operators.selection import describe_refined, kth_values

T0 = datetime(2024, 1, 1)


def panel(spark, seed=1):
    """One contract holds most rows; another has a single row, another none that is not trading."""
    r = random.Random(seed)
    rows = []
    for name, n, share in (("Mon00Q1", 900, 0.3), ("Mon01Q1", 120, 0.5), ("Tue02Q3", 1, 0.0), ("Wed03Q2", 15, 1.0), ("Thu04Q4", 40, 0.0)):
        for k in range(n):
            on = float(r.random() < share)
            rows.append((name, T0 + timedelta(minutes=15 * k), on * r.choice([1.0, 7.5, 1e6]), on, on * r.gauss(5, 3), on))
    return panel_df(spark, rows).withColumn("is_trading", (F.col("volume") > 0).cast("int")).withColumn(
        "split", F.when(F.col("ts") < "2024-01-05", "train").otherwise("val"))


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.37, 1.0])
def test_the_same_rows_as_by_ranking_whole_contracts(spark, fraction, monkeypatch):
    monkeypatch.setattr(selection, "DIGITS", 1)  # few buckets: the last one holds many rows to rank
    p = panel(spark)
    assert rows_of(S.stratified(p, fraction, chunk_seconds=3600)) == rows_of(S.stratified(p, fraction))
    assert rows_of(S.hybrid(p, fraction, chunk_seconds=3600)) == rows_of(S.hybrid(p, fraction))
    keys = ("split", "asset")
    assert rows_of(S.stratified(p, fraction, keys=keys, chunk_seconds=3600)) == rows_of(S.stratified(p, fraction, keys=keys))


def test_sizes_are_exact_with_repeated_rows(spark):
    p = panel(spark).drop("split")
    twice = p.unionByName(p.filter("asset = 'Mon00Q1'"))
    got = dict(S.stratified(twice, 0.1, chunk_seconds=3600).filter("is_trading = 0").groupBy("asset").count().collect())
    want = {r.asset: int(0.1 * r.n) for r in twice.filter("is_trading = 0").groupBy("asset").agg(F.count("*").alias("n")).collect()}
    assert got == {a: n for a, n in want.items() if n}


@pytest.mark.parametrize("limit, buckets", [(1000, 1024), (3, 4)])
def test_percentiles_equal_sorted_values(spark, limit, buckets, monkeypatch):
    monkeypatch.setattr(selection, "SORTED_VALUES", limit)
    monkeypatch.setattr(selection, "VALUE_BUCKETS", buckets)
    p = panel(spark, 2).select("asset", "high", "low", "close", "volume")
    got = {(r.asset, r.column_name): r for r in describe_refined(p).collect()}
    want = {(r.asset, r.column_name): r for r in describe(p).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max"):
            assert (got[k][c] is None and w[c] is None) or got[k][c] == pytest.approx(w[c], rel=1e-12, abs=1e-12), (k, c)


def test_missing_values_and_hard_ranges(spark, monkeypatch):
    monkeypatch.setattr(selection, "SORTED_VALUES", 2)
    values = [None, float("nan"), float("inf"), -1.7e308, 1.7e308, 0.0, -0.0, 5e-324, 1e-300, 1.0, 1.0, 1.0, 2.0, float(np.nextafter(1.0, 2.0))]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "asset string, x double")
    got = {r.asset: r for r in describe_refined(df, ["x"]).collect()}
    finite = np.sort([v for v in values if v is not None and np.isfinite(v)])
    assert got["a"]["count"] == len(finite) and got["b"]["count"] == 0 and got["b"].p50 is None
    ranks = spark.createDataFrame([("a", k, float(finite[0]), float(finite[-1])) for k in range(len(finite))], "asset string, rank long, lo double, hi double")
    found = dict(kth_values(df.filter("asset = 'a' and abs(x) < 1.75e308"), ["asset"], ranks).select("rank", "value").collect())
    assert [found[k] for k in range(len(finite))] == finite.tolist()
    assert describe_refined(df.limit(0), ["x"]).count() == 0


def test_no_window_by_contract_alone(spark):
    import re
    plan = S.stratified(panel(spark), 0.1, chunk_seconds=3600)._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert specs and all("_b2" in s for s in specs)
