"""Hand-worked cases (FIXTURES part C) for the column functions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarterline.functions.calendar import calendar_columns, daylight_indicator, minute_of_day
from quarterline.functions.cleaning import loss_for_ranking, non_finite_to_null
from quarterline.functions.contracts import contract_name_for_int, parse_contract, time_to_delivery
from quarterline.functions.metrics import masked_smape


def test_parse_contract(spark):
    df = spark.createDataFrame([("Tue11Q4",), ("Mon00Q1",), ("Xyz11Q1",), ("Sun23Q5",)], "asset string")
    got = {r.asset: (tuple(r.p) if r.p else None) for r in df.select("asset", parse_contract("asset").alias("p")).collect()}
    assert got["Tue11Q4"] == (1, 11, 45)
    assert got["Mon00Q1"] == (0, 0, 0)
    assert got["Xyz11Q1"] is None
    assert got["Sun23Q5"] is None


@pytest.mark.parametrize("ts,hours", [
    ("2023-01-03 11:44:00", 1 / 60), ("2023-01-03 11:45:00", 168.0), ("2023-01-02 09:00:00", 26.75)])
def test_time_to_delivery(spark, ts, hours):
    df = spark.createDataFrame([(datetime.fromisoformat(ts),)], "ts timestamp")
    v = df.select(time_to_delivery("ts", F.lit(1), F.lit(11), F.lit(45)).alias("h")).first().h
    assert v == pytest.approx(hours, abs=1e-9)


def test_calendar_sunday(spark):
    df = spark.createDataFrame([(datetime(2023, 1, 1, 13, 30),)], "ts timestamp")
    r = df.select(*[c.alias(n) for n, c in calendar_columns("ts").items()],
                  minute_of_day("ts").alias("mod"), daylight_indicator("ts").alias("day")).first()
    assert (r.day_of_week, r.week_of_year, r.is_weekend, r.hour_of_day, r.month) == (6, 52, 1, 13, 1)
    assert r.mod == 13 * 60 + 30 and r.day == 1


def test_fixture_names(spark):
    names = spark.range(672).select(contract_name_for_int("id").alias("n")).distinct().count()
    assert names == 672
    first24 = {r.n for r in spark.range(24).select(contract_name_for_int("id").alias("n")).collect()}
    assert {n[:3] for n in first24} == {"Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"}
    assert {n[-1] for n in first24} == {"1", "2", "3", "4"}


def test_masked_smape(spark):
    rows = [(10.0, 8.0, 1.0), (0.0, 5.0, 0.0), (4.0, 4.0, 1.0), (0.0, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "y double, p double, m double")
    assert df.agg(masked_smape("y", "p", "m")).first()[0] == pytest.approx(0.740741, abs=1e-6)
    zero = spark.createDataFrame([(1.0, 2.0, 0.0)], "y double, p double, m double")
    assert zero.agg(masked_smape("y", "p", "m")).first()[0] == 0.0


def test_non_finite_and_ranking(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,), (None,)], "x double")
    got = [r[0] for r in df.select(non_finite_to_null("x")).collect()]
    assert got == [None, None, 1.5, None]
    ranks = [r[0] for r in df.select(loss_for_ranking("x")).collect()]
    assert ranks == [float("inf"), float("inf"), 1.5, float("inf")]


def test_time_seq_key_orders_like_struct(spark):
    """The packed DECIMAL key sorts exactly like struct(ts, seq), extremes and NULL seq included."""
    from quarterline.functions.ordering import time_seq_key
    big, small = 2 ** 63 - 1, -(2 ** 63)
    lo, hi, t = "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999", "2024-01-05 10:00:00.000001"
    rows = [(lo, small), (lo, None), (lo, big), ("1969-12-31 23:59:59.999999", 0), ("1970-01-01 00:00:00", small),
            (t, -1), (t, 0), (t, 1), ("2024-01-05 10:00:00.000002", None), (hi, big), (hi, small)]
    df = (spark.createDataFrame([(i, t_, s) for i, (t_, s) in enumerate(rows)], "i int, t string, seq long")
          .select("i", F.to_timestamp("t").alias("ts"), "seq"))
    by_struct = [r.i for r in df.orderBy(F.struct("ts", "seq")).select("i").collect()]
    by_key = [r.i for r in df.orderBy(time_seq_key("ts", "seq")).select("i").collect()]
    assert by_key == by_struct
    plan = df.groupBy(F.lit(1)).agg(F.max_by("i", time_seq_key("ts", "seq")))._jdf.queryExecution() \
             .executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_alias_and_mask_default(spark):
    """first present of the candidate names wins; F23: a missing mask is all ones."""
    from quarterline.functions.cleaning import mask_or_ones, resolve_alias
    df = spark.createDataFrame([(1.0, 2.0, None)], "past double, y double, mask double")
    r = resolve_alias(resolve_alias(df, ["past_target", "past", "x"], "context"), ["future_target", "y"], "target")
    assert set(r.columns) == {"context", "target", "mask"}
    with pytest.raises(KeyError):
        resolve_alias(df, ["nope"], "context")
    assert r.select(mask_or_ones(r).alias("m")).first().m == 1.0          # NULL mask -> 1
    assert df.drop("mask").select(mask_or_ones(df.drop("mask")).alias("m")).first().m == 1.0
