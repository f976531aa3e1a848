"""Inputs that the plans' fixtures do not hold: sparse and damaged tables, shuffled columns, late files."""

import os
from datetime import datetime, timedelta

import pytest
from panel_helpers import panel_df
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarterline.functions.joins import join_small
from quarterline.operators.prepare import fill_series
from quarterline.operators.profile import cross_asset_correlation
from quarterline.operators.segments import trading_segments
from quarterline.sources.csv_ingest import existing_assets, ingest_csv, read_panel, read_raw_csv, skipped_files
from quarterline.streaming.candles import latest_candles, stream_event_candles
from quarterline.streaming.ingest import stream_ingest_csv

T0 = datetime(2024, 1, 1)
NAMES = ["Mon00Q1", "Mon01Q1", "Mon02Q1", "Mon03Q1", "Mon04Q1", "Mon05Q1", "Mon06Q1", "Mon07Q1", "Mon08Q1", "Tue00Q1"]


def series(name, values):
    return [(name, T0 + timedelta(hours=k), 1.0, 1.0, v, 1.0) for k, v in enumerate(values) if v is not None]


@pytest.mark.parametrize("n, block", [(2, 256), (8, 3), (9, 1), (10, 256), (10, 4)])
def test_correlation_does_not_depend_on_the_number_of_contracts(spark, n, block):
    import pandas as pd
    base = [1.0, 4.0, 2.0, 8.0, 5.0, 7.0, 3.0, 6.0, 9.0, 2.5, 4.5, 1.5]
    gaps = [None if k in (1, 4, 7) else v * 2 + k % 3 for k, v in enumerate(base)]
    rows = series(NAMES[0], base) + series(NAMES[1], gaps)
    for k, name in enumerate(NAMES[2:n]):
        rows += series(name, [5.0] * 12 if k == 0 else [v * (k + 1) - j for j, v in enumerate(base[::-1])])
    got = {(r.asset_a, r.asset_b): r.corr for r in cross_asset_correlation(panel_df(spark, rows), block=block).collect()}
    wide = pd.DataFrame(rows).pivot(index=1, columns=0, values=4).corr()
    assert len(got) == n * (n - 1) // 2
    for (a, b), c in got.items():
        want = wide.loc[a, b]
        assert (c is None and want != want) or c == pytest.approx(want, abs=1e-9)


def test_correlation_of_five_thousand_contracts(spark):
    """Far more names than a block holds: the state of a task stays one block of pairs."""
    import numpy as np
    n, slots = 5000, 6
    x = np.round(np.random.default_rng(3).normal(size=(slots, n)), 6)
    d = spark.range(n * slots).select(F.format_string("c%05d", (F.col("id") % n).cast("int")).alias("asset"),
                                      F.timestamp_seconds(F.floor(F.col("id") / n) * 900).alias("ts"), F.col("id"))
    values = spark.createDataFrame([(int(k), float(v)) for k, v in enumerate(x.ravel())], "id long, close double")
    corr = cross_asset_correlation(d.join(values, "id"))
    few = ["c00000", "c00255", "c00256", "c02600", "c04999"]
    got = {(r.asset_a, r.asset_b): r.corr for r in corr.filter(F.col("asset_a").isin(few) & F.col("asset_b").isin(few)).collect()}
    want = np.corrcoef(x[:, [int(c[1:]) for c in few]].T)
    assert len(got) == 10
    for i, a in enumerate(few):
        for j in range(i + 1, 5):
            assert got[a, few[j]] == pytest.approx(want[i, j], abs=1e-9)


def test_correlation_by_position_and_empty(spark):
    rows = series(NAMES[0], [1.0, None, 2.0, 4.0]) + series(NAMES[1], [2.0, 4.0, 8.0])
    got = cross_asset_correlation(panel_df(spark, rows), align="position").collect()
    assert [r.corr for r in got] == [pytest.approx(1.0)]
    assert cross_asset_correlation(panel_df(spark, [])).count() == 0


@pytest.mark.parametrize("single", [False, True])
def test_stream_of_files_in_mixed_order_of_time_equals_batch(spark, tmp_path, single):
    from quarterline.sources.candles import candles
    from quarterline.functions.contracts import contract_name_for_int
    rows = [(k, T0 + timedelta(minutes=7 * k), k % 5, "x", float(k % 13)) for k in range(1000)]
    path = str(tmp_path / "events.parquet")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    parts = [rows] if single else [rows[750:], rows[:250], rows[500:750], rows[250:500]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    if single:
        path = next(f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet"))
    late = stream_event_candles(spark, path, str(tmp_path / "out"), str(tmp_path / "ck"), n_contracts=24)
    got = latest_candles(spark.read.parquet(str(tmp_path / "out")))
    ticks = spark.createDataFrame(rows, schema).withColumn("asset", contract_name_for_int(F.pmod("user_id", F.lit(24))))
    want = candles(ticks, "asset", "ts", "value", ["event_id"], 900)
    cols = ["asset", "ts", "high", "low", "close", "volume"]
    assert late == 0 and sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert got.agg(F.sum("volume")).first()[0] == 1000


def csv_folder(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,ExecutionTime,high,low,close,volume\nMon00Q1,2024-01-01T00:00:00Z,4,2,3,9\n"
                                  ",2024-01-01T00:00:00Z,1,1,1,1\nMon00Q1,not a time,1,1,1,1\n")
    (folder / "b.csv").write_text("volume,venue,close,ID,low,ExecutionTime,high\n9,x,3,Mon01Q1,2,2024-01-01T00:15:00Z,4\n"
                                  "9,x,3,Mon01Q1,abc,2024-01-01T00:30:00Z,4\n")
    return folder


def test_csv_columns_go_by_name_in_every_file(spark, tmp_path):
    rows = read_raw_csv(spark, str(csv_folder(tmp_path))).orderBy("asset", "ts").collect()
    assert [tuple(r)[2:] for r in rows] == [(4.0, 2.0, 3.0, 9.0), (4.0, 2.0, 3.0, 9.0), (4.0, None, 3.0, 9.0)]


def test_ingest_reports_what_became_of_every_row(spark, tmp_path):
    out = str(tmp_path / "table")
    r = ingest_csv(spark, str(csv_folder(tmp_path)), out).first()
    assert (r.rows_read, r.no_id, r.bad_time, r.bad_number, r.rows, r.assets, r.assets_skipped) == (5, 1, 1, 1, 3, 2, 0)
    again = ingest_csv(spark, str(tmp_path / "csv"), out, force=False).first()
    assert (again.rows_read, again.rows, again.assets, again.assets_skipped) == (5, 0, 0, 2)


def test_forced_ingest_clears_the_table(spark, tmp_path):
    out = str(tmp_path / "table")
    ingest_csv(spark, str(csv_folder(tmp_path)), out)
    one = tmp_path / "one.csv"
    one.write_text("ID,ExecutionTime,high,low,close,volume\nTue00Q1,2024-01-01T00:00:00Z,4,2,3,9\n")
    ingest_csv(spark, str(one), out)
    assert [r.asset for r in read_panel(spark, out).select("asset").distinct().collect()] == ["Tue00Q1"]


def test_damaged_files_are_named_and_not_skipped_elsewhere(spark, tmp_path):
    out = str(tmp_path / "table")
    ingest_csv(spark, str(csv_folder(tmp_path)), out)
    schema = spark.read.parquet(out).schema
    bad = f"{out}/asset=Mon00Q1/broken.parquet"
    with open(bad, "wb") as f:
        f.write(b"not parquet")
    assert [os.path.basename(r.path) for r in skipped_files(spark, out, schema).collect()] == ["broken.parquet"]
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "false"


def test_a_damaged_table_is_not_a_new_one(spark, tmp_path):
    assert existing_assets(spark, str(tmp_path / "none")) is None
    folder = tmp_path / "bad" / "asset=Mon00Q1"
    folder.mkdir(parents=True)
    (folder / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        existing_assets(spark, str(tmp_path / "bad")).count()


def test_stream_ingest_reads_by_name_and_stops_at_another_header(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("ID,ExecutionTime,venue,high,low,close,volume\nMon00Q1,2024-01-01T00:00:00Z,x,4,2,3,9\n")
    stream_ingest_csv(spark, str(landing), str(tmp_path / "o"), str(tmp_path / "c"))
    r = spark.read.parquet(str(tmp_path / "o")).first()
    assert (r.high, r.low, r.close, r.volume) == (4.0, 2.0, 3.0, 9.0)
    (landing / "b.csv").write_text("ID,venue,ExecutionTime,high,low,close,volume\nMon00Q1,x,2024-01-01T00:15:00Z,4,2,3,9\n")
    with pytest.raises(Exception):
        stream_ingest_csv(spark, str(landing), str(tmp_path / "o"), str(tmp_path / "c"))


def test_segments_do_not_run_across_a_split(spark):
    rows = series(NAMES[0], [1.0] * 6)
    df = panel_df(spark, rows).withColumn("split", F.when(F.hour("ts") < 3, "train").otherwise("val"))
    assert trading_segments(df, 4).count() == 6
    assert trading_segments(df, 4, ("split", "asset")).count() == 0


def test_fill_is_linear_in_the_series(spark):
    import time
    def run(n):
        df = spark.range(n).select(F.lit("Mon00Q1").alias("asset"), F.timestamp_seconds(F.col("id") * 900).alias("ts"),
                                   F.when(F.col("id") > n // 2, F.col("id").cast("double")).alias("x"))
        t = time.perf_counter()
        got = fill_series(df, ["x"]).agg(F.sum("x"), F.min("x")).first()
        assert got[1] == n // 2 + 1
        return time.perf_counter() - t
    run(1000)
    assert run(40_000) < 3 * max(run(20_000), 0.5)


def test_joining_a_small_side_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("join-small", "")
    big, small = spark.range(10).withColumnRenamed("id", "k"), spark.range(3).groupBy(F.col("id").alias("k")).count()
    j = join_small(big, small, "k")
    assert len(tracker.getJobIdsForGroup("join-small")) == 0 and j.count() == 10
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unknown_table_column_is_an_error(spark, tmp_path):
    ingest_csv(spark, str(csv_folder(tmp_path)), str(tmp_path / "t"))
    with pytest.raises((ValueError, AnalysisException)):
        read_panel(spark, str(tmp_path / "t"), required=("no_such",))
