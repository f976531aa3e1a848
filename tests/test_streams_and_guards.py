"""Dense candles as a stream, ingest with quarantine and commits, guarded file scans."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarterline.sources.candles import candles, densify
from quarterline.sources.csv_ingest import header_lines, ingest_csv, read_panel
from quarterline.sources.guarded import guarded_scan
from quarterline.streaming import ingest
from quarterline.streaming.dense import stream_dense_candles, write_tick_files

T0 = datetime(2024, 1, 1)
COLS = ["asset", "ts", "high", "low", "close", "volume"]


def tick_rows():
    """Contract a ticks often, b falls silent, c begins late and ticks once, d only in the first slot."""
    rows = [("a", T0 + timedelta(minutes=7 * k), float(k % 13), k) for k in range(400)]
    rows += [("b", T0 + timedelta(minutes=11 * k), float(k), 1000 + k) for k in range(40)]
    rows += [("c", T0 + timedelta(hours=30, minutes=2), 5.0, 2000), ("d", T0 + timedelta(seconds=1), 6.0, 2001)]
    return rows


@pytest.mark.parametrize("order, lateness, per_batch", [((0, 1, 2, 3), 1800, 1), ((1, 0, 3, 2), 86400, 1), ((3, 1, 0, 2), 600, None),
                                                        ((2, 3, 0, 1), 3 * 86400, 2)])
def test_dense_stream_equals_the_batch_grid(spark, tmp_path, order, lateness, per_batch):
    ticks = spark.createDataFrame(tick_rows(), "asset string, ts timestamp, price double, seq long")
    landing = str(tmp_path / "in")
    origin = write_tick_files(ticks, landing, 4, order, lateness)
    out = str(tmp_path / "out")
    stream_dense_candles(spark, landing, out, str(tmp_path / "ck"), origin, 900, f"{lateness} seconds", per_batch)
    got = spark.read.parquet(out).select(*COLS)
    want = densify(candles(ticks, "asset", "ts", "price", ["seq"], 900), 900).select(*COLS)
    assert sorted(got.collect()) == sorted(want.collect())


def test_dense_stream_goes_on_after_a_stop(spark, tmp_path):
    ticks = spark.createDataFrame(tick_rows(), "asset string, ts timestamp, price double, seq long")
    landing, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    cut = ticks.filter(F.col("ts") < "2024-01-02")
    cut.coalesce(1).write.parquet(landing)
    origin = int(T0.timestamp() * 1000) if os.environ.get("TZ") == "UTC" else 1704067200000
    stream_dense_candles(spark, landing, out, ck, origin)
    first = spark.read.parquet(out).count()
    write_tick_files(ticks.filter(F.col("ts") >= "2024-01-02"), landing, 1, (0,), 1800)
    stream_dense_candles(spark, landing, out, ck, origin)
    got = spark.read.parquet(out).select(*COLS)
    want = densify(candles(ticks, "asset", "ts", "price", ["seq"], 900), 900).select(*COLS)
    assert 0 < first < want.count() and sorted(got.collect()) == sorted(want.collect())


HEADER = "ID,ExecutionTime,high,low,close,volume\n"


def dirty_folder(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "Mon00Q1,2024-01-01T00:00:00Z,4,2,3,9\n,2024-01-01T00:00:00Z,1,1,1,1\n"
                                  "Mon00Q1,not a time,1,1,1,1\nMon01Q1,2024-01-01T00:00:00Z,abc,2,3,9\n")
    (folder / "b.csv").write_text(HEADER + "Mon01Q1,2024-01-01T00:15:00Z,4,2,3,9\n,nothing,x,x,x,x\n")
    return folder


def states(spark, out):
    rows = sorted(ingest.read_ingested(spark, out).select(*COLS).collect(), key=str)
    refused = sorted((r.reason, r.kept) for r in ingest.read_quarantine(spark, out).collect())
    return rows, refused, ingest.ingest_totals(spark, out).first()


def test_every_row_is_written_or_in_quarantine(spark, tmp_path):
    folder, out = dirty_folder(tmp_path), str(tmp_path / "out")
    ingest.stream_ingest_csv(spark, str(folder), out, str(tmp_path / "ck"))
    rows, refused, t = states(spark, out)
    assert refused == [("bad_number", True), ("bad_time", False), ("no_id", False), ("no_id", False)]
    assert tuple(t) == (2, 6, 3, 2, 1, 1) and t.rows_read == t.written + sum(not kept for _, kept in refused)
    batch = str(tmp_path / "batch")
    ingest_csv(spark, str(folder), batch)
    assert rows == sorted(read_panel(spark, batch).select(*COLS).collect(), key=str)


@pytest.mark.parametrize("stop", ["panel", "commit", "after"])
def test_a_restart_in_the_middle_of_a_batch_leaves_no_duplicate(spark, tmp_path, monkeypatch, stop):
    folder, out, ck = dirty_folder(tmp_path), str(tmp_path / "out"), str(tmp_path / "ck")
    put, batch, calls = ingest._put, ingest.ingest_batch, []

    def failing(df, path, parts):
        if len(calls) == 0 and (path == out if stop == "panel" else path.endswith("-commits") and stop == "commit"):
            calls.append(path)
            if stop == "panel":
                put(df.limit(1), path, parts)  # half of the batch is there
            raise RuntimeError("lost")
        put(df, path, parts)

    def stopped(*args):
        batch(*args)
        if stop == "after" and not calls:
            calls.append(1)
            raise RuntimeError("lost after the commit")

    monkeypatch.setattr(ingest, "_put", failing)
    monkeypatch.setattr(ingest, "ingest_batch", stopped)
    with pytest.raises(Exception):
        ingest.stream_ingest_csv(spark, str(folder), out, ck)
    if stop != "after":
        assert len(calls) == 1
    ingest.stream_ingest_csv(spark, str(folder), out, ck)
    rows, refused, t = states(spark, out)
    assert len(rows) == 3 == len(set(rows)) and len(refused) == 4 and tuple(t) == (2, 6, 3, 2, 1, 1)


def test_nothing_refused_and_a_second_run(spark, tmp_path):
    folder, out, ck = tmp_path / "csv", str(tmp_path / "out"), str(tmp_path / "ck")
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "Mon00Q1,2024-01-01T00:00:00Z,4,2,3,9\n")
    ingest.stream_ingest_csv(spark, str(folder), out, ck)
    ingest.stream_ingest_csv(spark, str(folder), out, ck)
    rows, refused, t = states(spark, out)
    assert len(rows) == 1 and refused == [] and t.batches == 1


def test_every_row_refused_leaves_an_empty_panel(spark, tmp_path):
    folder, out = tmp_path / "csv", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + ",2024-01-01T00:00:00Z,4,2,3,9\nMon00Q1,not a time,1,1,1,1\n")
    ingest.stream_ingest_csv(spark, str(folder), out, str(tmp_path / "ck"))
    rows, refused, t = states(spark, out)
    assert rows == [] and refused == [("bad_time", False), ("no_id", False)] and tuple(t) == (1, 2, 0, 1, 1, 0)
    (folder / "b.csv").write_text(HEADER + "Mon00Q1,2024-01-01T00:00:00Z,4,2,3,9\n")
    empty = dict(ingest.read_ingested(spark, out).dtypes)
    ingest.stream_ingest_csv(spark, str(folder), out, str(tmp_path / "ck"))
    later = ingest.read_ingested(spark, out)
    assert later.count() == 1 and dict(later.dtypes) == empty


def test_header_lines_in_one_scan(spark, tmp_path):
    folder = dirty_folder(tmp_path)
    (folder / "c.csv").write_text("\n \nvolume,ID\n1,x\n")
    (folder / "d.csv").write_text("")
    got = {os.path.basename(r.path): r.header for r in header_lines(spark, str(folder)).collect()}
    assert got == {"a.csv": HEADER.strip(), "b.csv": HEADER.strip(), "c.csv": "volume,ID"}


def damaged_table(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    folder = tmp_path / "files"
    (folder / "asset=Sat00Q1").mkdir(parents=True)
    table = pa.table({"ts": pa.array([T0 + timedelta(minutes=15 * k) for k in range(5000)], pa.timestamp("us")),
                      **{c: pa.array([float(k % 7) for k in range(5000)]) for c in COLS[2:]}})
    for name in ("Mon00Q1", "Mon01Q1", "Mon02Q1", "Mon03Q1", "Mon04Q1"):
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=1000, write_page_checksum=True)
    pq.write_table(table.slice(0, 3), folder / "asset=Sat00Q1" / "part-0.parquet")
    pq.write_table(table.drop_columns(["ts"]), folder / "Tue00Q1.parquet")
    pq.write_table(table.drop_columns(["close", "low"]), folder / "Tue01Q1.parquet")
    pq.write_table(table.slice(0, 0), folder / "Wed00Q1.parquet")
    (folder / "Thu00Q1.parquet").write_bytes(b"")
    cut = folder / "Mon01Q1.parquet"
    cut.write_bytes(cut.read_bytes()[:-9])
    page = folder / "Mon02Q1.parquet"  # a page of the last row group: rows before it can be read
    data = bytearray(page.read_bytes())
    col = pq.ParquetFile(page).metadata.row_group(4).column(2)
    data[(col.dictionary_page_offset or col.data_page_offset) + col.total_compressed_size - 1] ^= 0x55
    page.write_bytes(data)
    return str(folder)


def test_every_damaged_file_is_named_and_gives_no_row(spark, tmp_path):
    rows, files = guarded_scan(spark, damaged_table(spark, tmp_path))
    got = {r.asset: (r.rows, r.reason) for r in files.collect()}
    assert got == {"Mon00Q1": (5000, None), "Mon01Q1": (0, "unreadable footer"), "Mon02Q1": (0, "unreadable page"), "Mon03Q1": (5000, None),
                   "Mon04Q1": (5000, None), "Sat00Q1": (3, None), "Tue00Q1": (0, "no column ts"), "Tue01Q1": (0, "no column low, close"),
                   "Wed00Q1": (0, None), "Thu00Q1": (0, "empty file")}
    counts = dict(rows.groupBy("asset").count().collect())
    assert counts == {a: n for a, (n, _) in got.items() if n}
    assert rows.filter("asset = 'Mon00Q1'").agg(F.min("ts"), F.sum("volume")).first() == (T0, sum(k % 7 for k in range(5000)))


def test_guarded_scan_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    rows, files = guarded_scan(spark, str(tmp_path / "none"))
    assert rows.count() == 0 and files.count() == 0
