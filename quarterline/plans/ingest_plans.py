"""Plans for ingest, sinks and streams.

Each plan writes into a fresh folder under the shared ``spark.checkpoint.dir`` and reads
the result back, so the check covers the written table, not the in-memory plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.segments import trading_segments
from ..sources.candles import events_panel
from ..sources.csv_ingest import asset_manifest, ingest_csv, read_panel
from ..sources.guarded import guarded_scan
from ..sources.panel_io import read_json_report, subsample_report, write_json_report, write_split, write_subsampled, \
    write_trading_segments
from ..session import scratch_path
from ..streaming.candles import latest_candles, stream_event_candles
from ..streaming.dense import stream_dense_candles, write_tick_files
from ..streaming.ingest import ingest_totals, read_ingested, read_quarantine, stream_ingest_csv
from . import oracle as O
from .catalog import register
from .model_plans import SPLIT_1H, split_panel
from .segment_plans import MIN_SEG, TRADED_1H, traded_panel, _cmp_sql

QUARTER = 900
PANEL_COLS = ["asset", "ts", "high", "low", "close", "volume"]


def raw_csv_export(spark: SparkSession, sf_dir: str, n_files: int = 3) -> str:
    """FX5: the 15-minute event panel as exchange-style CSV (ID, ExecutionTime, HLCV, an extra
    column) in several files, plus rows without a contract id taken from the first slot."""
    p = events_panel(spark, sf_dir, QUARTER)
    rows = p.select(F.col("asset").alias("ID"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ExecutionTime"),
                    "high", "low", "close", "volume", F.lit("intraday").alias("venue"))
    first = p.agg(F.min("ts").alias("t0")).first()["t0"]
    no_id = rows.filter(F.col("ExecutionTime") == F.date_format(F.lit(first), "yyyy-MM-dd'T'HH:mm:ssXXX")) \
                .orderBy("ID").limit(2).withColumn("ID", F.lit(None).cast("string"))
    path = scratch_path(spark, "raw-csv")
    rows.unionByName(no_id).repartition(n_files).write.option("header", True).csv(path)
    return path


@register("s01_csv_ingest_roundtrip", f"SELECT * FROM ({O.event_panel_sql(QUARTER)})")
def s01_csv_ingest_roundtrip(spark, sf_dir):
    """Raw CSV -> contract-partitioned snappy Parquet -> scanned back."""
    out = scratch_path(spark, "panel")
    ingest_csv(spark, raw_csv_export(spark, sf_dir), out)
    return read_panel(spark, out).select(*PANEL_COLS)


@register("s08_ingest_report", f"""
    SELECT count(*) + 2 AS rows_read, 2::BIGINT AS no_id, 0::BIGINT AS bad_time, 0::BIGINT AS bad_number,
           count(*) AS rows, ceil(count(*) / 200000)::BIGINT AS chunks, count(DISTINCT asset) AS assets,
           0::BIGINT AS assets_skipped FROM ({O.event_panel_sql(QUARTER)})""")
def s08_ingest_report(spark, sf_dir):
    """Rows read, without id, with unreadable values and written, chunk-equivalents, contracts."""
    return ingest_csv(spark, raw_csv_export(spark, sf_dir), scratch_path(spark, "panel"))


@register("s06_incremental_skip", f"""
    SELECT count(*) + 2 AS rows_read, 2::BIGINT AS no_id, 0::BIGINT AS bad_time, 0::BIGINT AS bad_number,
           0::BIGINT AS rows, 0::BIGINT AS chunks, 0::BIGINT AS assets,
           count(DISTINCT asset) AS assets_skipped FROM ({O.event_panel_sql(QUARTER)})""")
def s06_incremental_skip(spark, sf_dir):
    """A second ingest without ``force`` skips every contract already in the table."""
    csv, out = raw_csv_export(spark, sf_dir), scratch_path(spark, "panel")
    ingest_csv(spark, csv, out)
    return ingest_csv(spark, csv, out, force=False)


@register("s07_asset_manifest", f"SELECT DISTINCT asset FROM ({O.event_panel_sql(QUARTER)})")
def s07_asset_manifest(spark, sf_dir):
    """S7 + S10: manifest written as JSON, then used to resolve the contract list of a scan."""
    out = scratch_path(spark, "panel")
    ingest_csv(spark, raw_csv_export(spark, sf_dir), out)
    man = scratch_path(spark, "manifest")
    asset_manifest(read_panel(spark, out), man)
    return read_panel(spark, out, manifest=man).select("asset").distinct()


@register("s12_split_write", f"""
    SELECT split, asset, count(*) AS rows, sum(is_trading)::BIGINT AS trading_rows FROM ({SPLIT_1H}) GROUP BY split, asset""")
def s12_split_write(spark, sf_dir):
    """Train / val written partitioned by split and contract, read back per partition."""
    out = scratch_path(spark, "split")
    write_split(split_panel(spark, sf_dir), out)
    back = spark.read.parquet(out)
    return back.groupBy("split", "asset").agg(F.count(F.lit(1)).alias("rows"),
                                              F.sum("is_trading").alias("trading_rows"))


def _islands_of(split: str, cond: str) -> str:
    rows = f"SELECT * FROM ({TRADED_1H}) WHERE ts {cond} TIMESTAMP '2024-01-22'"
    return (f"SELECT asset, ts, '{split}' AS split, island_no AS segment_id FROM ({O.islands_sql(rows)}) "
            f"WHERE is_trading = 1 AND island_len >= {MIN_SEG}")


@register("s18_segment_writer", f"{_islands_of('train', '<')} UNION ALL {_islands_of('val', '>=')}")
def s18_segment_writer(spark, sf_dir):
    """Rows inside trading segments >= 4 of each split (split first), written per split and contract."""
    out = scratch_path(spark, "segments")
    write_trading_segments(traded_panel(spark, sf_dir).withColumn(
        "split", F.when(F.col("ts") < F.to_timestamp(F.lit("2024-01-22")), "train").otherwise("val")), out, MIN_SEG)
    return spark.read.parquet(out).select("asset", "ts", "split", "segment_id")


@register("s19_subsampled_report", f"""
    SELECT split, count(*) AS rows, count(DISTINCT asset) AS assets FROM (
      {O.stratified_sql(f"SELECT * FROM ({SPLIT_1H}) WHERE split = 'train'")}
      UNION ALL
      {O.stratified_sql(f"SELECT * FROM ({SPLIT_1H}) WHERE split = 'val'")}) GROUP BY split""")
def s19_subsampled_report(spark, sf_dir):
    """Stratified subsample of every contract and split, written once; rows per split."""
    by_split, _ = write_subsampled(split_panel(spark, sf_dir), scratch_path(spark, "subsampled"), "Stratified")
    return by_split


_BUSY = f"SELECT * REPLACE ((volume >= 4)::INTEGER AS is_trading) FROM ({O.traded_sql(O.event_panel_sql(QUARTER))})"


@register("s19_processed_skipped", f"""
    WITH p AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-22' THEN 'train' ELSE 'val' END AS split FROM ({_BUSY})),
    n AS (SELECT split, asset, count(*) FILTER (is_trading = 1) AS n FROM p GROUP BY split, asset)
    SELECT split, count(*) FILTER (n > 0) AS processed, sum(n)::BIGINT AS rows,
           coalesce(string_agg(asset, ',' ORDER BY asset) FILTER (n = 0), '') AS skipped
    FROM n GROUP BY split""")
def s19_processed_skipped(spark, sf_dir):
    """S19 report: slots with 4 and more ticks trade; contracts without any in a split are skipped there and named."""
    p = events_panel(spark, sf_dir, QUARTER).withColumn("is_trading", (F.col("volume") >= 4).cast("int"))
    p = p.withColumn("split", F.when(F.col("ts") < F.to_timestamp(F.lit("2024-01-22")), "train").otherwise("val"))
    return subsample_report(p, *write_subsampled(p, scratch_path(spark, "busy"), "Trading-Only"))


@register("s14_json_report_roundtrip", f"SELECT * FROM ({_cmp_sql()})")
def s14_json_report_roundtrip(spark, sf_dir):
    """S14 + S15: the strategy comparison written as a JSON report and read back."""
    from ..operators.sampling import compare_strategies
    path = scratch_path(spark, "report")
    write_json_report(compare_strategies(traded_panel(spark, sf_dir)), path)
    schema = ("strategy string, total_rows long, trading_rows long, non_trading_rows long, "
              "trading_pct double, size_reduction_pct double")
    return read_json_report(spark, path, schema=schema)


@register("t1_stream_ingest", f"SELECT * FROM ({O.event_panel_sql(QUARTER)})")
def t1_stream_ingest(spark, sf_dir):
    """The CSV export ingested by a Structured Streaming query (availableNow, one file per
    micro-batch); its end state equals the batch ingest."""
    csv = raw_csv_export(spark, sf_dir)
    out, ck = scratch_path(spark, "stream-panel"), scratch_path(spark, "stream-ck")
    stream_ingest_csv(spark, csv, out, ck)
    return read_ingested(spark, out).select(*PANEL_COLS)


def dirty_csv_export(spark: SparkSession, sf_dir: str, n_files: int = 3) -> str:
    """FX6: the 15-minute event panel as CSV in which slots with 4 and more ticks have no contract id, those with 3 an
    unreadable time and those with 2 an unreadable high."""
    n = F.col("volume")
    rows = events_panel(spark, sf_dir, QUARTER).select(
        F.when(n < 4, F.col("asset")).alias("ID"),
        F.when(n == 3, F.concat(F.lit("at "), "ts")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")).alias("ExecutionTime"),
        F.when(n == 2, F.concat(F.lit("~"), "high")).otherwise(F.col("high").cast("string")).alias("high"), "low", "close", "volume")
    path = scratch_path(spark, "dirty-csv")
    rows.repartition(n_files).write.option("header", True).csv(path)
    return path


def _dirty_stream(spark: SparkSession, sf_dir: str) -> str:
    out = scratch_path(spark, "stream-panel")
    stream_ingest_csv(spark, dirty_csv_export(spark, sf_dir), out, scratch_path(spark, "stream-ck"))
    return out


@register("t1_stream_dirty_rows", f"""
    SELECT asset, ts, CASE WHEN volume <> 2 THEN high END AS high, low, close, volume
    FROM ({O.event_panel_sql(QUARTER)}) WHERE volume < 3""")
def t1_stream_dirty_rows(spark, sf_dir):
    """T1 on a dirty export: the rows that the batch ingest keeps, unreadable numbers as NULL."""
    return read_ingested(spark, _dirty_stream(spark, sf_dir)).select(*PANEL_COLS)


@register("t1_stream_totals", f"""
    SELECT 3::BIGINT AS batches, count(*) AS rows_read, count(*) FILTER (volume < 3) AS written,
           count(*) FILTER (volume >= 4) AS no_id, count(*) FILTER (volume = 3) AS bad_time,
           count(*) FILTER (volume = 2) AS bad_number
    FROM ({O.event_panel_sql(QUARTER)})""")
def t1_stream_totals(spark, sf_dir):
    """T1 report from the commits: what became of every row read."""
    return ingest_totals(spark, _dirty_stream(spark, sf_dir))


@register("t1_stream_quarantine", f"""
    SELECT CASE WHEN volume >= 4 THEN 'no_id' WHEN volume = 3 THEN 'bad_time' ELSE 'bad_number' END AS reason,
           volume = 2 AS kept, CASE WHEN volume < 4 THEN asset END AS id, close
    FROM ({O.event_panel_sql(QUARTER)}) WHERE volume >= 2""")
def t1_stream_quarantine(spark, sf_dir):
    """T1 quarantine: the raw rows that were left out, or kept without a number, with the reason."""
    rows = read_quarantine(spark, _dirty_stream(spark, sf_dir))
    return rows.select("reason", "kept", F.get_json_object("raw", "$.ID").alias("id"),
                       F.get_json_object("raw", "$.close").cast("double").alias("close"))


@register("t2_stream_dense_15m", f"SELECT * FROM ({O.event_panel_sql(QUARTER)})")
def t2_stream_dense_15m(spark, sf_dir):
    """T2 + J1 as a stream: four tick files in mixed order of time, one per batch; zero candles come out by timers."""
    from ..functions.contracts import contract_name_for_int
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ticks = ev.select(contract_name_for_int(F.pmod(F.col("user_id"), F.lit(24))).alias("asset"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("value").alias("price"), F.col("event_id").alias("seq"))
    landing, late = scratch_path(spark, "ticks"), 16 * 86400
    origin = write_tick_files(ticks, landing, 4, (1, 0, 3, 2), late, QUARTER)
    out = scratch_path(spark, "dense")
    stream_dense_candles(spark, landing, out, scratch_path(spark, "dense-ck"), origin, QUARTER, f"{late} seconds", 1)
    return spark.read.parquet(out).select(*PANEL_COLS)


def _flat_files(panel: DataFrame, folder: str) -> DataFrame:
    """One Parquet file per contract, ``<contract>.parquet``, written by its task; the first four in order of name damaged:
    cut at the end, a page overwritten, empty, without the time column. (asset, size)."""
    names = panel.select("asset").distinct()
    from ..sources.candles import asset_index
    rows = panel.join(asset_index(names), "asset")

    def put(key, pdf):
        import io
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        asset, idx = key
        table = pa.Table.from_pandas(pdf.sort_values("ts")[["ts", "high", "low", "close", "volume"]], preserve_index=False)
        if idx == 3:
            table = table.drop_columns(["ts"])
        buffer = io.BytesIO()
        pq.write_table(table, buffer, write_page_checksum=True)
        data = bytearray(buffer.getvalue())
        if idx == 0:
            data = data[:-20]
        elif idx == 1:
            meta = pq.ParquetFile(io.BytesIO(bytes(data))).metadata.row_group(0).column(4)
            start = meta.dictionary_page_offset or meta.data_page_offset
            data[start + meta.total_compressed_size - 1] ^= 0xFF
        elif idx == 2:
            data = b""
        store, inner = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.replace("file:", "", 1))
        store.create_dir(inner, recursive=True)
        with store.open_output_stream(f"{inner}/{asset}.parquet") as f:
            f.write(bytes(data))
        return pd.DataFrame({"asset": [asset], "size": [len(data)]})

    return rows.groupBy("asset", "idx").applyInPandas(put, "asset string, size long")


@register("s11_guarded_files", f"""
    WITH n AS (SELECT asset, count(*) AS n, row_number() OVER (ORDER BY asset) AS i FROM ({O.event_panel_sql(3600)}) GROUP BY asset)
    SELECT asset, CASE WHEN i > 4 THEN n ELSE 0 END AS rows,
           CASE i WHEN 1 THEN 'unreadable footer' WHEN 2 THEN 'unreadable page' WHEN 3 THEN 'empty file' WHEN 4 THEN 'no column ts' END AS reason
    FROM n""")
def s11_guarded_files(spark, sf_dir):
    """S9 + S11: one file per contract, four of them damaged; every file is named with its rows or the reason."""
    folder = scratch_path(spark, "files")
    _flat_files(events_panel(spark, sf_dir, 3600), folder).count()
    _, files = guarded_scan(spark, folder)
    return files.select("asset", "rows", "reason")


@register("s11_guarded_rows", f"""
    SELECT * FROM ({O.event_panel_sql(3600)})
    WHERE asset NOT IN (SELECT DISTINCT asset FROM ({O.event_panel_sql(3600)}) ORDER BY asset LIMIT 4)""")
def s11_guarded_rows(spark, sf_dir):
    """S9 + S11: the rows of the readable files, the contract from the file's name."""
    folder = scratch_path(spark, "files")
    _flat_files(events_panel(spark, sf_dir, 3600), folder).count()
    rows, _ = guarded_scan(spark, folder)
    return rows.select(*PANEL_COLS)


@register("t2_stream_candles_15m", f"SELECT * FROM ({O.event_candles_sql(QUARTER)})")
def t2_stream_candles_15m(spark, sf_dir):
    """15-minute candles from the events stream (watermark 30 minutes, update mode)."""
    out, ck = scratch_path(spark, "stream-candles"), scratch_path(spark, "stream-candles-ck")
    stream_event_candles(spark, f"{sf_dir}/events.parquet", out, ck, "15 minutes")
    return latest_candles(spark.read.parquet(out)).select(*PANEL_COLS)
