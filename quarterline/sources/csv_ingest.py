"""Raw CSV ingest into a contract-partitioned Parquet table.

One job: scan -> project -> parse time -> drop NULL contracts -> rebalance by contract ->
sort within partitions -> partitioned write (the ingest report is observed on that job). There are no temporary per-contract files;
the shuffle replaces the reference's two-pass split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import TARGETS
from ..session import ensure_utc


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, header): the first line with text of every CSV file under ``path``, in one scan of the lines. Only a
    file's first block can hold it, and each task keeps one line per file."""
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").text(path)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                     "value", F.monotonically_increasing_id().alias("line")))
    first = lines.filter((F.col("start") == 0) & (F.length(F.trim("value")) > 0))
    return first.groupBy("path").agg(F.min_by("value", "line").alias("header"))


def _by_header(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files under ``path`` with their columns by name: files are grouped by header line, so a
    file with another column order is read by its own. Only names and header lines reach the driver."""
    read = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    groups: dict[str, list[str]] = {}
    for r in header_lines(spark, path).orderBy("path").toLocalIterator():
        groups.setdefault(r.header, []).append(r.path)
    parts = [read.csv(fs) for fs in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else read.csv(path)


def read_raw_rows(spark: SparkSession, path: str, id_col: str = "ID", timestamp_col: str = "ExecutionTime",
                  target_cols: Sequence[str] = TARGETS, timestamp_format: str | None = None) -> DataFrame:
    """Header CSV scan, columns by name, timestamp parsed on the UTC clock, numeric targets as
    DOUBLE; ``bad_time`` and ``bad_number`` flag values that are there but cannot be read."""
    ensure_utc(spark)
    raw = _by_header(spark, path)
    ts = (F.try_to_timestamp(F.col(timestamp_col), F.lit(timestamp_format)) if timestamp_format
          else F.try_to_timestamp(F.col(timestamp_col)))
    numbers = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in target_cols}
    bad = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & x.isNull() for c, x in numbers.items()])
    return raw.select(F.col(id_col).alias("asset"), ts.alias("ts"), *[x.alias(c) for c, x in numbers.items()],
                      ts.isNull().alias("bad_time"), bad.alias("bad_number"))


def read_raw_csv(spark: SparkSession, path: str, **kw) -> DataFrame:
    """``read_raw_rows`` without rows that lack a contract or a readable time."""
    rows = read_raw_rows(spark, path, **kw)
    return rows.filter(F.col("asset").isNotNull() & ~F.col("bad_time")).drop("bad_time", "bad_number")


def _sorted_for_write(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    # REBALANCE by the partition columns: a hash shuffle by contract that AQE may split where
    # one contract is hot (a third of all rows no longer lands in one write task) and coalesce
    # where partitions are small. Each task then sorts its rows by (contract, time).
    return df.hint("rebalance", *parts).sortWithinPartitions(*parts, "ts")


def write_panel(df: DataFrame, out: str, mode: str = "overwrite", extra_partitions: Sequence[str] = (),
                clear: bool = False) -> None:
    """Shuffle by contract, sort each contract by time, snappy Parquet partitioned by
    (extra..., asset). ``mode="overwrite"`` replaces the partitions written, with ``clear`` the table."""
    parts = [*extra_partitions, "asset"]
    _write_sorted(_sorted_for_write(df, parts), out, mode, parts, clear)


def _write_sorted(df: DataFrame, out: str, mode: str, parts: Sequence[str], clear: bool) -> None:
    (df.write.mode(mode).option("compression", "snappy")
     .option("partitionOverwriteMode", "static" if clear else "dynamic").partitionBy(*parts).parquet(out))


def existing_assets(spark: SparkSession, out: str) -> DataFrame | None:
    """Contracts of the table; None where there is no table. A damaged table is an error, not a new one."""
    try:
        return spark.read.parquet(out).select("asset").distinct()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") and not _has_files(spark, out):
            return None
        raise


def _has_files(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", True)
                    .option("pathGlobFilter", "*.parquet").load(path).select("path").head(1))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def ingest_csv(spark: SparkSession, csv_path: str, out: str, force: bool = True, chunksize: int = 200_000,
               **read_kw) -> DataFrame:
    """Ingest, skip contracts already written unless ``force`` (S6, which clears the table, S13),
    and return the report (S8): rows read and what became of them.

    rows_read, no_id, bad_time (rows left out: no contract, unreadable time), bad_number (kept, the
    value NULL), rows (written), chunks, assets (contracts written), assets_skipped. The raw files are
    read once; the counts are observed on the write job. Contracts are counted from the table's
    partitions; only with ``force=False`` the id column is read again for the skipped ones.
    """
    raw = read_raw_rows(spark, csv_path, **read_kw)
    have = None if force else existing_assets(spark, out)
    before = 0 if have is None else have.count()
    seen, kept = Observation("ingest_read"), Observation("ingest_rows")
    no_id = F.col("asset").isNull()
    df = (raw.observe(seen, *_read_counts())
          .filter(~no_id & ~F.col("bad_time")).drop("bad_time", "bad_number"))
    skipped = 0
    if have is not None:
        df = df.join(have, "asset", "left_anti")
        skipped = have.join(read_raw_csv(spark, csv_path, **read_kw).select("asset").distinct(), "asset", "left_semi").count()
    sorted_rows = _sorted_for_write(df, ["asset"]).observe(kept, F.count(F.lit(1)).alias("rows"))
    _write_sorted(sorted_rows, out, "overwrite" if force else "append", ["asset"], clear=force)
    rows = int(kept.get["rows"])
    if rows:
        counts = seen.get
        assets = spark.read.parquet(out).select("asset").distinct().count() - before
    else:  # AQE drops an empty stage together with its observation
        assets, counts = 0, raw.agg(*_read_counts()).first().asDict()
    return spark.createDataFrame(
        [(int(counts["rows_read"]), int(counts["no_id"]), int(counts["bad_time"]), int(counts["bad_number"]), rows,
          math.ceil(rows / chunksize) if rows else 0, assets, skipped)],
        "rows_read long, no_id long, bad_time long, bad_number long, rows long, chunks long, assets long, "
        "assets_skipped long")


def _read_counts() -> list:
    no_id = F.col("asset").isNull()
    return [F.count(F.lit(1)).alias("rows_read"), F.count_if(no_id).alias("no_id"),
            F.count_if(~no_id & F.col("bad_time")).alias("bad_time"),
            F.count_if(~no_id & ~F.col("bad_time") & F.col("bad_number")).alias("bad_number")]


def asset_manifest(panel: DataFrame, out: str | None = None) -> DataFrame:
    """Sorted list of contracts; optionally written as JSON next to the table."""
    m = panel.select("asset").distinct().orderBy("asset")
    if out:
        m.coalesce(1).write.mode("overwrite").json(out)
    return m


def read_panel(spark: SparkSession, root: str, assets: Sequence[str] | None = None,
               manifest: str | None = None, required: Sequence[str] = ("ts",)) -> DataFrame:
    """Scan the partitioned table (contract = partition column), restrict to an asset
    list (explicit -> manifest -> everything) with a semi join, skip unreadable files (this read only;
    ``skipped_files`` names them) and fail loudly when a required column is missing."""
    df = _lenient(spark).parquet(root)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"table {root} lacks required columns {missing}")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    if assets is not None:
        keep = spark.createDataFrame([(a,) for a in assets], "asset string")
        df = df.join(F.broadcast(keep), "asset", "left_semi")  # explicit list: small by construction
    elif manifest is not None:
        df = df.join(spark.read.json(manifest).select("asset"), "asset", "left_semi")
    return df


def _lenient(spark: SparkSession):
    return spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)


def skipped_files(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """S11 report: (path) of the table's files that a lenient scan could not read a row from."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(root).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")))
    reader = _lenient(spark).schema(schema) if schema is not None else _lenient(spark)
    read = reader.parquet(root).select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("path")).distinct()
    return files.join(read, "path", "left_anti")


def needs_refresh(source: DataFrame, filtered: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Rebuild the filtered table when it holds fewer than 90 % of the source contracts."""
    # one pass, no join: tag both inputs, reduce to one row per contract, then count
    tagged = (source.select("asset", F.lit(True).alias("_src"), F.lit(False).alias("_flt"))
              .unionByName(filtered.select("asset", F.lit(False).alias("_src"), F.lit(True).alias("_flt"))))
    per_asset = (tagged.filter(F.col("asset").isNotNull()).groupBy("asset")
                 .agg(F.max("_src").alias("_src"), F.max("_flt").alias("_flt")))
    counts = per_asset.agg(F.count_if("_src").alias("source_assets"), F.count_if("_flt").alias("filtered_assets"))
    return counts.withColumn("refresh", F.col("filtered_assets") < F.lit(threshold) * F.col("source_assets"))
