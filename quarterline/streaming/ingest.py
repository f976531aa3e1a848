"""Incremental raw-CSV ingest with Structured Streaming, every row accounted for.

Files dropped into the landing folder are picked up in bounded micro-batches (``maxFilesPerTrigger``); an
``availableNow`` trigger processes the backlog and stops. Each batch writes three tables, all partitioned by
batch id and overwritten by partition, so a batch that runs again after a failure replaces what it left:

* the panel, rows of contracts with a readable time;
* the quarantine, the raw values of rows that were left out, and of rows kept with an unreadable number as
  NULL, each with its reason;
* the commits, one row per batch with its counts, written last. Readers see committed batches only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TARGETS
from ..session import ensure_utc

COMMIT = ("batch_id long, rows_read long, written long, no_id long, bad_time long, bad_number long")


def _put(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy(*parts).parquet(path))


def _committed(spark: SparkSession, commits: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT).parquet(commits)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ingest_batch(batch: DataFrame, batch_id: int, out: str, quarantine: str, commits: str, id_col: str, timestamp_col: str,
                 target_cols: Sequence[str]) -> None:
    """One micro-batch: parsed once into the quarantine and the panel, then committed."""
    spark = batch.sparkSession
    done = _committed(spark, commits)
    if done is not None and done.filter(F.col("batch_id") == batch_id).head(1):
        return  # it ended between its own commit and the stream's
    number = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in target_cols}
    bad_number = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() & x.isNull() for c, x in number.items()])
    ts = F.try_to_timestamp(F.col(timestamp_col))
    reason = F.when(F.col(id_col).isNull(), "no_id").when(ts.isNull(), "bad_time").when(bad_number, "bad_number")
    parsed = batch.select(F.lit(batch_id).cast("long").alias("batch_id"), F.col(id_col).alias("asset"), ts.alias("ts"),
                          *[x.alias(c) for c, x in number.items()], reason.alias("reason"), F.to_json(F.struct(*batch.columns)).alias("raw"))
    parsed = parsed.persist()
    try:
        left_out = F.coalesce(F.col("reason").isin("no_id", "bad_time"), F.lit(False))
        counts = parsed.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(~left_out).alias("written"),
                            *[F.count_if(F.col("reason") == r).alias(r) for r in ("no_id", "bad_time", "bad_number")]).first()
        if counts["written"] < counts["rows_read"] or counts["bad_number"]:
            _put(parsed.filter("reason IS NOT NULL").select("batch_id", "reason", (~left_out).alias("kept"), "raw"), quarantine, ["batch_id"])
        if counts["written"]:
            rows = parsed.filter(~left_out).select("batch_id", "asset", "ts", *target_cols)
            _put(rows.hint("rebalance", "asset").sortWithinPartitions("asset", "ts"), out, ["batch_id", "asset"])
        row = spark.createDataFrame([(batch_id, *[int(counts[c]) for c in ("rows_read", "written", "no_id", "bad_time", "bad_number")])], COMMIT)
        _put(row.coalesce(1), commits, ["batch_id"])
    finally:
        parsed.unpersist()


def stream_ingest_csv(spark: SparkSession, landing: str, out: str, checkpoint: str,
                      id_col: str = "ID", timestamp_col: str = "ExecutionTime",
                      target_cols: Sequence[str] = TARGETS, max_files_per_trigger: int = 1,
                      quarantine: str | None = None, commits: str | None = None) -> None:
    """Ingest the backlog of ``landing`` into ``out``; ``quarantine`` and ``commits`` lie beside it by default.

    The schema is the header line of the landing folder, so columns go by name; a file with another
    header stops the stream (``enforceSchema`` off) instead of moving its values to other columns."""
    ensure_utc(spark)
    cols = spark.read.option("header", True).csv(landing).columns
    missing = {id_col, timestamp_col, *target_cols} - set(cols)
    if missing:
        raise ValueError(f"no column {sorted(missing)} in the files of {landing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    src = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(landing))
    q_path, c_path = quarantine or quarantine_of(out), commits or commits_of(out)

    def sink(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, out, q_path, c_path, id_col, timestamp_col, target_cols)

    q = (src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def quarantine_of(out: str) -> str:
    return out.rstrip("/") + "-quarantine"


def commits_of(out: str) -> str:
    return out.rstrip("/") + "-commits"


def read_ingested(spark: SparkSession, out: str, commits: str | None = None, target_cols: Sequence[str] = TARGETS) -> DataFrame:
    """Rows of committed batches (asset, ts, targets); empty where every row was left out."""
    done = spark.read.schema(COMMIT).parquet(commits or commits_of(out)).select("batch_id")
    try:
        rows = spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("long"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([T.StructField("ts", T.TimestampType())]
                                                      + [T.StructField(c, T.DoubleType()) for c in target_cols]
                                                      + [T.StructField("asset", T.StringType())]))
    return rows.join(done, "batch_id", "left_semi").drop("batch_id")


def read_quarantine(spark: SparkSession, out: str, quarantine: str | None = None, commits: str | None = None) -> DataFrame:
    """(reason, kept, raw) of committed batches; empty where no row was refused."""
    schema = "batch_id long, reason string, kept boolean, raw string"
    done = spark.read.schema(COMMIT).parquet(commits or commits_of(out)).select("batch_id")
    try:
        rows = spark.read.schema(schema).parquet(quarantine or quarantine_of(out))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "reason string, kept boolean, raw string")
    return rows.join(done, "batch_id", "left_semi").drop("batch_id")


def ingest_totals(spark: SparkSession, out: str, commits: str | None = None) -> DataFrame:
    """One row: batches, rows_read, written and rows by reason; rows_read = written + no_id + bad_time."""
    c = spark.read.schema(COMMIT).parquet(commits or commits_of(out))
    names = ("rows_read", "written", "no_id", "bad_time", "bad_number")
    return c.agg(F.count(F.lit(1)).alias("batches"), *[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
