"""Result and dataset sinks."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import apply_strategy
from ..operators.segments import trading_segments
from .csv_ingest import write_panel


def write_json_report(df: DataFrame, path: str) -> None:
    """A (small) result table as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_report(spark: SparkSession, path: str, default: dict | None = None,
                     schema: str | None = None, multiline: bool = False) -> DataFrame:
    """JSON config / result source with a default row when the file is missing.

    ``multiline=True`` for hand-written config files holding one JSON document."""
    try:
        r = spark.read.option("multiLine", multiline)
        if schema:
            r = r.schema(schema)
        df = r.json(path)
        if df.head(1):
            return df
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    default = default or {}
    if schema:
        return spark.createDataFrame([tuple(default.get(f.strip().split()[0]) for f in schema.split(","))], schema)
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(default)]))


def write_split(df: DataFrame, out: str) -> None:
    """Train / val (/ test) rows written per split and contract; empty sets write nothing."""
    write_panel(df, out, extra_partitions=("split",))


def write_trading_segments(df: DataFrame, out: str, min_segment_length: int = 96,
                           assets: Sequence[str] | None = None, chunk_seconds: int | None = None) -> DataFrame:
    """Keep rows of trading segments >= min length, optional contract list. Segments are found
    in each split on its own: none runs across a split's edge."""
    d = df
    if assets is not None:
        keep = df.sparkSession.createDataFrame([(a,) for a in assets], "asset string")
        d = d.join(F.broadcast(keep), "asset", "left_semi")  # explicit list
    split = ("split",) if "split" in d.columns else ()
    seg = trading_segments(d, min_segment_length, (*split, "asset"), chunk_seconds).drop("change", "segment_length")
    write_panel(seg, out, extra_partitions=split)
    return seg


def write_subsampled(df: DataFrame, out: str, strategy: str,
                     splits: Sequence[str] = ("train", "val"), **kwargs) -> tuple[DataFrame, DataFrame]:
    """A strategy applied to every contract of every split (each split sampled on its
    own, like one file per contract and split), one write, and the report: rows and
    contracts per split, plus the contracts skipped (no rows after sampling)."""
    parts = ["split"] if "split" in df.columns else []
    if parts:  # one pass: every window of the strategy is keyed by (split, asset)
        s = apply_strategy(df.filter(F.col("split").isin(list(splits))), strategy, keys=("split", "asset"), **kwargs)
    else:
        s = apply_strategy(df, strategy, **kwargs)
    write_panel(s, out, extra_partitions=tuple(parts))
    written = df.sparkSession.read.schema(s.schema).parquet(out)  # there may be no row and so no file
    by_split = written.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"),
                                           F.count_distinct("asset").alias("assets"))
    skipped = df.select(*parts, "asset").distinct().join(written.select(*parts, "asset").distinct(), [*parts, "asset"], "left_anti")
    return by_split, skipped


def subsample_report(df: DataFrame, by_split: DataFrame, skipped: DataFrame) -> DataFrame:
    """S19, one row per split of ``df``: contracts processed and rows written, and the sorted list of those skipped."""
    lost = skipped.groupBy("split").agg(F.array_sort(F.collect_list("asset")).alias("skipped"))  # contract names
    every = df.select("split").distinct().join(by_split, "split", "left").join(lost, "split", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return every.select("split", zero("assets").alias("processed"), zero("rows").alias("rows"),
                        F.concat_ws(",", F.coalesce("skipped", F.array().cast("array<string>"))).alias("skipped"))


def export_forecasts_csv(forecasts: DataFrame, out: str) -> None:
    """Forecast export as CSV with a header."""
    forecasts.write.mode("overwrite").option("header", True).csv(out)
