"""Period splits (P6, P9, F20) and liquidity buckets (P10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def split_by_years(df: DataFrame, train_years: Sequence[int] = (2021, 2022),
                   val_years: Sequence[int] = (2023,), test_years: Sequence[int] = (),
                   ts: str = "ts") -> DataFrame:
    """``split`` column from year sets; rows of other years are dropped.

    Features are computed before the split, so state carries over the boundary.
    """
    y = F.year(ts)
    split = F.when(y.isin(list(train_years)), F.lit("train")).when(y.isin(list(val_years)), F.lit("val"))
    if test_years:
        split = split.when(y.isin(list(test_years)), F.lit("test"))
    return df.withColumn("split", split).filter(F.col("split").isNotNull())


def split_by_dates(df: DataFrame, val_start: str, test_start: str | None = None,
                   train_start: str | None = None, ts: str = "ts") -> DataFrame:
    """Date-boundary split for data inside one year: [train_start, val_start) train,
    [val_start, test_start) val, [test_start, ...) test."""
    t = F.col(ts)
    split = F.when(t < F.to_timestamp(F.lit(val_start)), F.lit("train"))
    if test_start:
        split = split.when(t < F.to_timestamp(F.lit(test_start)), F.lit("val")).otherwise(F.lit("test"))
    else:
        split = split.otherwise(F.lit("val"))
    out = df.withColumn("split", split)
    if train_start:
        out = out.filter(t >= F.to_timestamp(F.lit(train_start)))
    return out


def liquidity_buckets(df: DataFrame, top: float = 0.2, bottom: float = 0.2,
                      picks: Sequence[int] = (3, 3, 2)) -> DataFrame:
    """P10: liquidity per asset, bucket top 20 % / mid 60 % / bottom 20 % by rank,
    and the first ``picks`` assets of each bucket (most liquid first) as representatives.

    Runs on the per-asset summary (one row per contract), never on the panel.
    """
    liq = df.groupBy("asset").agg(F.avg("is_trading").alias("liquidity"))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    r = F.row_number().over(Window.orderBy(F.desc("liquidity"), "asset"))
    liq = liq.withColumn("_rank", r).withColumn("_n", n)
    top_n = F.ceil(F.col("_n") * F.lit(top))
    bot_n = F.ceil(F.col("_n") * F.lit(bottom))
    bucket = (F.when(F.col("_rank") <= top_n, F.lit("top"))
              .when(F.col("_rank") > F.col("_n") - bot_n, F.lit("bottom"))
              .otherwise(F.lit("mid")))
    liq = liq.withColumn("bucket", bucket)
    within = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("liquidity"), "asset"))
    quota = (F.when(F.col("bucket") == "top", F.lit(picks[0]))
             .when(F.col("bucket") == "mid", F.lit(picks[1])).otherwise(F.lit(picks[2])))
    return (liq.withColumn("bucket_rank", within)
               .withColumn("representative", (F.col("bucket_rank") <= quota).cast("int"))
               .select("asset", "liquidity", "bucket", "bucket_rank", "representative"))


# Seasons in order of month mod 12, three months each.
SEASONS = ("winter", "spring", "summer", "autumn")


def seasonal_blocks(df: DataFrame, block_days: int = 28, per_season: int = 1, seed: int = 827) -> DataFrame:
    """P10: rows of whole blocks of ``block_days`` days (numbered from the epoch), ``per_season`` of every contract
    and season, chosen by ``md5(seed | asset | block)``; adds ``season`` and ``block``.

    A block counts if all its days have rows and lie in one season. The choice is made on the index of (contract,
    block), never on the panel's rows; a season with fewer blocks gives those it has.
    """
    day = F.floor(F.unix_seconds("ts") / 86400).cast("long")
    number = F.floor((F.month("ts") % 12) / 3).cast("int")
    d = df.withColumns({"block": F.floor(day / block_days).cast("long"), "_season": number})
    index = d.groupBy("asset", "block").agg(F.min("_season").alias("_s"), F.max("_season").alias("_t"), F.count_distinct(day).alias("_days"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("asset"), F.col("block").cast("string")))
    rank = F.row_number().over(Window.partitionBy("asset", "_s").orderBy(key))
    chosen = index.filter((F.col("_s") == F.col("_t")) & (F.col("_days") == block_days)).withColumn("_n", rank).filter(F.col("_n") <= per_season)
    rows = d.join(chosen.select("asset", "block"), ["asset", "block"], "left_semi")
    return rows.withColumn("season", F.element_at(F.array(*[F.lit(x) for x in SEASONS]), F.col("_season") + 1)).drop("_season")
