"""Candle builders (T2 batch twin) and the dense panel grid.

Ticks -> HLCV candles per (asset, bucket) is a plain ``groupBy`` whose partial
aggregation combines map-side, so a hot contract never lands whole in one task.
The dense grid is generated with ``spark.range`` (distributed, no cross join)
and equi-joined to the asset dimension by index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contracts import contract_name_for_int
from ..functions.joins import join_small
from ..functions.ordering import time_seq_key
from ..schema import TARGETS
from ..session import ensure_utc, materialize


def bucket_start(ts, seconds: int) -> Column:
    """Start of the fixed-width bucket (epoch aligned) containing ``ts``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_seconds(F.floor(F.unix_seconds(t) / F.lit(seconds)).cast("long") * F.lit(seconds))


def candles(ticks: DataFrame, asset: str, ts: str, price: str, tiebreak: Sequence[str],
            bucket_seconds: int, volume: Column | None = None) -> DataFrame:
    """One HLCV candle per (asset, bucket).

    close = price of the last tick, ordered by (ts, *tiebreak) so the result is order-free;
    volume defaults to the tick count. With one integral tie-break column the order is the
    packed DECIMAL key (fixed-width buffer: hash aggregate, no map-side sort); longer
    tie-breaks fall back to a struct order (sort aggregate).
    """
    if len(tiebreak) == 1 and dict(ticks.dtypes).get(tiebreak[0]) in ("bigint", "int", "smallint", "tinyint"):
        order = time_seq_key(ts, tiebreak[0])
    else:
        order = F.struct(*[F.col(c) for c in (ts, *tiebreak)])
    vol = volume if volume is not None else F.count(F.lit(1)).cast("double")
    return (ticks
            .filter(F.col(asset).isNotNull() & F.col(ts).isNotNull())
            .withColumn("_bucket", bucket_start(ts, bucket_seconds))
            .groupBy(F.col(asset).alias("asset"), F.col("_bucket").alias("ts"))
            .agg(F.max(price).cast("double").alias("high"),
                 F.min(price).cast("double").alias("low"),
                 F.max_by(F.col(price), order).cast("double").alias("close"),
                 vol.alias("volume")))


def asset_index(assets: DataFrame) -> DataFrame:
    """(asset, idx) with idx = rank of the name; runs on the small asset dimension only."""
    from pyspark.sql import Window
    return assets.select("asset").distinct().withColumn(
        "idx", (F.row_number().over(Window.orderBy("asset")) - 1).cast("long"))


def densify(candle_df: DataFrame, step_seconds: int) -> DataFrame:
    """Every asset on every slot from the global first to last bucket; missing -> 0.

    ``candle_df`` should be materialised (its bounds and asset list are read once).
    """
    spark = candle_df.sparkSession
    # one small job: global bounds and the number of contracts
    b = candle_df.agg(F.min(F.unix_seconds("ts")).alias("lo"), F.max(F.unix_seconds("ts")).alias("hi"),
                      F.count_distinct("asset").alias("n")).first()
    n_assets = int(b["n"])
    if b["lo"] is None or n_assets == 0:
        return candle_df.limit(0)
    dim = asset_index(candle_df)
    n_slots = (b["hi"] - b["lo"]) // step_seconds + 1
    grid = (spark.range(0, n_assets * n_slots)
            .select((F.col("id") / F.lit(n_slots)).cast("long").alias("idx"),
                    F.timestamp_seconds(F.lit(b["lo"]) + (F.col("id") % n_slots) * F.lit(step_seconds)).alias("ts")))
    grid = join_small(grid, dim, on="idx", how="inner", known_rows=n_assets).drop("idx")
    # the join deals both sides by (asset, ts): even, whatever a contract holds
    panel = grid.join(candle_df, on=["asset", "ts"], how="left").fillna(0.0, subset=list(TARGETS))
    return panel.select("asset", "ts", *TARGETS)


def events_candles(spark: SparkSession, sf_dir: str, bucket_seconds: int = 3600,
                   n_contracts: int = 24) -> DataFrame:
    """FX1 candles: ``events`` ticks, contract = name(user_id mod n), volume = tick count."""
    ensure_utc(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "value")
    ticks = ev.select(
        contract_name_for_int(F.pmod(F.col("user_id"), F.lit(n_contracts))).alias("asset"),
        F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    return candles(ticks, "asset", "ts", "value", ["event_id"], bucket_seconds)


def events_panel(spark: SparkSession, sf_dir: str, bucket_seconds: int = 3600,
                 n_contracts: int = 24) -> DataFrame:
    """FX1 panel: events candles on the dense grid (checkpointed once, then reused)."""
    key = ("events", sf_dir, bucket_seconds, n_contracts, _stamp(spark, sf_dir, "events"))
    cached = _PANELS.get((_app(spark), key))
    if cached is not None:
        return cached
    c = materialize(events_candles(spark, sf_dir, bucket_seconds, n_contracts))
    panel = materialize(densify(c, bucket_seconds))
    _PANELS[(_app(spark), key)] = panel
    return panel


def brand_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2 daily candles: ``lineitem`` joined to ``part``; contract = name(brand number).

    (l_orderkey, l_linenumber) is not unique in the driver tables, hence the long tie-break.
    """
    ensure_utc(spark)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand")
    ticks = (li.join(part, li.l_partkey == part.p_partkey, "inner")
             .select(contract_name_for_int(
                         F.expr("try_cast(regexp_extract(p_brand, '(\\\\d+)$', 1) AS INT)")).alias("asset"),
                     F.col("l_shipdate").cast("timestamp").alias("ts"),
                     "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))
    return candles(ticks, "asset", "ts", "l_extendedprice",
                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
                   86400, volume=F.sum("l_quantity").cast("double"))


def brand_panel(spark: SparkSession, sf_dir: str, dense: bool = True) -> DataFrame:
    key = ("brand", sf_dir, dense, _stamp(spark, sf_dir, "lineitem", "part"))
    cached = _PANELS.get((_app(spark), key))
    if cached is not None:
        return cached
    c = materialize(brand_candles(spark, sf_dir))
    panel = materialize(densify(c, 86400)) if dense else c
    _PANELS[(_app(spark), key)] = panel
    return panel


def hot_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3: one-minute candles that are not densified; one contract holds more than a third of the rows.

    ``events`` ticks, contract = name(0) for users divisible by 3, else name(user_id mod 24). Clicks, purchases
    and signups are trades, other events only quotes: volume counts trades, and slots without any do not trade."""
    key = ("hot", sf_dir, _stamp(spark, sf_dir, "events"))
    cached = _PANELS.get((_app(spark), key))
    if cached is not None:
        return cached
    ensure_utc(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    number = F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.pmod(F.col("user_id"), F.lit(24)))
    ticks = ev.select(contract_name_for_int(number).alias("asset"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value",
                      F.col("event_type").isin("click", "purchase", "signup").alias("trade"))
    panel = candles(ticks, "asset", "ts", "value", ["event_id"], 60, volume=F.count_if("trade").cast("double"))
    panel = materialize(panel.withColumn("is_trading", (F.col("volume") > 0).cast("int")))
    _PANELS[(_app(spark), key)] = panel
    return panel


# Materialised panels per (session, source): built once per session and reused by every
# query over the same fixture, like a written table.
_PANELS: dict = {}


def _stamp(spark: SparkSession, sf_dir: str, *tables: str) -> tuple:
    """Files, bytes and latest change of the tables: a panel is not used again after they change."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in tables])
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first())


def _app(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def clear_panel_cache() -> None:
    _PANELS.clear()
