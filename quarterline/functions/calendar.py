"""Calendar and trading-state columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TARGETS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_trading(df_or_cols, rule: str = "sum") -> Column:
    """1 when the slot traded.

    rule="sum": high+low+close+volume > 0 with NULL as 0 (the reference code);
    rule="volume": volume > 0 (the reference documents).
    """
    if rule == "volume":
        return (F.coalesce(F.col("volume"), F.lit(0.0)) > 0).cast("int")
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in TARGETS), F.lit(0.0))
    return (total > 0).cast("int")


def with_is_trading(df: DataFrame, rule: str = "sum") -> DataFrame:
    """F8: keep an existing ``is_trading`` column, else derive it (volume rule for the fallback)."""
    if "is_trading" in df.columns:
        return df
    return df.withColumn("is_trading", is_trading(df, rule))


def calendar_columns(ts="ts") -> dict[str, Column]:
    """Hour, weekday (Mon=0), ISO week, month, weekend flag."""
    t = _col(ts)
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": F.weekday(t),
        "week_of_year": F.weekofyear(t),
        "month": F.month(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
    }


def minute_of_day(ts="ts") -> Column:
    """minutes since midnight."""
    t = _col(ts)
    return F.hour(t) * 60 + F.minute(t)


def daylight_indicator(ts="ts") -> Column:
    """crude daylight proxy from month and hour (1 = daylight).

    Summer months (Apr-Sep) 06:00-20:59, other months 08:00-16:59.
    """
    t = _col(ts)
    summer = F.month(t).between(4, 9)
    h = F.hour(t)
    return F.when(summer, h.between(6, 20)).otherwise(h.between(8, 16)).cast("int")
