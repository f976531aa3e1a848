"""Cleaning and column-selection helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TARGETS

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)

FEATURE_MARKERS = ("adj", "cross_contract", "nearest_liquid")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_to_null(c) -> Column:
    """0 -> NULL (``replace(0, nan)``)."""
    return F.nullif(_col(c), F.lit(0.0))


def non_finite_to_null(c) -> Column:
    """NaN and +-inf -> NULL."""
    x = _col(c)
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(x)


def loss_for_ranking(c) -> Column:
    """a missing or non-finite loss ranks last (+inf)."""
    return F.coalesce(non_finite_to_null(c), F.lit(float("inf")))


def numeric_columns(df: DataFrame) -> list[str]:
    """columns of numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def covariate_columns(df: DataFrame, targets: Sequence[str] = TARGETS,
                      time_col: str = "ts", flag_col: str = "is_trading",
                      key_cols: Sequence[str] = ("asset", "split")) -> list[str]:
    """every column except targets, the time column, the trading flag and keys."""
    skip = set(targets) | {time_col, flag_col} | set(key_cols)
    return [c for c in df.columns if c not in skip]


def mask_when_not_trading(df: DataFrame, cols: Iterable[str], flag: str = "is_trading") -> DataFrame:
    """engineered features -> NULL where the contract itself is not trading."""
    cols = list(cols)
    return df.withColumns({c: F.when(F.col(flag) == 1, F.col(c)) for c in cols})


def fill_missing(df: DataFrame, value: float = -1.0, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL -> sentinel (applied as the last projection only)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return df.fillna(value, subset=cols)


def clean_numeric(df: DataFrame, cols: Iterable[str] | None = None, to_float: bool = False) -> DataFrame:
    """F15 (+F16): non-finite -> NULL, optional float32 cast."""
    cols = list(cols) if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    exprs = {}
    for c in cols:
        e = non_finite_to_null(c)
        exprs[c] = e.cast("float") if to_float else e
    return df.withColumns(exprs)


def drop_time_zone(df: DataFrame, ts: str = "ts") -> DataFrame:
    """wall-clock timestamp without zone (under the UTC session clock)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def resolve_alias(df: DataFrame, candidates: Sequence[str], canonical: str) -> DataFrame:
    """rename the first present of ``candidates`` to ``canonical``."""
    for c in candidates:
        if c in df.columns:
            return df if c == canonical else df.withColumnRenamed(c, canonical)
    raise KeyError(f"none of {list(candidates)} in {df.columns}")


def mask_or_ones(df: DataFrame, mask_col: str = "mask") -> Column:
    """mask column, or 1.0 everywhere when absent."""
    if mask_col in df.columns:
        return F.coalesce(F.col(mask_col).cast("double"), F.lit(1.0))
    return F.lit(1.0)


def pct(part, whole) -> Column:
    """100 * part / whole, NULL when whole is 0."""
    return F.lit(100.0) * F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def reduction_pct(part, whole) -> Column:
    """100 * (1 - part / whole)."""
    return F.lit(100.0) * (F.lit(1.0) - F.try_divide(_col(part).cast("double"), _col(whole).cast("double")))
