"""Schemas and parameter records of the contract panel."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TARGETS = ("high", "low", "close", "volume")


PANEL = T.StructType([
    T.StructField("asset", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    *[T.StructField(c, T.DoubleType()) for c in TARGETS],
])

SCALER = T.StructType([
    T.StructField("asset", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("scale", T.DoubleType()),
    T.StructField("n", T.LongType()),
])

FORECAST = T.StructType([
    T.StructField("window_id", T.LongType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("target", T.StringType()),
    T.StructField("quantile", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

TRIAL = T.StructType([
    T.StructField("study", T.StringType()),
    T.StructField("trial", T.IntegerType()),
    T.StructField("state", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("lr", T.DoubleType()),
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("max_context_length", T.IntegerType()),
])

STRATEGY_RESULT = T.StructType([
    T.StructField("strategy", T.StringType()),
    T.StructField("training_time_minutes", T.DoubleType()),
    T.StructField("epochs_trained", T.IntegerType()),
    T.StructField("val_loss", T.DoubleType()),
    T.StructField("converged", T.BooleanType()),
    T.StructField("success", T.BooleanType()),
])

EPOCH_LOSS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("phase", T.StringType()),
    T.StructField("loss", T.DoubleType()),
])


@dataclass(frozen=True)
class WindowParams:
    """Supervised-window options (defaults of the reference dataset)."""
    input_chunk_length: int = 96
    output_chunk_length: int = 10
    stride: int = 1
    target_cols: tuple = TARGETS
    min_length: int | None = None
    contiguous: bool = False

    @property
    def min_rows(self) -> int:
        return self.min_length or (self.input_chunk_length + self.output_chunk_length)


@dataclass(frozen=True)
class FeatureParams:
    num_surrounding: int = 6
    order: str = "name"          # "name" (reference) or "delivery"
    side: str = "next_first"     # which neighbour fills adj_k: next_first | prev | next
    trading_rule: str = "sum"    # "sum" of HLCV > 0 (code) or "volume" > 0 (docs)
    fill_value: float = -1.0
    neighbour_extra: tuple = ()  # e.g. ("high", "low")
    ffill_chunk_seconds: int | None = None  # two-phase as-of fill split into time chunks


# Quantile level sets offered to the quantile forecaster.
QUANTILE_SETS = {
    "small": [0.1, 0.5, 0.9],
    "medium": [0.05, 0.25, 0.5, 0.75, 0.95],
    "large": [0.1, 0.25, 0.5, 0.75, 0.9],
}


