"""quarterline: Spark-native analytics for panels of quarter-hour delivery contracts."""

__version__ = "0.1.0"
