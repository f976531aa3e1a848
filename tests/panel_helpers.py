"""Paths of the driver tables and a builder for hand-made panels (a plain module: nothing imports a conftest)."""

from datetime import datetime

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def panel_df(spark, rows, cols="asset string, ts timestamp, high double, low double, close double, volume double"):
    conv = [tuple(datetime.fromisoformat(v) if isinstance(v, str) and v[:2] == "20" and ":" in v else v for v in r)
            for r in rows]
    return spark.createDataFrame(conv, cols)
