"""Linear learners from normal equations (R14, R15, A23): one pass of partial aggregates, solved once.

Every model of a study (per target, step, seed) is a group of one aggregation: its matrix of weighted products
is summed map-side, and only the matrices reach the driver, as many as there are models. Solving them there is
the same as fitting each model on all its rows; predictions are expressions again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TARGETS


def normal_sums(rows: DataFrame, keys: Sequence[str], inputs: Sequence[str], y: str = "y", weight: str = "m") -> DataFrame:
    """(keys, n, sums): sums of w z_i z_j for z = (1, inputs..., y), i <= j in order of rows, as an array. Rows
    with a NULL among z or without weight do not count."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in inputs], F.col(y).cast("double")]
    w = F.col(weight).cast("double")
    used = rows.filter((w > 0) & ~F.greatest(*[F.col(c).isNull().cast("int") for c in (*inputs, y)]).cast("boolean"))
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    g = used.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(w * z[i] * z[j]).alias(f"_s{k}") for k, (i, j) in enumerate(pairs)])
    return g.select(*keys, "n", F.array(*[f"_s{k}" for k in range(len(pairs))]).alias("sums"))


def solve_ridge(sums: DataFrame, keys: Sequence[str], n_inputs: int, penalty: float = 1.0) -> DataFrame:
    """(keys, coef): intercept and coefficients that minimise sum w (y - a - b.x)^2 + penalty |b|^2 per model.

    The rows of ``sums`` are collected: one small matrix per model."""
    import numpy as np
    p = n_inputs + 2
    i, j = np.triu_indices(p)
    out = []
    for r in sums.collect():
        m = np.zeros((p, p))
        m[i, j] = m[j, i] = r["sums"]
        a, b = m[:-1, :-1].copy(), m[:-1, -1]
        a[np.arange(1, p - 1), np.arange(1, p - 1)] += penalty
        out.append((*[r[k] for k in keys], [float(v) for v in np.linalg.lstsq(a, b, rcond=None)[0]]))
    kinds = dict(sums.dtypes)
    return sums.sparkSession.createDataFrame(out, ", ".join([*[f"{k} {kinds[k]}" for k in keys], "coef array<double>"]))


def predicted(rows: DataFrame, coefs: DataFrame, keys: Sequence[str], inputs: Sequence[str], name: str = "p") -> DataFrame:
    """Adds each row's prediction by its model (a row per model, so their number is known to be small)."""
    value = F.element_at("coef", 1)
    for k, c in enumerate(inputs):
        value = value + F.element_at("coef", k + 2) * F.col(c)
    return rows.join(F.broadcast(coefs), list(keys)).withColumn(name, value).drop("coef")


def bag_weight(seed: Column, *parts: str) -> Column:
    """How often a bootstrap draw of ``seed`` takes a row: 0, 1, 2 or 3 by the first hex digit of a hash (6, 6, 3 and 1
    of 16), the same in every engine."""
    digit = F.substring(F.md5(F.concat_ws("|", seed.cast("string"), *[F.col(p).cast("string") for p in parts])), 1, 1)
    return F.when(digit < "6", 0.0).when(digit < "c", 1.0).when(digit < "f", 2.0).otherwise(3.0)


def direct_table(df: DataFrame, lags: int = 8, horizon: int = 10, context: int = 24, keys: Sequence[str] = ("asset",), extra: Sequence[str] = (),
                 targets: Sequence[str] = TARGETS) -> DataFrame:
    """R14, training table keyed by (target, h): one row per origin, target and step with the last ``lags`` values of the
    target (lag_1 the origin's own), sine and cosine of the origin's hour, ``x_<extra>`` columns, the label y and its
    mask m. Origins have ``context`` rows up to them and ``horizon`` rows after them in their series (``keys``).

    ``df`` has ``idx`` (order of the contract). ``extra`` names columns per target, ``<name>_<target>``."""
    w = Window.partitionBy(*keys).orderBy("ts")
    step = F.struct(F.col("is_trading").cast("double").alias("m"), F.col("ts").alias("ts"), *targets)
    d = df.withColumns({"pos": (F.row_number().over(w) - 1).cast("long"), "_next": F.collect_list(step).over(w.rowsBetween(1, horizon))})
    d = d.withColumns({f"_lag{k}_{t}": F.lag(t, k - 1).over(w) for k in range(1, lags + 1) for t in targets})
    d = d.filter((F.col("pos") >= context - 1) & (F.size("_next") == horizon))
    hour = F.hour("ts") * F.lit(3.141592653589793 / 12)
    start = F.col("pos") - (context - 1)

    def labels(t: str) -> Column:
        return F.transform("_next", lambda x: F.struct(x["m"].alias("m"), x["ts"].alias("ts"), x[t].alias("y")))

    each = F.array(*[F.struct(F.lit(t).alias("target"), *[F.col(f"_lag{k}_{t}").alias(f"lag_{k}") for k in range(1, lags + 1)],
                              *[F.col(f"{e}_{t}").alias(f"x_{e}") for e in extra],
                              labels(t).alias("steps")) for t in targets])
    one = d.select(*keys, start.alias("start_pos"), (F.col("idx") * F.lit(1 << 32) + start).alias("window_id"),
                   F.sin(hour).alias("hour_sin"), F.cos(hour).alias("hour_cos"), F.inline(each))
    cols = [c for c in one.columns if c != "steps"]
    return (one.select(*cols, F.posexplode("steps").alias("_h", "_s"))
            .select(*cols, (F.col("_h") + 1).cast("int").alias("h"), F.col("_s.ts").alias("target_ts"), F.col("_s.m").alias("m"), F.col("_s.y").alias("y")))


def direct_inputs(lags: int = 8, extra: Sequence[str] = ()) -> list[str]:
    return [*[f"lag_{k}" for k in range(1, lags + 1)], "hour_sin", "hour_cos", *[f"x_{e}" for e in extra]]
