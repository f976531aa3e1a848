"""Rolling contexts by a sorted window, and scores of many forecasters in one pass.

Rows are dealt to (series, chunk of positions) groups; a chunk also gets the rows of the longest context before
it, so groups are bounded and no group holds a whole contract. In a group every context length keeps its values
in a sorted window: a new value is put in at its place and the oldest taken out, each found by bisection, so a
row's cost grows with the logarithm of the length, and all quantile levels are read off by index. No array is
collected or sorted per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TARGETS

CHUNK_ROWS = 4096


def window_types():
    """(SortedWindow, LastNonZero), made here so that they travel to the workers by value."""

    class SortedWindow:
        """The last ``length`` values (None and NaN take a place but no value), sorted."""

        def __init__(self, length: int):
            from collections import deque
            self.length, self.recent, self.sorted = length, deque(), []

        def push(self, value: float | None) -> None:
            from bisect import bisect_left, insort
            if value is not None and value != value:
                value = None
            self.recent.append(value)
            if value is not None:
                insort(self.sorted, value)
            if len(self.recent) > self.length:
                old = self.recent.popleft()
                if old is not None:
                    del self.sorted[bisect_left(self.sorted, old)]

        def quantile(self, q: float) -> float | None:
            """Linear interpolation between the neighbouring values; None without any."""
            a = self.sorted
            if not a:
                return None
            at = q * (len(a) - 1)
            lo = int(at)
            if lo == at:
                return a[lo]
            return (lo + 1 - at) * a[lo] + (at - lo) * a[lo + 1]

    class LastNonZero:
        """The last value that is neither None nor 0 among the last ``length``; 0.0 if there is none."""

        def __init__(self, length: int):
            self.length, self.value, self.at, self.n = length, 0.0, None, 0

        def push(self, value: float | None) -> None:
            if value is not None and value != 0:
                self.value, self.at = value, self.n
            self.n += 1

        def get(self) -> float:
            return self.value if self.at is not None and self.n - self.at <= self.length else 0.0

    return SortedWindow, LastNonZero


def with_places(df: DataFrame, keys: Sequence[str] = ("asset",), chunk_seconds: int | None = None) -> DataFrame:
    """``pos`` (0-based place in the series) and ``n_rows``; in (series, chunk) tasks with ``chunk_seconds``."""
    if chunk_seconds:
        from .chunks import with_position_chunked
        d = with_position_chunked(df, "pos", keys, chunk_seconds)
        return d.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")), list(keys))  # one row per series
    w = Window.partitionBy(*keys)
    return df.withColumns({"pos": (F.row_number().over(w.orderBy("ts")) - 1).cast("long"), "n_rows": F.count(F.lit(1)).over(w)})


def rolling_context(df: DataFrame, lengths: Sequence[int], levels: Sequence[float], targets: Sequence[str] = TARGETS,
                    keys: Sequence[str] = ("asset",), horizon: int = 0, chunk_rows: int = CHUNK_ROWS,
                    carry: Sequence[str] = ()) -> DataFrame:
    """For every row (with ``pos``) and each context length L: ``q<L>_<target>`` (quantiles at ``levels``) and
    ``f<L>_<target>`` (last non-zero value, else 0) of the last L rows, the row itself included. With ``horizon`` also
    ``next``, the next rows' (ts, is_trading as m, targets, ``carry`` columns) as an array of at most that many.

    NULL and NaN values count as missing; a context without a value has NULL quantiles."""
    back, n_chunk = max(lengths) - 1, max(chunk_rows, max(lengths), horizon + 1)
    place = F.col("pos") % n_chunk
    chunk = F.floor(F.col("pos") / n_chunk).cast("long")
    to = F.array_compact(F.array(chunk, F.when(place >= n_chunk - back, chunk + 1),
                                 F.when((place < horizon) & (chunk > 0), chunk - 1)))
    cols, lengths, levels, targets = list(df.columns), list(lengths), [float(q) for q in levels], list(targets)
    new = [T.StructField(f"q{n}_{t}", T.ArrayType(T.DoubleType())) for n in lengths for t in targets]
    new += [T.StructField(f"f{n}_{t}", T.DoubleType()) for n in lengths for t in targets]
    if horizon:
        step = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("m", T.DoubleType()),
                             *[T.StructField(t, T.DoubleType()) for t in (*targets, *carry)]])
        new.append(T.StructField("next", T.ArrayType(step)))
    schema = T.StructType([*df.schema.fields, *new])
    SortedWindow, LastNonZero = window_types()

    def run(key, table):
        import pyarrow as pa
        table = table.sort_by("pos")
        first = key[-1].as_py() * n_chunk
        pos = table.column("pos").to_numpy()
        own = (pos >= first) & (pos < first + n_chunk)
        out = {}
        for t in targets:
            values = table.column(t).cast(pa.float64()).to_pylist()
            for n in lengths:
                window, last = SortedWindow(n), LastNonZero(n)
                q, f = [], []
                for v, mine in zip(values, own.tolist()):
                    window.push(v)
                    last.push(v)
                    if mine:
                        q.append([window.quantile(x) for x in levels])
                        f.append(last.get())
                out[f"q{n}_{t}"], out[f"f{n}_{t}"] = pa.array(q, pa.list_(pa.float64())), pa.array(f, pa.float64())
        mine = table.filter(pa.array(own)).select(cols)
        for f in new:
            if f.name != "next":
                mine = mine.append_column(f.name, out[f.name])
        if horizon:
            steps = pa.StructArray.from_arrays([table.column("ts").combine_chunks(), table.column("is_trading").cast(pa.float64()).combine_chunks(),
                                                *[table.column(t).cast(pa.float64()).combine_chunks() for t in (*targets, *carry)]],
                                              ["ts", "m", *targets, *carry])
            at = [k for k, m in enumerate(own.tolist()) if m]
            ends = [min(k + 1 + horizon, len(pos)) for k in at]
            bounds = [0]
            for k, e in zip(at, ends):
                bounds.append(bounds[-1] + e - k - 1)
            take = pa.array([i for k, e in zip(at, ends) for i in range(k + 1, e)], pa.int64())
            mine = mine.append_column("next", pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), steps.take(take)))
        return mine

    dealt = df.withColumn("_c", F.explode(to))
    return dealt.groupBy(*keys, "_c").applyInArrow(lambda key, table: run(key, table), schema)


def _errors(next_: Column, target: str, p: Column, eps: float) -> Column:
    """Sum over the steps of m * 2 |y - p| / (|y| + |p| + eps), as the masked score's numerator."""
    return F.aggregate(next_, F.lit(0.0), lambda a, x: a + F.coalesce(
        x["m"] * 2.0 * F.abs(x[target] - p) / (F.abs(x[target]) + F.abs(p) + F.lit(eps)), F.lit(0.0)))


def score_contexts(df: DataFrame, lengths: Sequence[int], levels: Sequence[float], horizon: int = 10, keys: Sequence[str] = ("asset",),
                   by: Sequence[str] = (), targets: Sequence[str] = TARGETS, eps: float = 1e-6, chunk_seconds: int | None = None,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Scores of the naive and the quantile-median forecaster for every context length in one pass over the rows:
    (by..., forecaster, max_context_length, target, err, weight, n), one row per origin counted in n.

    Every row with L - 1 rows before it and ``horizon`` rows after it in its series is an origin for length L. All
    forecasts are columns of the row, so nothing is joined and no branch reads the rows again; sMAPE of any rollup is
    sum(err) / sum(weight)."""
    placed = with_places(df, keys, chunk_seconds)
    # a series without an origin for any length need not go through the groups
    placed = placed.filter(F.col("n_rows") >= min(lengths) + horizon)
    d = rolling_context(placed, lengths, levels, targets, keys, horizon, chunk_rows)
    median = len(levels) // 2 + 1
    models = []
    for n in lengths:
        origin = (F.col("pos") >= n - 1) & (F.col("n_rows") >= n + horizon)
        for name, p in (("naive", lambda t, n=n: F.col(f"f{n}_{t}")), ("quantile_median", lambda t, n=n: F.element_at(f"q{n}_{t}", median))):
            each = F.array(*[F.struct(F.lit(t).alias("target"), _errors(F.col("next"), t, p(t), eps).alias("e")) for t in targets])
            models.append(F.when(origin, F.struct(F.lit(name).alias("forecaster"), F.lit(n).alias("max_context_length"), each.alias("errs"))))
    weight = F.aggregate("next", F.lit(0.0), lambda a, x: a + x["m"])
    rows = (d.filter(F.col("pos") + horizon < F.col("n_rows"))
            .select(*by, weight.alias("w"), F.explode(F.array_compact(F.array(*models))).alias("_m")))
    long = rows.select(*by, "w", "_m.forecaster", "_m.max_context_length", F.inline("_m.errs"))
    return long.groupBy(*by, "forecaster", "max_context_length", "target").agg(
        F.sum("e").alias("err"), F.sum("w").alias("weight"), F.count(F.lit(1)).alias("n"))


def smape_of(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., smape, n): the element-weighted masked sMAPE of a rollup of :func:`score_contexts`."""
    s = F.coalesce(F.try_divide(F.sum("err"), F.nullif(F.sum("weight"), F.lit(0.0))), F.lit(0.0))
    return scores.groupBy(*by).agg(s.alias("smape"), F.sum("n").alias("n"))
