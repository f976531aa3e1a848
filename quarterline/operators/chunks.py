"""Per-contract scans in (contract, time chunk) tasks, for contracts too large for one task.

A window ``partitionBy(asset).orderBy(ts)`` puts all rows of a contract into one task. Here rows are dealt by
contract and time chunk; each chunk is reduced to one summary row, and only the summaries are scanned along a
contract: a prefix scan tells every chunk what lies before it, a suffix scan what lies behind it. Rows then
combine what they see inside their chunk with these carries. Results equal those of the whole window.

A chunk of ``chunk_seconds`` holds at most that many seconds' worth of candles, and a contract has as many
summaries as its time span has chunks, so both are bounded by time, not by the number of rows in the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import with_is_trading
from ..functions.cleaning import non_finite_to_null

#: Thirty days: 2,880 quarter hours per task group.
CHUNK_SECONDS = 30 * 86400

Step = Callable[[Column, Column], Column]


def with_chunk(df: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.unix_seconds("ts") / F.lit(chunk_seconds)).cast("long"))


def in_chunk(keys: Sequence[str] = ("asset",)):
    return Window.partitionBy(*keys, "_chunk").orderBy("ts")


def _carries(items: Column, start: Column, step: Step) -> Column:
    """array: for each item the state merged from the items before it."""
    zero = F.struct(start.alias("state"), F.slice(F.array(start), 1, 0).alias("out"))
    return F.aggregate(items, zero, lambda s, x: F.struct(step(s["state"], x).alias("state"),
                                                          F.concat(s["out"], F.array(s["state"])).alias("out")),
                       lambda s: s["out"])


def scan_chunks(summary: DataFrame, keys: Sequence[str], before: tuple[Column, Step], after: tuple[Column, Step] | None = None) -> DataFrame:
    """(keys, _chunk, own, before[, after]): prefix and suffix scans over one summary row per (keys, chunk).

    ``before`` and ``after`` are (first state, merge step) on structs; ``own`` is the chunk's own summary."""
    fields = [c for c in summary.columns if c not in keys]
    rest = [c for c in fields if c != "_chunk"]
    items = F.array_sort(F.collect_list(F.struct("_chunk", *rest)))
    rows = summary.groupBy(*keys).agg(items.alias("_items"))
    parts = [F.col("_items").alias("own"), _carries(F.col("_items"), *before).alias("before")]
    if after is not None:
        parts.append(F.reverse(_carries(F.reverse("_items"), *after)).alias("after"))
    one = rows.select(*keys, F.explode(F.arrays_zip(*parts)).alias("_x"))
    names = ["own", "before", *(["after"] if after is not None else [])]
    return one.select(*keys, F.col("_x.own._chunk").alias("_chunk"), *[F.col(f"_x.{n}").alias(f"_{n}") for n in names])


def _long(v) -> Column:
    return F.lit(v).cast("long")


def _trading_chunks(df: DataFrame, keys: Sequence[str], chunk_seconds: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in the chunk, and chunk summaries of the trading flag."""
    w = in_chunk(keys)
    d = with_chunk(with_is_trading(df, "volume"), chunk_seconds)
    d = d.withColumns({"_pos": F.row_number().over(w).cast("long"), "_prev": F.lag("is_trading").over(w)})
    t, p = F.col("is_trading"), F.col("_prev")
    summary = d.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("is_trading", "_pos").cast("int").alias("first"), F.max_by("is_trading", "_pos").cast("int").alias("last"),
        F.count_if((t == 1) & (p == 0)).alias("starts"),
        F.min(F.when((t == 1) & (p == 0), F.col("_pos"))).alias("first_start"),
        F.max(F.when((t == 0) & (p == 1), F.col("_pos"))).alias("last_stop"),
        F.min(F.when(t == 0, F.col("_pos"))).alias("first_gap"), F.max(F.when(t == 0, F.col("_pos"))).alias("last_gap"))
    return d, summary


def _joined(d: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row with its chunk's carry; (keys, chunk) is how the rows are dealt already."""
    return d.join(carry, [*keys, "_chunk"])


def with_segments_chunked(df: DataFrame, keys: Sequence[str] = ("asset",), chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """W3 + W5 as :func:`segments.with_segments` (change, segment_id, segment_length)."""
    d, summary = _trading_chunks(df, keys, chunk_seconds)

    def forward(s, x):
        started = ((x["first"] == 1) & (s["prev"] == 0)).cast("long")
        return F.struct(x["last"].alias("prev"), (s["starts"] + x["starts"] + started).alias("starts"),
                        F.when(x["last_gap"].isNull(), s["open"] + x["n"]).otherwise(x["n"] - x["last_gap"]).alias("open"))

    def backward(s, x):
        return F.struct(F.when(x["first_gap"].isNull(), s["open"] + x["n"]).otherwise(x["first_gap"] - 1).alias("open"))

    carry = scan_chunks(summary, keys, (F.struct(F.lit(0).alias("prev"), _long(0).alias("starts"), _long(0).alias("open")), forward),
                        (F.struct(_long(0).alias("open")), backward))
    j = _joined(d, carry, keys)
    t = F.col("is_trading")
    inner = F.sum(((t == 1) & (F.col("_prev") == 0)).cast("long")).over(in_chunk(keys).rowsBetween(Window.unboundedPreceding, 0))
    # count of starts inside the chunk so far; the first row has none of its own (its predecessor is in _before)
    j = j.withColumn("_sid", F.coalesce(inner, _long(0)))
    began = ((F.col("_own.first") == 1) & (F.col("_before.prev") == 0)).cast("long")
    j = j.withColumn("_island", F.when(t == 1, F.col("_sid")))
    here = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_chunk", "_island"))
    left = F.when(F.col("_sid") == 0, F.col("_before.open")).otherwise(0)
    right = F.when((F.col("_sid") == F.col("_own.starts")) & (F.col("_own.last") == 1), F.col("_after.open")).otherwise(0)
    out = j.withColumns({
        "change": t - F.coalesce(F.col("_prev"), F.col("_before.prev")),
        "segment_id": F.when(t == 1, F.col("_before.starts") + began + F.col("_sid")),
        "segment_length": F.when(t == 1, here + left + right).cast("long")})
    return out.select(*[c for c in d.columns if not c.startswith("_")], "change", "segment_id", "segment_length")


def boundary_flag_chunked(df: DataFrame, window_before: int = 4, window_after: int = 4, keys: Sequence[str] = ("asset",),
                          chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """W3 + W6 as :func:`segments.boundary_flag` (change, keep_boundary): rows near an edge of their chunk see the
    next start and the last stop through the carries, however many chunks away."""
    d, summary = _trading_chunks(df, keys, chunk_seconds)

    def forward(s, x):  # rows since the last stop, counted at the end of the chunk
        stop = F.coalesce(x["last_stop"], F.when((s["prev"] == 1) & (x["first"] == 0), _long(1)))
        return F.struct(x["last"].alias("prev"), F.when(stop.isNotNull(), x["n"] - stop).otherwise(s["since"] + x["n"]).alias("since"))

    def backward(s, x):  # rows to the next start, counted from before the chunk; whether its first row is one, its neighbour decides
        further = F.when((s["first"] == 1) & (x["last"] == 0), _long(1)).otherwise(s["inner"])
        return F.struct(x["first"].alias("first"), F.coalesce(x["first_start"], x["n"] + further).alias("inner"))

    carry = scan_chunks(summary, keys, (F.struct(F.lit(0).alias("prev"), F.lit(None).cast("long").alias("since")), forward),
                        (F.struct(F.lit(None).cast("int").alias("first"), F.lit(None).cast("long").alias("inner")), backward))
    j = _joined(d, carry, keys)
    t = F.col("is_trading")
    j = j.withColumn("change", t - F.coalesce(F.col("_prev"), F.col("_before.prev")))
    w = in_chunk(keys)
    start, stop = (F.col("change") == 1).cast("int"), (F.col("change") == -1).cast("int")
    next_start = F.when((F.col("_after.first") == 1) & (F.col("_own.last") == 0), _long(1)).otherwise(F.col("_after.inner"))
    near = ((F.max(start).over(w.rowsBetween(0, window_before)) == 1)
            | F.coalesce(F.col("_own.n") - F.col("_pos") + next_start <= window_before, F.lit(False)))
    after = ((F.max(stop).over(w.rowsBetween(-window_after, 0)) == 1)
             | F.coalesce(F.col("_before.since") + F.col("_pos") <= window_after, F.lit(False)))
    out = j.withColumn("keep_boundary", (t == 1) | near | after)
    return out.select(*[c for c in d.columns if not c.startswith("_")], "change", "keep_boundary")


def with_position_chunked(df: DataFrame, col: str = "pos", keys: Sequence[str] = ("asset",), chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """W4 as :func:`segments.with_position`: rows of earlier chunks plus the place in the own one (0-based)."""
    d = with_chunk(df, chunk_seconds)
    summary = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("n"))
    carry = scan_chunks(summary, keys, (F.struct(_long(0).alias("rows")), lambda s, x: F.struct((s["rows"] + x["n"]).alias("rows"))))
    j = _joined(d, carry, keys)
    return j.withColumn(col, F.col("_before.rows") + F.row_number().over(in_chunk(keys)) - 1).drop("_chunk", "_own", "_before")


def reclock_chunked(df: DataFrame, start, step_minutes: int = 15, keys: Sequence[str] = ("asset",), chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """W9 as :func:`prepare.reclock_by`: ``start`` (a timestamp string or column) + position * step."""
    t0 = F.to_timestamp(F.lit(start)) if isinstance(start, str) else start
    d = with_position_chunked(df, "_place", keys, chunk_seconds)
    return d.withColumn("ts", F.timestamp_seconds(F.unix_seconds(t0) + F.col("_place") * F.lit(step_minutes * 60))).drop("_place")


def fill_series_chunked(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("asset",), chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """F15 + W1 + W2 as :func:`prepare.fill_series`: last value of the chunk so far, else of earlier chunks, else
    the first value of the chunk, else of later chunks, else 0."""
    d = with_chunk(df.withColumns({c: non_finite_to_null(c) for c in cols}), chunk_seconds)
    known = [F.when(F.col(c).isNotNull(), F.col("ts")) for c in cols]  # max_by and min_by skip rows whose order is null
    summary = d.groupBy(*keys, "_chunk").agg(*[F.max_by(c, k).alias(f"last{i}") for i, (c, k) in enumerate(zip(cols, known))],
                                             *[F.min_by(c, k).alias(f"first{i}") for i, (c, k) in enumerate(zip(cols, known))])
    kind = dict(d.dtypes)
    none = F.struct(*[F.lit(None).cast(kind[c]).alias(f"v{i}") for i, c in enumerate(cols)])
    take = lambda side: lambda s, x: F.struct(*[F.coalesce(x[f"{side}{i}"], s[f"v{i}"]).alias(f"v{i}") for i in range(len(cols))])
    j = _joined(d, scan_chunks(summary, keys, (none, take("last")), (none, take("first"))), keys)
    so_far = in_chunk(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_before.v{i}"), F.col(f"_own.first{i}"), F.col(f"_after.v{i}"),
                            F.lit(0.0)) for i, c in enumerate(cols)}
    return j.withColumns(filled).drop("_chunk", "_own", "_before", "_after")
