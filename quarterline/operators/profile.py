"""Profiling of the panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import numeric_columns, pct


def first_assets(df: DataFrame, n: int) -> DataFrame:
    """The first N contracts by name, applied as a semi join (the list stays in Spark)."""
    names = df.select("asset").distinct().orderBy("asset").limit(n)
    return df.join(F.broadcast(names), "asset", "left_semi")  # at most n rows


def liquidity(df: DataFrame) -> DataFrame:
    """A1: share of trading rows per contract, least liquid first."""
    return df.groupBy("asset").agg(F.avg("is_trading").alias("liquidity")).orderBy("liquidity", "asset")


def trading_distribution(df: DataFrame) -> DataFrame:
    """A2: total, trading and non-trading rows and trading % per contract."""
    return (df.groupBy("asset")
              .agg(F.count(F.lit(1)).alias("total_rows"),
                   F.sum(F.col("is_trading").cast("long")).alias("trading_rows"))
              .withColumn("non_trading_rows", F.col("total_rows") - F.col("trading_rows"))
              .withColumn("trading_pct", pct("trading_rows", "total_rows")))


def distribution_summary(dist: DataFrame) -> DataFrame:
    """A3: unweighted mean / min / max of the per-contract trading % and total row sums."""
    return dist.agg(F.avg("trading_pct").alias("avg_trading_pct"),
                    F.min("trading_pct").alias("min_trading_pct"),
                    F.max("trading_pct").alias("max_trading_pct"),
                    F.sum("total_rows").alias("total_rows"),
                    F.sum("trading_rows").alias("total_trading_rows"),
                    F.sum("non_trading_rows").alias("total_non_trading_rows"),
                    F.count(F.lit(1)).alias("n_assets"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ("asset",),
             exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """A4: count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column.

    Long output (by..., column, ...). ``exact=False`` uses ``percentile_approx`` (bounded memory
    per group) for very long groups; :func:`selection.describe_refined` is exact with bounded memory.
    """
    cols = list(cols) if cols is not None else [c for c in numeric_columns(df) if c not in by]
    levels = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))

    def of(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        q = (F.percentile(x, levels) if exact
             else F.percentile_approx(x, levels, accuracy).cast("array<double>"))
        return F.struct(F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                        F.stddev_samp(x).alias("std"), F.min(x).alias("min"), q.alias("_q"), F.max(x).alias("max"))

    # all columns in one aggregate: rows are shuffled once, not once per column
    out = df.groupBy(*by).agg(F.array(*[of(c) for c in cols]).alias("_s")).select(*by, F.inline("_s"))
    return out.select(*by, "column_name", "count", "mean", "std", "min",
                      F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: NULL (and NaN) count per column, long (column, null_count)."""
    cols = list(cols) if cols is not None else [c for c in df.columns]
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`")
        dt = dict(df.dtypes)[c]
        miss = x.isNull() | F.isnan(x) if dt in ("double", "float") else x.isNull()
        aggs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("long").alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_count)")


def _corr(a: Column, b: Column) -> Column:
    """Pearson over pairwise-complete rows; NULL when either side is constant (pandas gives NaN)."""
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    den = F.stddev_pop(a2) * F.stddev_pop(b2)
    return F.try_divide(F.covar_pop(a2, b2), F.nullif(den, F.lit(0.0)))


def correlation_matrix(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("asset",)) -> DataFrame:
    """Upper-triangle correlation pairs (col_a < col_b by position) per group, in one aggregate."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [_corr(F.col(a), F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.groupBy(*by).agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(*by, f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


_PAIR = "asset_a string, asset_b string, n double, sa double, sb double, saa double, sbb double, sab double"
#: Contracts per side of a block of pairs: six 256 x 256 sums are 3 MB.
PAIR_BLOCK = 256


def _pair_sums(width: int):
    names_out = [c.split()[0] for c in _PAIR.split(", ")]

    def run(batches):
        """For each block of pairs and bucket of slots that the task gets, one after the other: for every pair, sums
        over the slots in which both contracts are present. Rows come sorted by (block, bucket, slot); a slot cut by a
        batch's end waits for the rest. The state is width x width, whatever the number of contracts and slots."""
        import numpy as np
        import pyarrow as pa

        class Block:
            def __init__(self, bi, bj):
                self.bi, self.bj, self.held = bi, bj, None
                self.sums, self.names = np.zeros((6, width, width)), ({}, {})

            def put(self, t):
                t = t if self.held is None else pa.concat_tables([self.held, t])
                slots = t["slot"].to_numpy()
                cut = int(np.searchsorted(slots, slots[-1]))
                if cut:
                    self.add(t.slice(0, cut))
                self.held = t.slice(cut).combine_chunks()

            def add(self, t):
                slot = np.unique(t["slot"].to_numpy(), return_inverse=True)[1]
                idx, x, names = t["idx"].to_numpy(), t["x"].to_numpy(), t["asset"].to_pylist()
                side = []
                for b, known in ((self.bi, self.names[0]), (self.bj, self.names[1])):
                    mine = np.flatnonzero(idx // width == b)
                    value, here = np.zeros((slot[-1] + 1, width)), np.zeros((slot[-1] + 1, width))
                    at = slot[mine], idx[mine] % width
                    value[at], here[at] = x[mine], 1.0
                    known.update((int(idx[k]) % width, names[k]) for k in mine.tolist())
                    side.append((value, here))
                    if self.bi == self.bj:
                        self.names[1].update(known)
                        side.append(side[0])
                        break
                (xa, ha), (xb, hb) = side
                self.sums += np.stack([ha.T @ hb, xa.T @ hb, ha.T @ xb, (xa * xa).T @ hb, ha.T @ (xb * xb), xa.T @ xb])

            def pairs(self):
                if self.held is not None and self.held.num_rows:
                    self.add(self.held)
                for i, a in sorted(self.names[0].items()):
                    js = [j for j in sorted(self.names[1]) if (self.bi < self.bj or i < j) and self.sums[0, i, j] > 0]
                    if js:
                        yield pa.record_batch([pa.array([a] * len(js)), pa.array([self.names[1][j] for j in js]),
                                               *[pa.array(self.sums[k, i, js]) for k in range(6)]], names=names_out)

        block, key = None, None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            keys = np.stack([t[c].to_numpy() for c in ("bi", "bj", "bucket")])
            starts = np.append(np.flatnonzero(np.append(True, (np.diff(keys) != 0).any(axis=0))), t.num_rows)
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
                now = tuple(keys[:, lo].tolist())
                if now != key:
                    if block is not None:
                        yield from block.pairs()
                    block, key = Block(now[0], now[1]), now
                block.put(t.slice(lo, hi - lo).combine_chunks())
        if block is not None:
            yield from block.pairs()

    return run


def cross_asset_correlation(df: DataFrame, value: str = "close", align: str = "ts", block: int = PAIR_BLOCK) -> DataFrame:
    """Pearson correlation of ``value`` between every pair of contracts (a < b) over the slots
    in which both have a value (pairwise complete), aligned on the slot (``align="ts"``) or on the row
    position in each contract (``align="position"``).

    Contracts are cut into blocks of ``block`` by name; a row goes to each block of pairs that its contract is in
    (one while there are at most ``block`` contracts), spread over buckets of slots. Values are shifted by their
    contract's mean, tasks add up Gram matrices of a block of pairs, and the sums per pair are aggregated. Nothing is
    collected, no pair row is emitted per slot, and no task's state grows with the number of contracts or slots. A pair
    without a common slot has no row; constant series give NULL.
    """
    d = df
    slot = F.unix_micros("ts")
    if align == "position":
        d = df.withColumn("_pos", F.row_number().over(Window.partitionBy("asset").orderBy("ts")))
        slot = F.col("_pos").cast("long")
    d = d.select("asset", slot.alias("slot"), F.col(value).cast("double").alias("x")).filter(
        F.col("x").isNotNull() & ~F.isnan("x") & F.col("asset").isNotNull())
    # one row per contract: its mean and its place in the order of names
    dim = d.groupBy("asset").agg(F.avg("x").alias("_mean")).withColumn(
        "idx", (F.row_number().over(Window.orderBy("asset")) - 1).cast("long"))
    n_blocks = -(-max(d.agg(F.count_distinct("asset")).first()[0], 1) // block)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(1, -(-width // (n_blocks * (n_blocks + 1) // 2)))
    own = F.floor(F.col("idx") / block).cast("long")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("_o")
    d = (d.join(dim, "asset").select("asset", "idx", "slot", (F.col("x") - F.col("_mean")).alias("x"), own.alias("_b"), others)
         .select("asset", "idx", "slot", "x", F.least("_b", "_o").alias("bi"), F.greatest("_b", "_o").alias("bj"),
                 F.pmod(F.xxhash64("slot"), F.lit(n_buckets)).alias("bucket")))
    keys = ["bi", "bj", "bucket"]
    pairs = (d.repartition(width, *keys).sortWithinPartitions(*keys, "slot").mapInArrow(_pair_sums(block), _PAIR)
             .groupBy("asset_a", "asset_b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")]))
    spread = lambda q, s: F.col(q) - F.col(s) * F.col(s) / F.col("n")
    va, vb = spread("saa", "sa"), spread("sbb", "sb")
    # what rounding leaves of a constant series is not a spread
    flat = (va <= F.col("saa") * 1e-12) | (vb <= F.col("sbb") * 1e-12)
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    corr = F.when(~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(va * vb))))
    return pairs.select("asset_a", "asset_b", corr.alias("corr"))


def first_rows(df: DataFrame, n: int = 10, trading_only: bool = True) -> DataFrame:
    """K3: the first n (trading) rows of every contract in time order."""
    d = df.filter(F.col("is_trading") == 1) if trading_only else df
    rn = F.row_number().over(Window.partitionBy("asset").orderBy("ts"))
    return d.withColumn("row_in_asset", rn).filter(F.col("row_in_asset") <= n)
