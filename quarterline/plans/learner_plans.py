"""Plans for the learners from normal equations: direct multi-horizon forecasts (R14), their bagged average (A23) and
the out-of-fold stack (R15). The SQL sums the same products and eliminates step by step in a recursive query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.features import asset_dimension
from ..operators.linear import bag_weight, direct_inputs, direct_table, normal_sums, predicted, solve_ridge
from ..operators.rolling import rolling_context, with_places
from ..operators.scale import fit_scalers, scaler_wide
from ..schema import TARGETS
from . import oracle as O
from .catalog import register
from .model_plans import LEVELS, SPLIT_1H, split_panel

LAGS, HORIZON, CONTEXT, PENALTY = 8, 10, 24, 1.0
INPUTS = direct_inputs(LAGS, ["mean"])
SEEDS = (827, 828, 829)


def solve_sql(sums: str, keys: str, n_inputs: int, penalty: float) -> str:
    """(keys, coef) from (keys, s0, s1, ...) of the products of (1, inputs, y), by elimination without pivots (the
    matrices are positive definite)."""
    p = n_inputs + 2
    at = {}
    for i in range(p):
        for j in range(i, p):
            at[i, j] = at[j, i] = f"s{len(at) - sum(1 for a, b in at if a != b) // 2}"
    entry = lambda i, j: at[i, j] + (f" + {penalty}" if i == j and 0 < i < p - 1 else "")
    rows = ", ".join("[" + ", ".join(f"({entry(i, j)})::DOUBLE" for j in range(p)) + "]" for i in range(p - 1))
    return f"""
    SELECT {keys}, list_transform(a, lambda r: r[{p}]) AS coef FROM (
      WITH RECURSIVE g AS (
        SELECT {keys}, 1 AS k, [{rows}] AS a FROM ({sums})
        UNION ALL
        SELECT {keys}, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / a[k][k])
               ELSE list_transform(r, lambda x, j: x - r[k] * a[k][j] / a[k][k]) END)
        FROM g WHERE k <= {p - 1})
      SELECT * FROM g WHERE k = {p})"""


def sums_sql(rows: str, keys: str, inputs: list[str], weight: str) -> str:
    z = ["1.0", *inputs, "y"]
    cols = []
    for i in range(len(z)):
        for j in range(i, len(z)):
            cols.append(f"sum({weight} * {z[i]} * {z[j]}) AS s{len(cols)}")
    return f"SELECT {keys}, {', '.join(cols)} FROM ({rows}) WHERE {weight} > 0 GROUP BY {keys}"


def _table_sql() -> str:
    """Origins by position, lags by the window function, labels by a self-join on position."""
    parts = []
    for t in TARGETS:
        lags = ", ".join(f"lag({t}, {k - 1}) OVER w AS lag_{k}" for k in range(1, LAGS + 1))
        parts.append(f"""SELECT '{t}' AS target, split, asset, ts, {t} AS v, is_trading, {lags},
            row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY split, asset) AS n FROM s
            WINDOW w AS (PARTITION BY split, asset ORDER BY ts)""")
    return f"""
    WITH s AS MATERIALIZED ({SPLIT_1H}), sc AS MATERIALIZED ({O.scalers_sql(SPLIT_1H)}),
    d AS (SELECT asset, row_number() OVER (ORDER BY asset) - 1 AS idx FROM (SELECT DISTINCT asset FROM s)),
    v AS MATERIALIZED ({" UNION ALL ".join(parts)})
    SELECT o.split, o.asset, o.target, (y.pos - o.pos)::INTEGER AS h, d.idx * 4294967296 + o.pos - {CONTEXT - 1} AS window_id,
           o.pos - {CONTEXT - 1} AS start_pos, {", ".join(f"o.lag_{k}" for k in range(1, LAGS + 1))},
           sin(hour(o.ts) * (3.141592653589793::DOUBLE / 12)) AS hour_sin, cos(hour(o.ts) * (3.141592653589793::DOUBLE / 12)) AS hour_cos,
           coalesce(sc.mean, 0)::DOUBLE AS x_mean, y.v AS y, y.is_trading::DOUBLE AS m
    FROM v o JOIN v y ON y.split = o.split AND y.asset = o.asset AND y.target = o.target AND y.pos BETWEEN o.pos + 1 AND o.pos + {HORIZON}
    JOIN d ON d.asset = o.asset LEFT JOIN sc ON sc.asset = o.asset AND sc.target = o.target
    WHERE o.pos >= {CONTEXT - 1} AND o.pos + {HORIZON} < o.n"""


def training_table(spark, sf_dir):
    """Rows of both splits, with the contract's training mean as its encoding."""
    p = split_panel(spark, sf_dir)
    means = scaler_wide(fit_scalers(p.filter("split = 'train'"))).select("asset", *[F.col(f"_mean_{t}").alias(f"mean_{t}") for t in TARGETS])
    p = p.join(asset_dimension(p).select("asset", "idx"), "asset").join(means, "asset", "left")
    p = p.withColumns({f"mean_{t}": F.coalesce(F.col(f"mean_{t}"), F.lit(0.0)) for t in TARGETS})
    return direct_table(p, LAGS, HORIZON, CONTEXT, ("split", "asset"), ["mean"])


@register("r14_training_table", f"""
    SELECT split, target, h, window_id, {", ".join(f"lag_{k}" for k in range(1, LAGS + 1))}, round(x_mean, 6) AS x_mean, y, m
    FROM ({_table_sql()})""")
def r14_training_table(spark, sf_dir):
    """Features and labels of every origin, keyed by (target, step)."""
    return training_table(spark, sf_dir).select("split", "target", "h", "window_id", *[f"lag_{k}" for k in range(1, LAGS + 1)],
                                                F.round("x_mean", 6).alias("x_mean"), "y", "m")


_DOT = " + ".join(["c.coef[1]", *[f"c.coef[{k + 2}] * {x}" for k, x in enumerate(INPUTS)]])


@register("r14_direct_forecasts", f"""
    WITH t AS MATERIALIZED ({_table_sql()}),
    c AS ({solve_sql(sums_sql("SELECT * FROM t WHERE split = 'train'", "target, h", INPUTS, "m"), "target, h", len(INPUTS), PENALTY)})
    SELECT window_id, target, h, round({_DOT}, 4) AS value FROM t JOIN c USING (target, h) WHERE split = 'val'""")
def r14_direct_forecasts(spark, sf_dir):
    """A model per (target, step), 4 x 10, on all training origins whose label counts; the forecasts of every
    validation window as rows."""
    t = training_table(spark, sf_dir)
    coefs = solve_ridge(normal_sums(t.filter("split = 'train'"), ["target", "h"], INPUTS), ["target", "h"], len(INPUTS), PENALTY)
    p = predicted(t.filter("split = 'val'"), coefs, ["target", "h"], INPUTS, "value")
    return p.select("window_id", "target", "h", F.round("value", 4).alias("value"))


def _bagged_sql() -> str:
    digit = "instr('0123456789abcdef', substr(md5(seed || '|' || asset || '|' || start_pos), 1, 1))"
    rows = f"""SELECT *, m * CASE WHEN {digit} <= 6 THEN 0.0 WHEN {digit} <= 12 THEN 1.0 WHEN {digit} <= 15 THEN 2.0 ELSE 3.0 END AS wt
               FROM t CROSS JOIN (VALUES {", ".join(f"({s})" for s in SEEDS)}) x(seed) WHERE split = 'train'"""
    return f"""
    WITH t AS MATERIALIZED ({_table_sql()}),
    c AS ({solve_sql(sums_sql(rows, "seed, target, h", INPUTS, "wt"), "seed, target, h", len(INPUTS), PENALTY)})
    SELECT seed, window_id, target, h, y, m, {_DOT} AS p FROM t JOIN c USING (target, h) WHERE split = 'val'"""


def bagged_forecasts(spark, sf_dir):
    """(seed, window_id, target, h, y, m, p): models per (seed, target, step) on bootstrap draws of the windows."""
    t = training_table(spark, sf_dir)
    train = t.filter("split = 'train'").withColumn("seed", F.explode(F.array(*[F.lit(s) for s in SEEDS])))
    train = train.withColumn("m", F.col("m") * bag_weight(F.col("seed"), "asset", "start_pos"))
    keys = ["seed", "target", "h"]
    coefs = solve_ridge(normal_sums(train, keys, INPUTS), keys, len(INPUTS), PENALTY)
    return predicted(t.filter("split = 'val'"), coefs, ["target", "h"], INPUTS).select("seed", "window_id", "target", "h", "y", "m", "p")


@register("a23_averaged_forecasts", f"""
    SELECT window_id, target, h, count(*) AS n_seeds, round(avg(p), 4) AS value, round(stddev_samp(p), 4) AS spread
    FROM ({_bagged_sql()}) GROUP BY window_id, target, h""")
def a23_averaged_forecasts(spark, sf_dir):
    """Forecasts averaged over the seeds per (window, step, target)."""
    return bagged_forecasts(spark, sf_dir).groupBy("window_id", "target", "h").agg(
        F.count(F.lit(1)).alias("n_seeds"), F.round(F.avg("p"), 4).alias("value"), F.round(F.stddev_samp("p"), 4).alias("spread"))


@register("a23_bagged_scores", f"""
    WITH b AS MATERIALIZED ({_bagged_sql()}),
    s AS (SELECT seed, {O.smape_agg_sql()} AS s FROM b GROUP BY seed),
    a AS (SELECT {O.smape_agg_sql()} AS s FROM (SELECT window_id, target, h, any_value(y) AS y, any_value(m) AS m, avg(p) AS p
                                                FROM b GROUP BY window_id, target, h))
    SELECT count(*) AS n_seeds, round(avg(s.s), 5) AS mean_smape, round(stddev_samp(s.s), 5) AS std_smape,
           round(any_value(a.s), 5) AS averaged_smape FROM s, a""")
def a23_bagged_scores(spark, sf_dir):
    """Mean and deviation of the seeds' scores, and the score of the averaged forecast, from one frame."""
    b = bagged_forecasts(spark, sf_dir)
    # a seed's rows and the averaged ones (seed NULL) in one grouping
    mean = b.groupBy("window_id", "target", "h").agg(F.first("y").alias("y"), F.first("m").alias("m"), F.avg("p").alias("p"))
    each = b.select("seed", "y", "m", "p").unionByName(mean.select(F.lit(None).cast("int").alias("seed"), "y", "m", "p"))
    s = M.smape(each, ["seed"])
    seeds = F.when(F.col("seed").isNotNull(), F.col("smape"))
    return s.agg(F.count(seeds).alias("n_seeds"), F.round(F.avg(seeds), 5).alias("mean_smape"), F.round(F.stddev_samp(seeds), 5).alias("std_smape"),
                 F.round(F.max(F.when(F.col("seed").isNull(), F.col("smape"))), 5).alias("averaged_smape"))


# --- R15 ------------------------------------------------------------------------------------

FOLD = "2024-01-01", 7  # folds of the training split: weeks from this day
STACK = ["p_naive", "p_quantile", "p_calendar"]


def _fold(ts="ts"):
    return F.floor((F.unix_seconds(ts) - F.unix_seconds(F.to_timestamp(F.lit(FOLD[0])))) / (86400 * FOLD[1])).cast("int")


def _stack_sql() -> str:
    fold = f"floor(epoch({{}} - TIMESTAMP '{FOLD[0]}') / {86400 * FOLD[1]})::INTEGER"
    parts = []
    for split in ("train", "val"):
        rows = f"SELECT * EXCLUDE (split) FROM s WHERE split = '{split}'"
        parts.append(f"""
        SELECT '{split}' AS split, n.target, n.h, n.window_id, n.target_ts, n.asset, n.y, n.m, n.p AS p_naive, q.p AS p_quantile
        FROM ({O.eval_sql(rows, CONTEXT, HORIZON, 'naive')}) n
        JOIN ({O.eval_sql(rows, CONTEXT, HORIZON, 'quantile', LEVELS)}) q USING (window_id, h, target)""")
    long = " UNION ALL ".join(f"SELECT asset, ts, '{t}' AS target, {t} AS v FROM s WHERE split = 'train'" for t in TARGETS)
    return f"""
    WITH s AS MATERIALIZED ({SPLIT_1H}),
    f AS MATERIALIZED ({" UNION ALL ".join(parts)}),
    tr AS MATERIALIZED (SELECT *, {fold.format('ts')} AS fold FROM ({long})),
    k AS (SELECT DISTINCT CASE WHEN split = 'train' THEN {fold.format('target_ts')} ELSE -1 END AS fold FROM f),
    prof AS MATERIALIZED (SELECT k.fold, asset, target, month(ts) AS mon, isodow(ts) AS dow, hour(ts) AS hr, avg(v) AS g
             FROM tr JOIN k ON tr.fold <> k.fold GROUP BY ALL)
    SELECT f.*, coalesce(prof.g, 0)::DOUBLE AS p_calendar
    FROM f LEFT JOIN prof ON prof.asset = f.asset AND prof.target = f.target AND prof.mon = month(f.target_ts)
         AND prof.dow = isodow(f.target_ts) AND prof.hr = hour(f.target_ts)
         AND prof.fold = CASE WHEN f.split = 'train' THEN {fold.format('f.target_ts')} ELSE -1 END"""


_STACK_DOT = " + ".join(["c.coef[1]", *[f"c.coef[{k + 2}] * {x}" for k, x in enumerate(STACK)]])


def stack_frame(spark, sf_dir):
    """The three base forecasts of every window and step of both splits as columns of one frame, no join of frames. The
    calendar profile of a training row's week is fitted on the other weeks, that of a validation row on all of them."""
    p = split_panel(spark, sf_dir)
    slot = [F.month("ts").alias("_mon"), F.weekday("ts").alias("_dow"), F.hour("ts").alias("_hr")]
    sums = p.filter("split = 'train'").groupBy("asset", *slot, _fold().alias("_fold")).agg(
        *[F.sum(t).alias(f"_s_{t}") for t in TARGETS], F.count(F.lit(1)).alias("_n"))
    total = sums.groupBy("asset", "_mon", "_dow", "_hr").agg(
        *[F.sum(f"_s_{t}").alias(f"_a_{t}") for t in TARGETS], F.sum("_n").alias("_a"))  # contracts x slots of a week
    keys = ["asset", "_mon", "_dow", "_hr"]
    d = p.select("*", *slot, _fold().alias("_fold"))
    d = d.join(total, keys, "left").join(sums, [*keys, "_fold"], "left")
    own = lambda c: F.when(F.col("split") == "train", F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0))
    d = d.withColumns({f"g_{t}": F.coalesce(F.try_divide(F.col(f"_a_{t}") - own(f"_s_{t}"), F.nullif(F.col("_a") - own("_n"), F.lit(0))), F.lit(0.0))
                       for t in TARGETS}).select("split", "asset", "ts", *TARGETS, "is_trading", *[f"g_{t}" for t in TARGETS])
    d = d.join(asset_dimension(p).select("asset", "idx"), "asset")
    placed = with_places(d, ("split", "asset"))
    c = rolling_context(placed, [CONTEXT], LEVELS, TARGETS, ("split", "asset"), HORIZON, carry=[f"g_{t}" for t in TARGETS])
    start = F.col("pos") - (CONTEXT - 1)
    c = c.filter((start >= 0) & (F.col("pos") + HORIZON < F.col("n_rows"))).select(
        "split", (F.col("idx") * F.lit(1 << 32) + start).alias("window_id"), *[f"q{CONTEXT}_{t}" for t in TARGETS],
        *[f"f{CONTEXT}_{t}" for t in TARGETS], F.posexplode("next").alias("_h", "_s"))
    each = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"_s.{t}").alias("y"), F.col(f"f{CONTEXT}_{t}").alias("p_naive"),
                              F.element_at(f"q{CONTEXT}_{t}", len(LEVELS) // 2 + 1).alias("p_quantile"), F.col(f"_s.g_{t}").alias("p_calendar"))
                     for t in TARGETS])
    return c.select("split", "window_id", (F.col("_h") + 1).cast("int").alias("h"), F.col("_s.m").alias("m"), F.inline(each))


@register("r15_stack_inputs", f"""
    SELECT split, window_id, target, h, y, m, p_naive, round(p_quantile, 6) AS p_quantile, round(p_calendar, 6) AS p_calendar
    FROM ({_stack_sql()})""")
def r15_stack_inputs(spark, sf_dir):
    """The out-of-fold inputs of the stack."""
    return stack_frame(spark, sf_dir).select("split", "window_id", "target", "h", "y", "m", "p_naive", F.round("p_quantile", 6).alias("p_quantile"),
                                             F.round("p_calendar", 6).alias("p_calendar"))


@register("r15_ridge_stack", f"""
    WITH t AS MATERIALIZED ({_stack_sql()}),
    c AS ({solve_sql(sums_sql("SELECT * FROM t WHERE split = 'train'", "target", STACK, "m"), "target", len(STACK), PENALTY)}),
    e AS (SELECT target, y, m, {_STACK_DOT} AS p FROM t JOIN c USING (target) WHERE split = 'val')
    SELECT 'ridge_stack' AS model, target, round({O.smape_agg_sql()}, 6) AS smape, sum(m) AS n_scored FROM e GROUP BY target""")
def r15_ridge_stack(spark, sf_dir):
    """Ridge per target on the out-of-fold forecasts of the training steps that count, scored on validation."""
    f = stack_frame(spark, sf_dir)
    coefs = solve_ridge(normal_sums(f.filter("split = 'train'"), ["target"], STACK), ["target"], len(STACK), PENALTY)
    ev = predicted(f.filter("split = 'val'"), coefs, ["target"], STACK)
    return M.smape(ev, ["target"]).select(F.lit("ridge_stack").alias("model"), "target", F.round("smape", 6).alias("smape"), "n_scored")
