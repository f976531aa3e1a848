"""Plans for supervised windows and training-set preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as S
from ..operators.features import featurize
from ..operators.prepare import fill_series, prepare_series, segment_training_rows, segment_training_set
from ..operators.windows import assign_shards, reclock, supervised_windows, transpose, with_batches
from ..schema import WindowParams
from ..sources.candles import events_panel
from . import oracle as O
from .catalog import register
from .model_plans import VAL_START
from .segment_plans import MIN_SEG, TRADED_1H, traded_panel

WIN = WindowParams(input_chunk_length=24, output_chunk_length=10)
TRADING_ROWS_SQL = f"SELECT * FROM ({TRADED_1H}) WHERE is_trading = 1"


def trading_windows(spark, sf_dir):
    return supervised_windows(S.trading_only(traded_panel(spark, sf_dir)), WIN)


_WIN_BASE = f"""
    WITH v AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS pos,
                      count(*) OVER (PARTITION BY asset) AS n_rows FROM ({TRADING_ROWS_SQL})),
    d AS (SELECT asset, row_number() OVER (ORDER BY asset) - 1 AS idx FROM (SELECT DISTINCT asset FROM v)),
    w AS (SELECT v.asset, v.pos AS start_pos, d.idx * 4294967296 + v.pos AS window_id, v.n_rows
          FROM v JOIN d USING (asset) WHERE v.pos + 34 <= v.n_rows AND v.n_rows >= 34)"""


@register("w08_supervised_windows", f"""{_WIN_BASE}
    SELECT w.window_id, w.start_pos, (v.pos - w.start_pos)::INTEGER AS position, v.pos < w.start_pos + 24 AS is_past,
           CASE WHEN v.pos < w.start_pos + 24 THEN v.ts END AS past_ts, v.is_trading::DOUBLE AS mask,
           v.high::FLOAT::DOUBLE AS high, v.low::FLOAT::DOUBLE AS low, v.close::FLOAT::DOUBLE AS close,
           v.volume::FLOAT::DOUBLE AS volume
    FROM w JOIN v ON v.asset = w.asset AND v.pos BETWEEN w.start_pos AND w.start_pos + 33""")
def w08_supervised_windows(spark, sf_dir):
    """W8 + R1 + R2: windows [24 past, 10 future] x 4 targets (FLOAT) with masks and past
    timestamps, on the trading-only rows (positions bridge time gaps, as in the reference);
    every step of every window as a row, in the order of the arrays."""
    w = trading_windows(spark, sf_dir)
    steps = F.posexplode(F.concat(*[F.arrays_zip(F.col(part).alias("v"), F.col(f"{part}_mask").alias("m"))
                                    for part in ("past", "future")]))
    s = w.select("window_id", "start_pos", "past_ts", steps.alias("position", "step"))
    value = lambda k: F.element_at("step.v", k).cast("double")
    past = F.col("position") < 24
    return s.select("window_id", "start_pos", "position", past.alias("is_past"),
                    F.when(past, F.get("past_ts", F.col("position"))).alias("past_ts"),
                    F.array_max("step.m").cast("double").alias("mask"), value(1).alias("high"), value(2).alias("low"),
                    value(3).alias("close"), value(4).alias("volume"))


@register("w08_window_digest", f"""{_WIN_BASE}
    SELECT w.window_id, w.asset, w.start_pos,
           sum(CASE WHEN v.pos < w.start_pos + 24 THEN v.is_trading::FLOAT END)::DOUBLE AS past_mask_sum,
           round(sum(CASE WHEN v.pos < w.start_pos + 24 THEN v.close::FLOAT::DOUBLE END), 3) AS past_close_sum,
           round(sum(CASE WHEN v.pos >= w.start_pos + 24 THEN v.volume::FLOAT::DOUBLE END), 3) AS future_volume_sum,
           round(max(CASE WHEN v.pos >= w.start_pos + 24 THEN v.high::FLOAT::DOUBLE END), 3) AS future_high_max,
           min(v.ts) AS first_past_ts, max(CASE WHEN v.pos < w.start_pos + 24 THEN v.ts END) AS last_past_ts
    FROM w JOIN v ON v.asset = w.asset AND v.pos BETWEEN w.start_pos AND w.start_pos + 33
    GROUP BY w.window_id, w.asset, w.start_pos""")
def w08_window_digest(spark, sf_dir):
    """Per-window sums over the window arrays (close read through the [C, T]
    transpose) matched against a position self-join."""
    w = trading_windows(spark, sf_dir)
    tp = transpose(F.col("past"), 4)
    tf = transpose(F.col("future"), 4)
    dsum = lambda arr: F.aggregate(arr, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return w.select(
        "window_id", "asset", "start_pos",
        (dsum(F.flatten(F.col("past_mask"))) / F.lit(4.0)).alias("past_mask_sum"),
        F.round(dsum(F.element_at(tp, 3)), 3).alias("past_close_sum"),
        F.round(dsum(F.element_at(tf, 4)), 3).alias("future_volume_sum"),
        F.round(F.array_max(F.element_at(tf, 1)).cast("double"), 3).alias("future_high_max"),
        F.element_at("past_ts", 1).alias("first_past_ts"), F.element_at("past_ts", -1).alias("last_past_ts"))


@register("r05_batches_shards", f"""{_WIN_BASE},
    off AS (SELECT asset, coalesce(sum(n) OVER (ORDER BY asset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
            FROM (SELECT asset, count(*) AS n FROM w GROUP BY asset))
    SELECT w.window_id, w.asset, w.start_pos, (off.o + w.start_pos) // 64 AS batch_id,
           (d.idx % 4)::INTEGER AS shard
    FROM w JOIN off USING (asset) JOIN d USING (asset)""")
def r05_batches_shards(spark, sf_dir):
    """R5 + R7: batch of 64 windows in (contract, start) order; contracts dealt to 4 shards."""
    w = trading_windows(spark, sf_dir).select("window_id", "asset", "start_pos")
    return assign_shards(with_batches(w, 64), 4).select("window_id", "asset", "start_pos", "batch_id", "shard")


@register("r06_epoch_shuffle_order", f"""{_WIN_BASE}
    SELECT window_id, md5('1237' || '|' || asset || '|' || start_pos::VARCHAR) AS shuffle_key FROM w""")
def r06_epoch_shuffle_order(spark, sf_dir):
    """Deterministic shuffle key of every window for epoch 3 (seed 1234 + epoch)."""
    from ..operators.windows import shuffle_key
    return trading_windows(spark, sf_dir).select("window_id", shuffle_key(1234, 3).alias("shuffle_key"))


@register("w09_reclock", f"""
    SELECT asset, ts AS orig_ts,
           TIMESTAMP '2020-01-01 00:00:00' + (row_number() OVER (PARTITION BY asset ORDER BY ts) - 1) * INTERVAL 15 MINUTE
             AS ts
    FROM ({TRADING_ROWS_SQL})""")
def w09_reclock(spark, sf_dir):
    """Trading-only rows on a continuous 15-minute clock from 2020-01-01."""
    d = S.trading_only(traded_panel(spark, sf_dir)).withColumn("orig_ts", F.col("ts"))
    return reclock(d).select("asset", "orig_ts", "ts")


_FILL_COLS = ["close_lag_adj_1", "nearest_liquid_contract_close", "cross_contract_mean"]


@register("w02_fill_forward_backward", f"""
    WITH f AS ({O.features_sql(O.event_panel_sql(3600), fill="NULL")})
    SELECT asset, ts, {", ".join(
        f"round(coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0), 6) AS {c}"
        for c in _FILL_COLS)}
    FROM f""")
def w02_fill_forward_backward(spark, sf_dir):
    """W1 + W2 (+F15): engineered columns forward filled, then backward filled, then 0."""
    f = featurize(events_panel(spark, sf_dir, 3600), fill=False)
    out = fill_series(f, _FILL_COLS)
    return out.select("asset", "ts", *[F.round(c, 6).alias(c) for c in _FILL_COLS])


_P7_COLS = ["high", "low", "close", "volume", "time_to_delivery", "nearest_liquid_contract_close", "cross_contract_mean",
            *[f"{c}_{k}" for k in range(1, 7) for c in ("close_lag_adj", "close_delta_adj", "volume_adj")]]


def _p7_sql():
    feats = O.features_sql(O.event_panel_sql(3600), fill="NULL")
    split = f"SELECT *, CASE WHEN ts < TIMESTAMP '{VAL_START}' THEN 'train' ELSE 'val' END AS split FROM ({feats})"
    tr = O.stratified_sql(f"SELECT * FROM ({split}) WHERE split = 'train'")
    va = O.stratified_sql(f"SELECT * FROM ({split}) WHERE split = 'val'")
    fill = ", ".join(
        f"round(coalesce(last_value({c} IGNORE NULLS) OVER w, first_value({c} IGNORE NULLS) OVER a, 0), 6) AS {c}"
        for c in _P7_COLS)
    return f"""
    WITH s AS ({tr} UNION ALL {va}),
    ok AS (SELECT asset FROM s GROUP BY asset
           HAVING count(*) FILTER (WHERE split = 'train') >= 44 AND count(*) FILTER (WHERE split = 'val') >= 44)
    SELECT split, asset, ts AS orig_ts,
           CASE split WHEN 'train' THEN TIMESTAMP '2020-01-01 00:00:00' ELSE TIMESTAMP '2021-01-01 00:00:00' END
             + (row_number() OVER (PARTITION BY split, asset ORDER BY ts) - 1) * INTERVAL 15 MINUTE AS ts,
           {fill}
    FROM s WHERE asset IN (SELECT asset FROM ok)
    WINDOW w AS (PARTITION BY split, asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           a AS (PARTITION BY split, asset ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@register("p07_prepare_series", _p7_sql())
def p07_prepare_series(spark, sf_dir):
    """Stratified per split -> contracts with >= 44 rows on both sides -> clean + fill ->
    continuous clock (train from 2020-01-01, val from 2021-01-01)."""
    from ..operators.split import split_by_dates
    f = split_by_dates(featurize(events_panel(spark, sf_dir, 3600), fill=False), VAL_START)
    out = prepare_series(f, "Stratified", 24, 10)
    return out.select("split", "asset", "orig_ts", "ts", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in _P7_COLS])


def _p8_sql(tail):
    sp = f"SELECT *, CASE WHEN ts < TIMESTAMP '{VAL_START}' THEN 'train' ELSE 'val' END AS split FROM ({TRADED_1H})"
    isl_tr = O.islands_sql(f"SELECT * EXCLUDE (split) FROM ({sp}) WHERE split = 'train'")
    isl_va = O.islands_sql(f"SELECT * EXCLUDE (split) FROM ({sp}) WHERE split = 'val'")
    return f"""
    WITH it AS ({isl_tr}), iv AS ({isl_va}),
    a AS (SELECT asset, count(*) FILTER (WHERE island_len >= {MIN_SEG}) AS trading_rows,
                 count(DISTINCT island_no) FILTER (WHERE island_len >= {MIN_SEG}) AS n_seg FROM it GROUP BY asset),
    r AS (SELECT asset, row_number() OVER (ORDER BY trading_rows DESC, asset) AS rank,
                 coalesce(sum(trading_rows) OVER (ORDER BY trading_rows DESC, asset ROWS BETWEEN UNBOUNDED PRECEDING
                          AND 1 PRECEDING), 0)::BIGINT AS before FROM a WHERE n_seg > 0),
    chosen AS (SELECT asset FROM r WHERE rank <= 5 AND before < 300),
    tr AS (SELECT asset, ts FROM it WHERE is_trading = 1 AND island_len >= {MIN_SEG} AND asset IN (SELECT asset FROM chosen)),
    vseg AS (SELECT asset, ts FROM iv WHERE is_trading = 1 AND island_len >= {MIN_SEG} AND asset IN (SELECT asset FROM chosen)),
    vfull AS (SELECT asset, ts FROM iv WHERE asset IN (SELECT asset FROM chosen)
              AND asset NOT IN (SELECT asset FROM vseg)),
    allrows AS (SELECT 'train' AS split, * FROM tr UNION ALL SELECT 'val', * FROM vseg UNION ALL SELECT 'val', * FROM vfull)
    """ + tail


_P8_COUNTS = "SELECT split, asset, count(*) AS n_rows, greatest(0, count(*) - 33) AS n_windows FROM allrows GROUP BY split, asset"
_P8_ROWS = f"""
    SELECT split, asset, ts AS orig_ts,
           CASE split WHEN 'train' THEN TIMESTAMP '2020-01-01 00:00:00' ELSE TIMESTAMP '2021-01-01 00:00:00' END
             + (row_number() OVER (PARTITION BY split, asset ORDER BY ts) - 1) * INTERVAL 15 MINUTE AS ts,
           p.high::FLOAT::DOUBLE AS high, p.low::FLOAT::DOUBLE AS low, p.close::FLOAT::DOUBLE AS close,
           p.volume::FLOAT::DOUBLE AS volume
    FROM allrows JOIN ({TRADED_1H}) p USING (asset, ts)"""


@register("p08_segment_training_set", _p8_sql(_P8_COUNTS))
def p08_segment_training_set(spark, sf_dir):
    """Best contracts by segment rows (5 or 300 rows), their train segments and val
    segments (full val when none), window counts per split (L_in 24, L_out 10)."""
    from ..operators.split import split_by_dates
    sp = split_by_dates(traded_panel(spark, sf_dir), VAL_START)
    tr = sp.filter("split = 'train'").drop("split")
    va = sp.filter("split = 'val'").drop("split")
    return segment_training_set(tr, va, MIN_SEG, 300, 5, 24, 10)


@register("p08_training_rows", _p8_sql(_P8_ROWS))
def p08_training_rows(spark, sf_dir):
    """P8 as rows: segment rows of the chosen contracts and their validation rows, cleaned, FLOAT, on a
    continuous clock per split."""
    from ..operators.split import split_by_dates
    sp = split_by_dates(traded_panel(spark, sf_dir), VAL_START)
    rows = segment_training_rows(sp.filter("split = 'train'").drop("split"), sp.filter("split = 'val'").drop("split"),
                                 MIN_SEG, 300, 5)
    return rows.select("split", "asset", "orig_ts", "ts", *[F.col(c).cast("double").alias(c) for c in ("high", "low", "close", "volume")])
