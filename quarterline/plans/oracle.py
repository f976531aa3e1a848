"""DuckDB SQL fragments used as the independent oracle for the registered plans.

They run on the driver tables registered as views (``events``, ``lineitem``, ``part``, ...).
Where two formulations exist the SQL uses the other one: neighbours by self-join on
index +- k instead of a window over the timestamp, delivery time from the minute of the
ISO week instead of the next-instant construction.
"""

from __future__ import annotations

# Weekday abbreviations in Monday=0 order.
DAYS_SQL = "['Mon','Tue','Wed','Thu','Fri','Sat','Sun']"
TARGETS = ("high", "low", "close", "volume")


def name_sql(k: str) -> str:
    """Contract name for integer expression k (fixture naming rule)."""
    j = f"((({k}) * 263) % 672)"
    return (f"({DAYS_SQL}[{j} % 7 + 1] || lpad(((({j}) // 7) % 24)::VARCHAR, 2, '0') "
            f"|| 'Q' || (({j}) // 168 + 1)::VARCHAR)")


def event_candles_sql(bucket_seconds: int = 3600, n_contracts: int = 24) -> str:
    return f"""
    SELECT asset, bucket AS ts, max(value)::DOUBLE AS high, min(value)::DOUBLE AS low,
           first(value ORDER BY t DESC, event_id DESC)::DOUBLE AS close, count(*)::DOUBLE AS volume
    FROM (SELECT {name_sql(f'user_id % {n_contracts}')} AS asset, ts AS t, event_id, value,
                 time_bucket(INTERVAL '{bucket_seconds} seconds', ts) AS bucket
          FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL)
    GROUP BY asset, bucket"""


def hot_panel_sql() -> str:
    """FX3: one-minute candles, not densified, volume = trades, trading flag by volume."""
    return f"""
    SELECT *, (volume > 0)::INTEGER AS is_trading FROM (
      SELECT asset, bucket AS ts, max(value)::DOUBLE AS high, min(value)::DOUBLE AS low,
             first(value ORDER BY t DESC, event_id DESC)::DOUBLE AS close,
             (count(*) FILTER (event_type IN ('click', 'purchase', 'signup')))::DOUBLE AS volume
      FROM (SELECT CASE WHEN user_id % 3 = 0 THEN {name_sql('0')} ELSE {name_sql('user_id % 24')} END AS asset, ts AS t, event_id,
                   value, event_type, time_bucket(INTERVAL '60 seconds', ts) AS bucket
            FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL)
      GROUP BY asset, bucket)"""


def brand_candles_sql() -> str:
    return f"""
    SELECT asset, bucket AS ts, max(l_extendedprice)::DOUBLE AS high, min(l_extendedprice)::DOUBLE AS low,
           first(l_extendedprice ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                 l_partkey DESC, l_suppkey DESC, l_extendedprice DESC)::DOUBLE AS close,
           sum(l_quantity)::DOUBLE AS volume
    FROM (SELECT {name_sql("TRY_CAST(regexp_extract(p.p_brand, '(\\d+)$', 1) AS INTEGER)")} AS asset,
                 l.*, time_bucket(INTERVAL '86400 seconds', l.l_shipdate) AS bucket
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
          WHERE l.l_shipdate IS NOT NULL)
    WHERE asset IS NOT NULL
    GROUP BY asset, bucket"""


def dense_sql(candles: str, step_seconds: int) -> str:
    """Dense grid: all assets x all slots between the global min and max; missing -> 0."""
    return f"""
    WITH c AS ({candles}),
    b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM c),
    s AS (SELECT unnest(generate_series(lo, hi, INTERVAL '{step_seconds} seconds')) AS ts FROM b),
    a AS (SELECT DISTINCT asset FROM c)
    SELECT a.asset, s.ts, coalesce(c.high, 0)::DOUBLE AS high, coalesce(c.low, 0)::DOUBLE AS low,
           coalesce(c.close, 0)::DOUBLE AS close, coalesce(c.volume, 0)::DOUBLE AS volume
    FROM a CROSS JOIN s LEFT JOIN c ON c.asset = a.asset AND c.ts = s.ts"""


def event_panel_sql(bucket_seconds: int = 3600, n_contracts: int = 24) -> str:
    return dense_sql(event_candles_sql(bucket_seconds, n_contracts), bucket_seconds)


def brand_panel_sql() -> str:
    return dense_sql(brand_candles_sql(), 86400)


def dim_sql(panel: str = "panel") -> str:
    return f"""
    SELECT asset, (row_number() OVER (ORDER BY asset) - 1)::BIGINT AS idx, count(*) OVER () AS n_assets,
           list_position({DAYS_SQL}, substr(asset, 1, 3)) - 1 AS d_dow,
           TRY_CAST(substr(asset, 4, 2) AS INTEGER) AS d_hour,
           (TRY_CAST(substr(asset, 7) AS INTEGER) - 1) * 15 AS d_minute
    FROM (SELECT DISTINCT asset FROM {panel})"""


def time_features_sql(panel: str = "panel", dim: str = "dim") -> str:
    """Calendar columns, trading flag and time to delivery (minute-of-week formulation)."""
    return f"""
    SELECT p.*, d.idx, d.n_assets,
           hour(p.ts) AS hour_of_day, isodow(p.ts) - 1 AS day_of_week, weekofyear(p.ts) AS week_of_year,
           month(p.ts) AS month, (isodow(p.ts) >= 6)::INTEGER AS is_weekend,
           (p.high + p.low + p.close + p.volume > 0)::INTEGER AS is_trading,
           greatest(
             (CASE WHEN slot_us - week_us <= 0 THEN slot_us - week_us + 604800000000
                   ELSE slot_us - week_us END) / 3600000000.0, 0.0) AS time_to_delivery
    FROM (SELECT *, epoch_us(ts) - epoch_us(date_trunc('week', ts)) AS week_us FROM {panel}) p
    JOIN (SELECT *, (d_dow * 1440 + d_hour * 60 + d_minute)::BIGINT * 60000000 AS slot_us FROM {dim}) d
      ON d.asset = p.asset"""


def features_sql(panel_sql: str, k_max: int = 6, fill: float = -1.0, round_mean: int | None = 6, joined: bool = True) -> str:
    """The featured table via self-joins on neighbour index at equal timestamps, or (``joined=False``, dense panels
    only) via the slot's list of contracts in order, which costs one aggregate instead of twelve joins."""
    joins, sel = [], []
    if joined:
        for k in range(1, k_max + 1):
            joins.append(f"LEFT JOIN ff p{k} ON p{k}.ts = f.ts AND p{k}.idx = f.idx - {k}")
            joins.append(f"LEFT JOIN ff n{k} ON n{k}.ts = f.ts AND n{k}.idx = f.idx + {k}")
    else:
        state = "{'lc': lc, 'lv': lv, 'close': close, 'volume': volume}"
        near = ", ".join(f"CASE WHEN idx {'+' if s == 'n' else '-'} {k} BETWEEN 0 AND n_assets - 1 THEN l[idx + 1 {'+' if s == 'n' else '-'} {k}] END AS {s}{k}"
                         for k in range(1, k_max + 1) for s in ("p", "n"))
        joins.append(f"JOIN (SELECT x.asset AS a, x.ts AS t, {near} FROM ff x JOIN (SELECT ts, list({state} ORDER BY idx) AS l FROM ff GROUP BY ts) y "
                     "USING (ts)) nb ON nb.a = f.asset AND nb.t = f.ts")
    for k in range(1, k_max + 1):
        pick = lambda col: (f"CASE WHEN f.idx + {k} < f.n_assets THEN n{k}.{col} "
                            f"WHEN f.idx - {k} >= 0 THEN p{k}.{col} END")
        sel.append(f"{pick('lc')} AS close_lag_adj_{k}")
        sel.append(f"f.close - ({pick('lc')}) AS close_delta_adj_{k}")
        sel.append(f"{pick('lv')} AS volume_adj_{k}")
    liquid = ", ".join(f"CASE WHEN {s}{k}.volume > 0 THEN {s}{k}.close END"
                       for k in range(1, k_max + 1) for s in ("p", "n"))
    sel.append(f"coalesce({liquid}) AS nearest_liquid_contract_close")
    lcs = ", ".join(f"{s}{k}.lc" for k in range(1, k_max + 1) for s in ("p", "n"))
    mean = f"list_avg([{lcs}])"
    if round_mean is not None:
        mean = f"round({mean}, {round_mean})"
    sel.append(f"{mean} AS cross_contract_mean")
    feat_names = [s.rsplit(" AS ", 1)[1] for s in sel]
    masked = ", ".join(f"coalesce(CASE WHEN is_trading = 1 THEN {c} END, {fill}) AS {c}" for c in feat_names)
    return f"""
    WITH panel AS ({panel_sql}),
    dim AS ({dim_sql('panel')}),
    tf AS ({time_features_sql('panel', 'dim')}),
    ff AS MATERIALIZED (SELECT *,
             last_value(nullif(close, 0) IGNORE NULLS) OVER w AS lc,
             last_value(nullif(volume, 0) IGNORE NULLS) OVER w AS lv
           FROM tf WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    raw AS (SELECT f.asset, f.ts, f.high, f.low, f.close, f.volume, f.hour_of_day, f.day_of_week,
                   f.week_of_year, f.month, f.is_weekend, f.is_trading,
                   coalesce(f.time_to_delivery, {fill}) AS time_to_delivery, {", ".join(sel)}
            FROM ff f {" ".join(joins)})
    SELECT asset, ts, high, low, close, volume, hour_of_day, day_of_week, week_of_year, month, is_weekend,
           is_trading, time_to_delivery, {masked}
    FROM raw"""


def traded_sql(panel_sql: str) -> str:
    """Panel with the trading flag (sum rule)."""
    return f"SELECT *, (high + low + close + volume > 0)::INTEGER AS is_trading FROM ({panel_sql})"


def md5_key_sql(seed: int = 827) -> str:
    return f"md5('{seed}' || '|' || asset || '|' || epoch(ts)::BIGINT::VARCHAR)"


def islands_sql(traded: str) -> str:
    """Gaps and islands by row-number difference; island id = rank of its first timestamp."""
    return f"""
    WITH t AS ({traded}),
    g AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts)
                  - row_number() OVER (PARTITION BY asset, is_trading ORDER BY ts) AS grp FROM t),
    i AS (SELECT asset, grp, min(ts) AS island_start, count(*) AS island_len
          FROM g WHERE is_trading = 1 GROUP BY asset, grp),
    r AS (SELECT *, dense_rank() OVER (PARTITION BY asset ORDER BY island_start) AS island_no FROM i)
    SELECT g.*, r.island_no, r.island_len FROM g LEFT JOIN r ON r.asset = g.asset AND r.grp = g.grp
           AND g.is_trading = 1"""


def boundary_sql(traded: str, before: int = 4, after: int = 4) -> str:
    """Keep flag by explicit position ranges around starts and stops."""
    return f"""
    WITH t AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS pos,
                      is_trading - coalesce(lag(is_trading) OVER (PARTITION BY asset ORDER BY ts), 0) AS chg
               FROM ({traded})),
    starts AS (SELECT asset, pos AS s FROM t WHERE chg = 1),
    stops AS (SELECT asset, pos AS e FROM t WHERE chg = -1)
    SELECT t.*, (t.is_trading = 1
                 OR EXISTS (SELECT 1 FROM starts x WHERE x.asset = t.asset AND x.s BETWEEN t.pos AND t.pos + {before})
                 OR EXISTS (SELECT 1 FROM stops y WHERE y.asset = t.asset AND y.e BETWEEN t.pos - {after} AND t.pos)
                ) AS keep_boundary
    FROM t"""


def split_dates_sql(traded: str, val_start: str = "2024-01-22") -> str:
    return (f"SELECT *, CASE WHEN ts < TIMESTAMP '{val_start}' THEN 'train' ELSE 'val' END AS split "
            f"FROM ({traded})")


def scalers_sql(split: str) -> str:
    """Per contract x target mean / population std on trading training rows (zero std -> 1)."""
    parts = []
    for t in TARGETS:
        parts.append(f"""SELECT asset, '{t}' AS target, avg({t}) AS mean,
            CASE WHEN stddev_pop({t}) = 0 OR stddev_pop({t}) IS NULL THEN 1.0 ELSE stddev_pop({t}) END AS scale,
            count(*) AS n FROM ({split}) WHERE split = 'train' AND is_trading = 1 GROUP BY asset""")
    return " UNION ALL ".join(parts)


def eval_sql(rows: str, L_in: int = 24, L_out: int = 10, pred: str = "naive", levels=(0.1, 0.5, 0.9)) -> str:
    """Long evaluation frame by explicit self-join on positions (origin + 1 .. origin + L_out)."""
    targets = TARGETS
    if pred == "naive":
        fc = ", ".join(f"coalesce(last_value(nullif({t}, 0) IGNORE NULLS) OVER c, 0) AS f_{t}" for t in targets)
    elif pred == "quantile":
        med = sorted(levels)[len(levels) // 2]
        fc = ", ".join(f"quantile_cont({t}, {med}) OVER c AS f_{t}" for t in targets)
    else:
        raise ValueError(pred)
    y = "CASE tg.target " + " ".join(f"WHEN '{t}' THEN t.{t}" for t in targets) + " END"
    p = "CASE tg.target " + " ".join(f"WHEN '{t}' THEN o.f_{t}" for t in targets) + " END"
    return f"""
    WITH v AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS pos,
                      count(*) OVER (PARTITION BY asset) AS n_rows FROM ({rows})),
    d AS (SELECT asset, row_number() OVER (ORDER BY asset) - 1 AS idx FROM (SELECT DISTINCT asset FROM v)),
    o AS (SELECT v.*, d.idx, v.pos - {L_in - 1} AS start_pos, d.idx * 4294967296 + (v.pos - {L_in - 1}) AS window_id,
                 {fc}
          FROM v JOIN d USING (asset)
          WINDOW c AS (PARTITION BY v.asset ORDER BY v.ts ROWS BETWEEN {L_in - 1} PRECEDING AND CURRENT ROW)),
    origins AS (SELECT * FROM o WHERE pos >= {L_in - 1} AND pos + {L_out} < n_rows AND n_rows >= {L_in + L_out})
    SELECT o.window_id, o.asset, o.start_pos, (t.pos - o.pos)::INTEGER AS h, tg.target, t.ts AS target_ts,
           {y} AS y, {p}::DOUBLE AS p, t.is_trading::DOUBLE AS m
    FROM origins o JOIN v t ON t.asset = o.asset AND t.pos BETWEEN o.pos + 1 AND o.pos + {L_out}
    CROSS JOIN (VALUES ('high'), ('low'), ('close'), ('volume')) tg(target)"""


def smape_agg_sql(eps: float = 1e-6) -> str:
    return (f"CASE WHEN sum(m) = 0 THEN 0.0 ELSE "
            f"sum(m * 2.0 * abs(y - p) / (abs(y) + abs(p) + {eps})) / sum(m) END")


def stratified_sql(rows: str, frac: float = 0.1, seed: int = 827) -> str:
    return f"""
    SELECT * EXCLUDE (rk, n) FROM (
      SELECT *, row_number() OVER (PARTITION BY asset, is_trading ORDER BY {md5_key_sql(seed)}, ts) AS rk,
             count(*) OVER (PARTITION BY asset, is_trading) AS n
      FROM ({rows}))
    WHERE is_trading = 1 OR rk <= floor(n * {frac}::DOUBLE)"""


def hybrid_sql(rows: str, frac: float = 0.05, seed: int = 827) -> str:
    return f"""
    WITH b AS ({boundary_sql(rows)}),
    rest AS (SELECT asset, ts, row_number() OVER (PARTITION BY asset ORDER BY {md5_key_sql(seed)}, ts) AS rk,
                    count(*) OVER (PARTITION BY asset) AS n
             FROM b WHERE is_trading = 0 AND NOT keep_boundary)
    SELECT b.* EXCLUDE (pos, chg, keep_boundary) FROM b LEFT JOIN rest USING (asset, ts)
    WHERE b.keep_boundary OR rest.rk <= floor(rest.n * {frac}::DOUBLE)"""


def strategy_rows_sql(rows: str, name: str) -> str:
    if name == "Trading-Only":
        return f"SELECT * FROM ({rows}) WHERE is_trading = 1"
    if name == "Stratified":
        return stratified_sql(rows, 0.1)
    if name == "Boundary-Aware":
        return f"SELECT * EXCLUDE (pos, chg, keep_boundary) FROM ({boundary_sql(rows)}) WHERE keep_boundary"
    if name == "Hybrid":
        return hybrid_sql(rows, 0.05)
    raise ValueError(name)
