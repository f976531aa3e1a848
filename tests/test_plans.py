"""Physical-plan shape checks: pushdown, pruning, exchanges, no Cartesian products."""

import re

import __spark_entry__ as E

from panel_helpers import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_scan_prunes_columns(spark):
    from quarterline.sources.candles import events_candles
    txt = plan_text(events_candles(spark, SF_SMALL, 900))
    m = re.search(r"ReadSchema: struct<([^>]*)>", txt)
    assert m, txt
    cols = {c.split(":")[0] for c in m.group(1).split(",")}
    assert cols == {"event_id", "ts", "user_id", "value"}


def test_event_candles_stay_on_hash_aggregate(spark):
    """The close's (ts, event_id) order is a packed DECIMAL, so no map-side sort of the ticks."""
    from quarterline.sources.candles import events_candles
    txt = plan_text(events_candles(spark, SF_SMALL, 900))
    assert "HashAggregate" in txt and "SortAggregate" not in txt and "ObjectHashAggregate" not in txt


def test_flagship_two_panel_exchanges(spark):
    import __spark_entry__ as E
    df = E.queries()["features_1h"](spark, SF_SMALL)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt
    # hash exchanges by asset (as-of fill) and by ts (neighbours) on the panel path
    assert len(re.findall(r"Exchange hashpartitioning\(ts#", txt)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(asset#", txt)) >= 1


def test_filter_pushdown_on_split_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter("l_shipdate >= '1999-01-01'").select("l_quantity")
    txt = plan_text(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in txt


def test_incremental_ingest_partial_skip(spark):
    """A second ingest writes only the new contracts and reports the skipped ones; the
    report comes from observations on the single write job."""
    from quarterline.plans.ingest_plans import raw_csv_export
    from quarterline.session import scratch_path
    from quarterline.sources.csv_ingest import ingest_csv
    csv = raw_csv_export(spark, SF_SMALL)
    raw = spark.read.option("header", True).csv(csv)
    names = sorted(r.ID for r in raw.select("ID").distinct().collect() if r.ID is not None)
    first = scratch_path(spark, "raw-first")
    raw.filter(raw.ID.isin(names[:5])).write.option("header", True).csv(first)
    out = scratch_path(spark, "panel")
    r1 = ingest_csv(spark, first, out).first()
    r2 = ingest_csv(spark, csv, out, force=False).first()
    n_first = raw.filter(raw.ID.isin(names[:5])).count()
    n_rest = raw.filter(raw.ID.isin(names[5:])).count()
    assert (r1.rows, r1.assets, r1.assets_skipped) == (n_first, 5, 0)
    assert (r2.rows, r2.assets, r2.assets_skipped) == (n_rest, len(names) - 5, 5)
    assert spark.read.parquet(out).count() == n_first + n_rest


def test_window_ids_need_no_arrays(spark):
    for name in ("r05_batches_shards", "r06_epoch_shuffle_order"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan, name


def test_panels_are_pruned_scans(spark):
    df = E.queries()["a08_scalers"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "FileScan parquet" in plan
