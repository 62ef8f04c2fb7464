"""Scale properties of the physical plans (checked on sf0.001 inputs)."""

import re
from collections import Counter

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _q(name, spark):
    import __spark_entry__ as e
    return e.queries()[name](spark, SF_SMALL)


def test_scans_prune_columns_and_push_filters(spark):
    plan = _plan(_q("aligned_bars", spark))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    li = [s for s in schemas if "l_extendedprice" in s]
    od = [s for s in schemas if "o_totalprice" in s]
    assert li and all(len(s.split(",")) == 3 for s in li)     # flag, price, ship date only
    assert od and all(len(s.split(",")) == 2 for s in od)     # price, order date


def test_feature_chain_scans_once_and_shares_one_symbol_exchange(spark):
    plan = _plan(_q("classification_report", spark))
    assert plan.count("lineitem.parquet") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", plan)) == 1
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_cusum_chain_adds_no_exchange_after_metrics(spark):
    metrics = _plan(_q("metrics_long", spark))
    alerts = _plan(_q("cusum_alerts", spark))
    count = lambda p: len(re.findall(r"Exchange (hash|range|single)", p, flags=re.I))
    assert count(alerts) == count(metrics)


def test_no_python_in_the_hot_path(spark):
    for name in ("metrics_long", "cusum_alerts", "features_lagged", "envelope_validate",
                 "route_lead", "series_union_first_wins", "aligned_bars_blocked"):
        plan = _plan(_q(name, spark))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "FlatMapGroupsInPandas" not in plan, name
    assert "FlatMapGroupsInPandas" in _plan(_q("changepoints", spark))   # the one grouped map


def test_dedupe_is_reduced_map_side(spark):
    plan = _plan(_q("series_union_first_wins", spark))
    assert "partial_min_by" in plan


def test_panels_read_chunks_and_keys_of_stored_tables(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)      # whole filter lists
    try:
        for name in ("panel_price", "panel_zscore_30d", "sql_panel_zscore_30d"):
            plan = _plan(_q(name, spark))
            assert "lineitem.parquet" not in plan and "orders.parquet" not in plan, name
            assert re.search(r"PartitionFilters: \[[^\]]*chunk#\d+ >= ", plan), name
            assert re.search(r"PushedFilters: \[[^\]]*Equal(To|NullSafe)\(symbol,A\)", plan), name
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_alerts_of_both_detectors_are_served(spark):
    kinds = Counter()
    for r in _q("detect_alerts", spark).collect():
        kinds[r["kind"], r["fired_at"].year] += 1
    got = {(r["kind"], r["year"]): r["n_alerts"] for r in _q("alert_counts_all_kinds", spark).collect()}
    assert got == kinds
    every = sorted(_q("detect_alerts", spark).collect(), key=lambda r: (-r["fired_at"].toordinal(), r["kind"], r["symbol"], r["horizon"]))[:50]
    newest = _q("latest_alerts_all_kinds", spark).collect()
    assert sorted((r["fired_at"], r["kind"], r["symbol"], r["horizon"]) for r in newest) == sorted(
        (r["fired_at"], r["kind"], r["symbol"], r["horizon"]) for r in every)
