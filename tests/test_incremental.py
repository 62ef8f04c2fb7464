"""Increments against one full run, and the chunks they read."""

import datetime as dt
import random

from pyspark.sql import functions as F

from seriesrel.operators.align import align
from seriesrel.operators.detect import cusum_alerts
from seriesrel.operators.metrics import metrics_long
from seriesrel.plans import incremental as inc
from seriesrel.session import scratch_path
from seriesrel.sources import tables

DAY = dt.date(2020, 1, 1)


def day(k):
    return DAY + dt.timedelta(days=k)


def series(n=130):
    r = random.Random(4)
    lead = [(s, day(k), None if (k, s) in ((40, "a"), (101, "b")) else 50 + 40 * r.random() * (9 if k % 37 == 0 else 1))
            for s, start in (("a", 0), ("b", 3), ("late", 95)) for k in range(start, n) if r.random() < 0.93 or k == start]
    ref = [(day(k), None if k == 60 else 400 + r.random()) for k in range(5, n) if r.random() < 0.7]
    return lead, ref + [(ref[3][0], 1.0)]                       # a repeated reference day


WINDOWS = {"8d": 8, "20d": 20}


def values(df, *keys):
    return {tuple(r[k] for k in keys): {c: v for c, v in r.asDict().items() if c not in ("chunk", *keys)} for r in df.collect()}


def test_day_by_day_equals_one_run(spark):
    lead, ref = series()
    schema = "symbol string, date date, price double"
    whole, rates = spark.createDataFrame(lead, schema), spark.createDataFrame(ref, "date date, rate double")
    root = scratch_path(spark, "test-increment")
    for end in (90, 91, 99, 130):
        got = inc.run_increment(spark, spark.createDataFrame([x for x in lead if x[1] < day(end)], schema),
                                rates, root, windows=WINDOWS, threshold=0.8, trigger=2.0)
        assert all(got.values()) or end == 91
    again = inc.run_increment(spark, whole, rates, root, windows=WINDOWS, threshold=0.8, trigger=2.0)
    assert not any(again.values()) and inc.current_version(spark, root) == 4
    bars = align(whole, rates)
    long = metrics_long(bars, WINDOWS)
    alerts = cusum_alerts(long, threshold=0.8, trigger=2.0)
    for want, spec in ((bars, tables.BARS), (long, tables.METRICS), (alerts, tables.ALERTS)):
        stored = spark.read.parquet(f"{root}/{spec.name}")
        a, b = values(want, *spec.key), values(stored, *spec.key)
        assert a == b and stored.count() == len(a) > 3, spec.name
    late = inc.late_rows(whole, inc.read_state(spark, root), since=day(120))
    assert late.count() == sum(x[1] > day(120) for x in lead)


def test_increment_reads_new_chunks_only(spark):
    lead, ref = series(100)
    root = scratch_path(spark, "test-increment-chunks")
    rows = spark.createDataFrame(lead, "symbol string, date date, price double").where(F.col("symbol") != "late")
    tables.insert_if_absent(rows, f"{root}/lead", inc.LEAD)
    state = inc.advance(rows, spark.createDataFrame(ref, "date date, rate double"), None).state
    plan = inc.stored_since(spark, f"{root}/lead", inc.LEAD, state)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan and "2020-04-01" in plan
    assert inc.current_version(spark, root) is None and inc.read_state(spark, root) is None


def test_state_does_not_go_through_the_driver(spark):
    lead, ref = series(100)
    rows = spark.createDataFrame(lead, "symbol string, date date, price double")
    state = inc.advance(rows, spark.createDataFrame(ref, "date date, rate double"), None, windows=WINDOWS).state
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
