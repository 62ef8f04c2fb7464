import numpy as np
import pandas as pd
import pytest

from seriesrel.operators import blocked
from seriesrel.operators.align import align
from seriesrel.operators.detect import cusum, hysteresis_fires
from seriesrel.operators.features import features_from_bars, time_folds
from seriesrel.operators.metrics import rolling_metrics
from seriesrel.operators.moments import rolling_metrics_merged


def _frame(spark, n, seed, symbols=("a", "b")):
    rng = np.random.default_rng(seed)
    rows = []
    for s in symbols:
        dates = pd.date_range("2000-01-01", periods=n, freq="D").date
        rows.append(pd.DataFrame({"symbol": s, "date": dates,
                                  "lead_logret": rng.normal(0, .02, n),
                                  "ref_logret": np.where(rng.random(n) < .2, 0.0, rng.normal(0, .01, n))}))
    return spark.createDataFrame(pd.concat(rows),
                                 "symbol string, date date, lead_logret double, ref_logret double")


def _same(a, b, keys):
    a = a.sort_values(keys).reset_index(drop=True)
    b = b.sort_values(keys).reset_index(drop=True)
    assert list(a[keys].itertuples(index=False)) == list(b[keys].itertuples(index=False))
    for c in a.columns:
        if c in keys:
            continue
        x, y = a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float)
        assert (np.isnan(x) == np.isnan(y)).all(), c
        assert np.allclose(x[~np.isnan(x)], y[~np.isnan(y)], atol=1e-9), c


@pytest.mark.parametrize("chunk_rows", [59, 97, 400])
def test_rolling_blocked_equals_plain(spark, chunk_rows):
    bars = _frame(spark, 300, chunk_rows)
    plain = rolling_metrics(bars).toPandas()
    blk = blocked.rolling_metrics_blocked(bars, chunk_rows=chunk_rows).toPandas()[plain.columns]
    _same(plain, blk, ["symbol", "date"])


def test_merged_moments_in_chunks_equal_plain(spark):
    bars = _frame(spark, 300, 5)
    plain = rolling_metrics(bars).toPandas()
    blk = blocked.rolling_metrics_blocked(bars, chunk_rows=70, rolling=rolling_metrics_merged).toPandas()[plain.columns]
    _same(plain, blk, ["symbol", "date"])


@pytest.mark.parametrize("chunk_rows", [1, 20])
def test_halo_may_be_longer_than_a_chunk(spark, chunk_rows):
    bars = _frame(spark, 90, 3)
    plain = rolling_metrics(bars).toPandas()
    blk = blocked.rolling_metrics_blocked(bars, chunk_rows=chunk_rows).toPandas()[plain.columns]
    _same(plain, blk, ["symbol", "date"])


@pytest.mark.parametrize("chunk_rows", [1, 13, 500])
def test_features_and_folds_blocked_equal_plain(spark, chunk_rows):
    bars = _frame(spark, 120, chunk_rows)
    plain = features_from_bars(bars)
    blk = blocked.features_from_bars_blocked(bars, chunk_rows=chunk_rows)
    assert set(blk.columns) == set(plain.columns)
    _same(plain.toPandas(), blk.toPandas()[plain.columns], ["symbol", "date"])
    cols = ["symbol", "date", "row_index", "fold", "role"]
    folds = blocked.time_folds_blocked(plain, chunk_rows=chunk_rows).select(cols)
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, time_folds(plain).select(cols).collect()))


@pytest.mark.parametrize("chunk_rows", [1, 7, 50])
def test_cusum_and_latch_blocked_equal_plain(spark, chunk_rows):
    rng = np.random.default_rng(chunk_rows)
    pdf = pd.concat([pd.DataFrame({"symbol": s, "horizon": h,
                                   "date": pd.date_range("2001-01-01", periods=150).date,
                                   "value": rng.normal(0, 2, 150)})
                     for s in "xy" for h in ("30d", "60d")])
    series = spark.createDataFrame(pdf, "symbol string, horizon string, date date, value double")
    plain = cusum(series).toPandas()
    blk = blocked.cusum_blocked(series, chunk_rows=chunk_rows).toPandas()[plain.columns]
    _same(plain, blk, ["symbol", "horizon", "date"])
    f1 = sorted(map(tuple, hysteresis_fires(cusum(series)).select("symbol", "horizon", "date").collect()))
    f2 = sorted(map(tuple, blocked.hysteresis_fires_blocked(
        blocked.cusum_blocked(series, chunk_rows=chunk_rows)).select("symbol", "horizon", "date").collect()))
    assert f1 == f2 and len(f1) > 0


@pytest.mark.parametrize("chunk_rows", [1, 13])
def test_align_blocked_equals_plain(spark, chunk_rows):
    rng = np.random.default_rng(5)
    d = pd.date_range("2002-01-01", periods=80).date
    lead = pd.DataFrame({"symbol": np.repeat(["a", "b"], 80), "date": np.tile(d, 2),
                         "price": rng.uniform(50, 60, 160)})
    lead.loc[[5, 6, 90], "price"] = [np.nan, 0.0, -1.0]
    keep = rng.random(80) < 0.6
    ref = pd.DataFrame({"date": d[keep], "rate": rng.uniform(400, 500, keep.sum())})
    l = spark.createDataFrame(lead, "symbol string, date date, price double")
    r = spark.createDataFrame(ref, "date date, rate double")
    plain = align(l, r).toPandas()
    blk = blocked.align_blocked(l, r, chunk_rows=chunk_rows).toPandas()[plain.columns]
    _same(plain.drop(columns=["horizon"]), blk.drop(columns=["horizon"]), ["symbol", "date"])


def test_batch_run_blocked_equals_plain(spark):
    from conftest import SF_SMALL
    from seriesrel.plans.batch import run_analytics
    from seriesrel.session import scratch_path
    from seriesrel.sources import fixtures as fx
    lead, ref = fx.lead_series(spark, SF_SMALL), fx.reference_series(spark, SF_SMALL)
    a = run_analytics(spark, lead, ref, scratch_path(spark, "t-plain"), with_changepoints=False)
    b = run_analytics(spark, lead, ref, scratch_path(spark, "t-blk"), with_changepoints=False,
                      chunk_rows=300)
    assert a.written == b.written
    for t in ("aligned_bars", "relationship_metrics", "alerts"):
        x = spark.read.parquet(a.path(t)).drop("chunk")
        y = spark.read.parquet(b.path(t)).drop("chunk")
        cols = [c for c in x.columns if c not in ("value", "lead_logret", "ref_logret")]
        assert x.select(*cols).exceptAll(y.select(*cols)).count() == 0


def test_index_rows_hot_key_spans_partitions(spark):
    from pyspark.sql import functions as F
    hot = spark.range(6000).select(F.lit("hot").alias("symbol"),
                                   F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    cold = spark.range(7).select(F.lit("cold").alias("symbol"),
                                 F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    rows = hot.unionByName(cold)
    # the range partitioning index_rows starts from spreads the hot key
    spread = rows.repartitionByRange(16, "symbol", "date").select(F.spark_partition_id().alias("p"),
                                                                  "symbol")
    assert spread.where("symbol = 'hot'").select("p").distinct().count() > 4
    ix = blocked.index_rows(rows, ("symbol",), "date", partitions=16)
    plan = ix._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan                       # one row per partition
    pdf = ix.toPandas().sort_values(["symbol", "date"])
    assert list(pdf["_idx"]) == list(range(len(pdf)))       # global positions
    for s, g in pdf.groupby("symbol"):                       # contiguous per key
        assert list(g["_idx"]) == list(range(g["_idx"].min(), g["_idx"].min() + len(g)))


@pytest.mark.parametrize("chunk_rows", [3, 50])
def test_align_blocked_with_repeated_reference_days(spark, chunk_rows):
    rng = np.random.default_rng(chunk_rows)
    days = pd.date_range("2020-01-01", periods=40, freq="D").date
    lead = spark.createDataFrame([(s, d, float(p)) for s in "ab" for d, p in zip(days, rng.random(40) + 1)], "symbol string, date date, price double")
    ref = spark.createDataFrame([(days[i], None if i % 7 == 0 else float(i + 1 + k)) for i in range(2, 40, 2) for k in range(1 + i % 3)], "date date, rate double")
    _same(align(lead, ref).toPandas(), blocked.align_blocked(lead, ref, chunk_rows=chunk_rows).toPandas(), ["symbol", "date", "horizon"])
