import datetime as dt

import numpy as np
import pytest

from seriesrel.operators.metrics import metrics_long, rolling_metrics
from seriesrel.operators.moments import metrics_long_merged, rolling_metrics_merged

SCHEMA = "symbol string, date date, lead_logret double, ref_logret double"
DAY = dt.date(2000, 1, 1)


def _frame(spark, series: dict):
    rows = [(s, DAY + dt.timedelta(days=i), x, y) for s, pairs in series.items() for i, (x, y) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def _brute(pairs, i, n):
    """corr, beta, z-score of the frame that ends at row i, in the two-pass form."""
    part = pairs[max(0, i - n + 1):i + 1]
    both = [(x, y) for x, y in part if x is not None and y is not None]
    if len(both) < max(n // 2, 2):
        return None, None, None
    x, y = (np.array(v, dtype=np.longdouble) for v in zip(*both))
    lead = np.array([a for a, _ in part if a is not None], dtype=np.longdouble)
    s = np.array([a - b for a, b in both])
    co = ((x - x.mean()) * (y - y.mean())).sum() / (len(x) - 1)
    sx, sy, sl = x.std(ddof=1), y.std(ddof=1), lead.std(ddof=1)
    here = pairs[i]
    z = (None if here[0] is None or here[1] is None or len(set(s)) == 1
         else (np.longdouble(here[0] - here[1]) - s.astype(np.longdouble).mean()) / s.astype(np.longdouble).std(ddof=1))
    flat_x, flat_y, flat_l = (len(set(v)) == 1 for v in (x, y, lead))
    return (None if flat_x or flat_y else co / (sx * sy), None if flat_l else co / sl ** 2, z)


def _series(seed, size, offset=0.0, null_share=0.0, flat=False):
    rng = np.random.default_rng(seed)
    x, y = offset + rng.normal(0, 1, size), offset + rng.normal(0, 1, size)
    if flat:                                   # stretches without a change, longer than a window
        x[20:60] = 0.1
        y[35:90] = 0.1
    hide = rng.random((size, 2)) < null_share
    return [(None if a else float(u), None if b else float(v)) for u, v, (a, b) in zip(x, y, hide)]


@pytest.mark.parametrize("windows", [{"w": 7, "v": 16}, {"w": 1}, {"w": 2}, {"w": 30, "v": 60}])
def test_merged_equals_brute_force_and_plain(spark, windows):
    series = {"plain": _series(1, 130), "short": _series(2, 5), "one": _series(3, 1),
              "nulls": _series(4, 130, null_share=.3), "flat": _series(5, 130, flat=True),
              "all_null": [(None, None)] * 40, "constant": [(0.1, 0.3)] * 70}
    bars = _frame(spark, series)
    got = {(r["symbol"], r["date"]): r for r in rolling_metrics_merged(bars, windows).collect()}
    plain = {(r["symbol"], r["date"]): r for r in rolling_metrics(bars, windows).collect()}
    assert got.keys() == plain.keys() and len(got) == sum(map(len, series.values()))
    for s, pairs in series.items():
        for i in range(len(pairs)):
            at = (s, DAY + dt.timedelta(days=i))
            for h, n in windows.items():
                for m, want in zip(("pearson_corr", "beta", "spread_zscore"), _brute(pairs, i, n)):
                    mine, other = got[at][f"{m}_{h}"], plain[at][f"{m}_{h}"]
                    assert (mine is None) == (want is None) == (other is None), (at, m, h, mine, want, other)
                    if want is not None:
                        assert mine == pytest.approx(float(want), abs=1e-9, rel=1e-9), (at, m, h)
                        assert mine == pytest.approx(other, abs=1e-9, rel=1e-9), (at, m, h)


def test_offset_data_lose_no_digits(spark):
    pairs = _series(6, 200, offset=1e8)
    got = rolling_metrics_merged(_frame(spark, {"a": pairs}), {"w": 30}).orderBy("date").collect()
    for i, r in enumerate(got):
        for m, want in zip(("pearson_corr", "beta", "spread_zscore"), _brute(pairs, i, 30)):
            if want is not None:
                assert r[f"{m}_w"] == pytest.approx(float(want), abs=1e-9, rel=1e-9), (i, m)


def test_long_form_of_empty_and_kept_columns(spark):
    bars = _frame(spark, {"a": _series(7, 80)})
    assert metrics_long_merged(bars.limit(0)).collect() == []
    assert metrics_long_merged(bars).count() == metrics_long(bars).count()
    kept = rolling_metrics_merged(bars, keep=("lead_logret",))
    assert kept.columns == rolling_metrics(bars, keep=("lead_logret",)).columns
    assert kept.where("lead_logret is null").count() == 0


def test_one_exchange(spark):
    bars = _frame(spark, {"a": _series(8, 80)})
    plan = rolling_metrics_merged(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
