"""The chunked search against the whole one."""

import datetime as dt

import numpy as np
import pytest

from seriesrel.operators import changepoints_blocked as cb
from seriesrel.operators.changepoints import changepoint_alerts, pelt_rbf

SCHEMA = "symbol string, horizon string, date date, metric string, value double"


def rows(name, values):
    return [(name, "30d", dt.date(2000, 1, 1) + dt.timedelta(days=k), "spread_zscore", None if v is None else float(v)) for k, v in enumerate(values)]


def cases():
    r = np.random.default_rng(8)
    steps = np.concatenate([r.normal(m, 0.3, n) for m, n in ((0, 61), (4, 40), (0, 33), (0.2, 57), (-5, 20), (2, 12))])
    return {"steps": steps, "noise": r.normal(0, 1, 118), "flat": np.full(77, 2.5), "short": r.normal(0, 1, 3), "tiny": [1.0, 2.0, 1.5, 9.0, 9.5],
            "edge": np.concatenate([r.normal(0, 1, 60), r.normal(6, 1, 60)])}


@pytest.mark.parametrize("pen, min_size, jump, chunk", [(3.0, 2, 5, 60), (1.5, 7, 5, 41)])
def test_chunks_give_the_same_breaks(spark, pen, min_size, jump, chunk):
    series = cases()
    data = [x for name, values in series.items() for x in rows(name, values)] + rows("nulls", [None] * 9)
    got = cb.changepoints_blocked(spark.createDataFrame(data, SCHEMA), pen=pen, min_size=min_size, jump=jump, chunk_rows=chunk).collect()
    want = {(name, b, dt.date(2000, 1, 1) + dt.timedelta(days=b)) for name, values in series.items() for b in pelt_rbf(values, pen, min_size, jump)}
    assert {(g.symbol, g.bkp_index, g.date) for g in got} == want and len(got) == len(want) > 4


def test_no_series(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cb.changepoints_blocked(empty).count() == 0
    assert changepoint_alerts(empty, blocked=True).count() == 0


def test_gap_counts():
    r = np.random.default_rng(1)
    a, b = np.sort(r.integers(0, 9, 30) / 4), np.sort(r.integers(0, 9, 25) / 4)
    for gap in (0.0, 0.25, 1.0, 9.0):
        assert cb._gaps_up_to(a, b, gap) == sum(max(x, y) <= min(x, y) + gap for x in a for y in b)
        assert cb._gaps_up_to(a, None, gap) == sum(y <= x + gap for i, x in enumerate(a) for y in a[i + 1:])
