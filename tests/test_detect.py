import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesrel.operators.detect import cusum, hysteresis_fires


def loop_cusum(z, k):
    s = np.zeros(len(z))
    for i in range(1, len(z)):
        s[i] = max(0.0, s[i - 1] + abs(z[i]) - k)
    return s


def loop_fires(s, k, h):
    fired, on = [], False
    for i, v in enumerate(s):
        if v >= h and not on:
            on = True
            fired.append(i)
        elif v < k:
            on = False
    return fired


def _series(spark, values, keys=("s1", "30d")):
    dates = pd.date_range("2000-01-01", periods=len(values), freq="D").date
    pdf = pd.DataFrame({"symbol": keys[0], "horizon": keys[1], "date": dates, "value": values})
    return spark.createDataFrame(pdf, "symbol string, horizon string, date date, value double")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-6, 6), min_size=1, max_size=120),
       st.sampled_from([(1.5, 4.0), (1.0, 1.2), (0.8, 2.0)]))
def test_cusum_and_hysteresis_match_loop(spark, values, kh):
    k, h = kh
    acc = cusum(_series(spark, values), threshold=k).orderBy("date").toPandas()
    expect = loop_cusum(np.array(values), k)
    assert np.allclose(acc["cusum"].to_numpy(), expect, atol=1e-9)
    fired = hysteresis_fires(cusum(_series(spark, values), threshold=k), trigger=h, threshold=k)
    got = sorted((r["date"] - dt.date(2000, 1, 1)).days for r in fired.collect())
    assert got == loop_fires(expect, k, h)


def test_series_are_independent(spark):
    a = _series(spark, [0, 5, 5, 5, 0, 0], ("a", "30d"))
    b = _series(spark, [0, 0.1, 0.1, 9, 9, 9], ("a", "60d"))
    acc = cusum(a.unionByName(b)).toPandas().sort_values(["horizon", "date"])
    assert np.allclose(acc[acc.horizon == "30d"].cusum, loop_cusum(np.array([0, 5, 5, 5, 0, 0.]), 1.5))
    assert np.allclose(acc[acc.horizon == "60d"].cusum, loop_cusum(np.array([0, .1, .1, 9, 9, 9]), 1.5))
