import numpy as np
import pytest
import pandas as pd

from seriesrel.operators.changepoints import changepoint_alerts, changepoints, pelt_rbf


def test_planted_mean_shifts():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 1, 200), rng.normal(4, 1, 150), rng.normal(-2, .5, 250)])
    assert pelt_rbf(x) == [200, 350]


def test_constant_and_short_series():
    assert pelt_rbf(np.ones(50)) == []
    assert pelt_rbf(np.array([1.0, 2.0, 3.0])) == []


def test_grouped_map_over_many_series(spark):
    rng = np.random.default_rng(3)
    frames = []
    for sym, shift in [("a", 120), ("b", 80)]:
        v = np.concatenate([rng.normal(0, 1, shift), rng.normal(5, 1, 200 - shift)])
        frames.append(pd.DataFrame({"symbol": sym, "date": pd.date_range("2001-01-01", periods=200).date,
                                    "horizon": "30d", "metric": "spread_zscore", "value": v}))
    long = spark.createDataFrame(pd.concat(frames),
                                 "symbol string, date date, horizon string, metric string, value double")
    got = {(r["symbol"], r["bkp_index"]) for r in changepoints(long).collect()}
    assert got == {("a", 120), ("b", 80)}
    alerts = changepoint_alerts(long).collect()
    assert {a["kind"] for a in alerts} == {"regime_change"}
    assert any(a["description"] == "Statistical regime change detected at index 120" for a in alerts)


def _brute_force(x, pen=3.0, min_size=2, jump=5):
    """Optimal partition by exhaustive dynamic programming over the same
    candidate grid, with the kernel built directly (no pruning, no sums)."""
    n = len(x)
    d = (x[:, None] - x[None, :]) ** 2
    iu = np.triu_indices(n, 1)
    med = np.median(d[iu])
    k = np.exp(-np.clip(d / (med if med else 1.0), 1e-2, 1e2))
    np.fill_diagonal(k, 1.0)

    def cost(s, e):
        return (e - s) - k[s:e, s:e].sum() / (e - s)

    ends = [g for g in range(0, n, jump) if g >= min_size] + [n]
    ends = sorted(set(ends))
    best = {0: (0.0, [])}
    for e in ends:
        cands = [(best[s][0] + cost(s, e) + pen, best[s][1] + [e])
                 for s in best if s < e and e - s >= min_size and s <= ((e - min_size) // jump) * jump]
        best[e] = min(cands, key=lambda c: c[0])
    return best[n][1][:-1], best[n][0]


@pytest.mark.parametrize("seed,n", [(0, 60), (1, 97), (2, 143), (3, 201)])
def test_pelt_equals_exhaustive_search(seed, n):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, n) + np.where(np.arange(n) > n // 2, rng.uniform(1, 3), 0)
    bkps, _ = _brute_force(x)
    assert pelt_rbf(x) == bkps


@pytest.mark.parametrize("n", [2, 3, 10, 51, 200])
def test_median_gap_equals_listing(n):
    from seriesrel.operators.changepoints import _median_squared_gap
    rng = np.random.default_rng(n)
    for x in (rng.normal(0, 1, n), np.round(rng.normal(0, 1, n)), np.ones(n)):
        gaps = (x[:, None] - x[None, :])[np.triu_indices(n, 1)] ** 2
        assert np.isclose(_median_squared_gap(x), np.median(gaps), rtol=1e-12, atol=0)


@pytest.mark.parametrize("pen,min_size,jump", [(3.0, 2, 5), (1.0, 3, 1), (0.5, 4, 2), (3.0, 7, 5)])
def test_other_grids_equal_exhaustive_search(pen, min_size, jump):
    rng = np.random.default_rng(11)
    x = np.repeat(rng.normal(0, 2, 8), 13) + rng.normal(0, 0.3, 104)
    if min_size <= jump:
        assert pelt_rbf(x, pen, min_size, jump) == _brute_force(x, pen, min_size, jump)[0]
    else:
        assert all(b % jump == 0 for b in pelt_rbf(x, pen, min_size, jump))


def test_long_series_has_no_limit():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(6 * (k % 2), 1, 700) for k in range(30)])
    assert pelt_rbf(x) == list(range(700, 21_000, 700))
