
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesrel.operators.metrics import metrics_long, rolling_metrics


def _bars(spark, lead, ref, symbol="brent"):
    dates = pd.date_range("2024-01-01", periods=len(lead), freq="D").date
    pdf = pd.DataFrame({"symbol": symbol, "date": dates, "lead_logret": lead, "ref_logret": ref})
    return spark.createDataFrame(pdf, "symbol string, date date, lead_logret double, ref_logret double")


def test_docstring_example_first_row(spark):
    b = _bars(spark, np.linspace(-0.01, 0.02, 20), np.linspace(0.0, 0.01, 20))
    long = metrics_long(b, {"10d": 10}).orderBy("date", "metric").collect()
    first = min(long, key=lambda r: (r["date"], ["pearson_corr", "beta", "spread_zscore"].index(r["metric"])))
    assert (first["symbol"], first["metric"]) == ("brent", "pearson_corr")


def frame_values(lead, ref, n):
    """Correlation, beta and z of each row's frame from the sums of the textbook formulas."""
    out = []
    for i in range(len(lead)):
        pairs = [(x, y) for x, y in zip(lead[max(0, i - n + 1):i + 1], ref[max(0, i - n + 1):i + 1])
                 if not (np.isnan(x) or np.isnan(y))]
        k = len(pairs)
        if k < n // 2 or k < 2:
            out.append((None, None, None))
            continue
        mx, my = (sum(p[j] for p in pairs) / k for j in (0, 1))
        sxx, syy = (sum((p[j] - m) ** 2 for p in pairs) for j, m in ((0, mx), (1, my)))
        sxy = sum((x - mx) * (y - my) for x, y in pairs)
        gaps = [x - y for x, y in pairs]
        mean = sum(gaps) / k
        var = sum((g - mean) ** 2 for g in gaps) / (k - 1)
        alone = [x for x in lead[max(0, i - n + 1):i + 1] if not np.isnan(x)]
        var_x = np.var(alone, ddof=1)
        here = lead[i] - ref[i]
        out.append((sxy / np.sqrt(sxx * syy) if sxx * syy > 1e-18 else None,
                    sxy / (k - 1) / var_x if var_x > 1e-18 else None,
                    (here - mean) / np.sqrt(var) if var > 1e-18 and not np.isnan(here) else None))
    return out


@pytest.mark.parametrize("n", [10, 30])
@pytest.mark.parametrize("holes", [False, True])
def test_rolling_matches_the_formulas(spark, n, holes):
    rng = np.random.default_rng(n)
    lead, ref = rng.normal(0, 0.02, 200), rng.normal(0, 0.01, 200)
    ref[120:170] = 0.0          # constant stretch: zero variance must give NULL, not an error
    b = _bars(spark, lead, ref)
    if holes:                   # every other reference missing at first
        gone = np.arange(200) < 60
        ref = np.where(gone & (np.arange(200) % 2 == 0), np.nan, ref)
        b = _bars(spark, lead, ref).withColumn("ref_logret", F.nanvl("ref_logret", F.lit(None).cast("double")))
    w = rolling_metrics(b, {"w": n}).orderBy("date").collect()
    for row, want in zip(w, frame_values(lead, ref, n), strict=True):
        for name, v in zip(("pearson_corr_w", "beta_w", "spread_zscore_w"), want, strict=True):
            assert (row[name] is None) == (v is None), (row, want)
            assert v is None or abs(row[name] - v) < 1e-7


def test_long_skips_nulls(spark):
    b = _bars(spark, np.linspace(-0.01, 0.02, 12), np.zeros(12))
    long = metrics_long(b, {"10d": 10})
    assert long.where("value IS NULL").count() == 0
    # zero-variance reference: correlation absent, beta and z present
    metrics = {r["metric"] for r in long.collect()}
    assert "pearson_corr" not in metrics and {"beta", "spread_zscore"} <= metrics
