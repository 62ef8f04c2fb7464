"""Expected results published in FIXTURES.md section 3.3 (30-row window,
K = 1.5, H = 4.0) on the driver tables at sf0.001."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

EXPECTED = {  # symbol: (z rows, rows with null corr, max cusum, alerts, min z, max z, |z| > 2.5)
    "A": (1342, 47, 3.232731, 0, -3.3549, 3.2402, 31),
    "R": (1343, 58, 4.745061, 5, -4.1365, 3.7426, 34),
}


@pytest.fixture(scope="module")
def frames(spark):
    from seriesrel.operators import detect, metrics
    from seriesrel.operators.align import align
    from seriesrel.sources import fixtures as fx
    # The published numbers are those of one order priority.
    b = align(fx.lead_series(spark, SF_SMALL),
              fx.reference_series(spark, SF_SMALL, F.col("o_orderpriority") == "1-URGENT"))
    wide = metrics.rolling_metrics(b, {"30d": 30}).persist()
    long = metrics.to_long(wide, {"30d": 30})
    acc = detect.cusum(detect.metric_series(long)).persist()
    alerts = detect.cusum_alerts(long)
    return wide, acc, alerts


@pytest.mark.parametrize("symbol", sorted(EXPECTED))
def test_fixture_expectations(frames, symbol):
    wide, acc, alerts = frames
    z_rows, null_corr, max_s, n_alerts, min_z, max_z, n_far = EXPECTED[symbol]
    w = wide.where(F.col("symbol") == symbol)
    z = w.where(F.col("spread_zscore_30d").isNotNull())
    assert z.count() == z_rows
    assert z.where(F.col("pearson_corr_30d").isNull()).count() == null_corr
    a = acc.where(F.col("symbol") == symbol).agg(F.max("cusum")).first()[0]
    assert round(a, 6) == max_s
    assert alerts.where(F.col("symbol") == symbol).count() == n_alerts
    lo, hi = z.agg(F.min("spread_zscore_30d"), F.max("spread_zscore_30d")).first()
    assert (round(lo, 4), round(hi, 4)) == (min_z, max_z)
    assert z.where(F.abs("spread_zscore_30d") > 2.5).count() == n_far
