"""Rolling relationship metrics, wide and long.

Per symbol and window of ``n`` rows (current row included), gated by
``min_periods = n // 2`` rows in the frame:

* ``pearson_corr`` = sample corr(lead, ref)
* ``beta``         = cov(ref, lead) / var(lead)
* ``spread_zscore``= (s - mean(s)) / std(s), s = lead - ref

All windows of all horizons share ``partitionBy(symbol).orderBy(date)``, so
Catalyst evaluates them in one Window operator after one exchange. The long
form drops NULL values (a metric that cannot be computed is absent, not NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ANOMALY_CUT, METRICS, WINDOWS
from ..functions.columns import (gate, rolling_beta, rolling_pearson,
                                 rolling_zscore, series_window, trailing)

METRIC_LONG_COLUMNS = ("symbol", "date", "horizon", "metric", "value")


def metric_column(metric: str, horizon: str) -> str:
    return f"{metric}_{horizon}"


def rolling_metrics(bars: DataFrame, windows: dict[str, int] = WINDOWS, *,
                    keys: tuple[str, ...] = ("symbol",), order: str = "date",
                    lead_col: str = "lead_logret", ref_col: str = "ref_logret",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Wide frame: keys, order, ``keep`` columns and ``<metric>_<horizon>``."""
    w = series_window(list(keys), order)
    spread = F.col(lead_col) - F.col(ref_col)
    both = F.when(spread.isNotNull(), 1)
    lead, ref = F.when(spread.isNotNull(), F.col(lead_col)), F.when(spread.isNotNull(), F.col(ref_col))
    cols = [*keys, order, *keep]
    for h, n in windows.items():
        frame = trailing(w, n)
        # min_periods counts observations: rows where both sides are there.
        n_rows = F.count(both).over(frame)
        mp = n // 2
        cols += [
            gate(n_rows, mp, rolling_pearson(lead, ref, frame))
            .alias(metric_column("pearson_corr", h)),
            gate(n_rows, mp, rolling_beta(ref_col, lead_col, frame))
            .alias(metric_column("beta", h)),
            gate(n_rows, mp, rolling_zscore(spread, frame))
            .alias(metric_column("spread_zscore", h)),
        ]
    return bars.select(*cols)


def to_long(wide: DataFrame, windows: dict[str, int] = WINDOWS, *,
            keys: tuple[str, ...] = ("symbol",), order: str = "date",
            metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Wide -> long (keys, order, horizon, metric, value), NULL values skipped."""
    entries = [
        F.struct(F.lit(h).alias("horizon"), F.lit(m).alias("metric"),
                 F.col(metric_column(m, h)).alias("value"))
        for h in windows for m in metrics
    ]
    long = wide.select(*keys, order, F.inline(F.array(*entries)))
    return long.where(F.col("value").isNotNull())


def metrics_long(bars: DataFrame, windows: dict[str, int] = WINDOWS, **kw) -> DataFrame:
    """Rolling metrics of aligned bars in long format."""
    return to_long(rolling_metrics(bars, windows, **kw), windows)


def metric_summary(long: DataFrame) -> DataFrame:
    """avg / min / max / count of each metric by symbol x horizon, with
    subtotals over symbols, over horizons and overall (grouping sets)."""
    return (long.groupingSets(
                [["metric", "symbol", "horizon"], ["metric", "symbol"],
                 ["metric", "horizon"], ["metric"]],
                "metric", "symbol", "horizon")
            .agg(F.avg("value").alias("avg_value"),
                 F.min("value").alias("min_value"),
                 F.max("value").alias("max_value"),
                 F.count(F.lit(1)).alias("n_rows")))


def anomaly_share(long: DataFrame, cut: float = ANOMALY_CUT,
                  metric: str = "spread_zscore") -> DataFrame:
    """Share of rows with |z| > cut per symbol and horizon."""
    z = long.where(F.col("metric") == metric)
    flag = (F.abs(F.col("value")) > F.lit(cut)).cast("double")
    return (z.groupBy("symbol", "horizon")
             .agg(F.avg(flag).alias("anomalous_share"),
                  F.sum(flag).cast("bigint").alias("n_anomalous"),
                  F.count(F.lit(1)).alias("n_rows")))
