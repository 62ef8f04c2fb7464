"""CUSUM accumulator, hysteresis alerts and the alert table.

The reference runs a per-row loop ``s_i = max(0, s_{i-1} + |z_i| - K)`` with
``s_0 = 0`` (the first observation is ignored). That recursion has a closed
form which is two running windows, so no UDF and no per-row Python:

    x_0 = 0,  x_i = |z_i| - K,  P_i = sum_{j<=i} x_j
    s_i = P_i - min(0, min_{j<=i} P_j)

Hysteresis: fire when ``s >= H`` and not latched; unlatch when ``s < K``;
keep the latch in between. As windows: ``mark = 1 if s >= H, 0 if s < K,
else NULL``; a row fires when mark = 1 and the last non-null mark before it
is 0 (or there is none).

All windows here share the partitioning of the metric series (symbol,
horizon), so the whole chain runs after a single exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (CUSUM_DESCRIPTION, CUSUM_THRESHOLD, CUSUM_TRIGGER,
                      KIND_CUSUM, SEVERITY)
from ..functions.columns import before, running, series_window, utc_midnight

SERIES_KEYS = ("symbol", "horizon")
ALERT_COLUMNS = ("fired_at", "resolved_at", "kind", "severity", "symbol",
                 "horizon", "description", "payload")


def metric_series(long: DataFrame, metric: str = "spread_zscore") -> DataFrame:
    """(symbol, horizon, date, value) of one metric."""
    return long.where(F.col("metric") == metric).select("symbol", "horizon", "date", "value")


def cusum(series: DataFrame, *, threshold: float = CUSUM_THRESHOLD,
          keys: tuple[str, ...] = SERIES_KEYS, order: str = "date",
          value_col: str = "value") -> DataFrame:
    """Add ``cusum`` (the one-sided accumulator on |value|) to each series."""
    w = series_window(list(keys), order)
    step = F.when(F.row_number().over(w) == 1, F.lit(0.0)) \
            .otherwise(F.abs(F.col(value_col)) - F.lit(threshold))
    p = series.withColumn("_p", F.sum(step).over(running(w)))
    s = p.withColumn("cusum", F.col("_p") - F.least(F.lit(0.0), F.min("_p").over(running(w))))
    return s.drop("_p")


def hysteresis_fires(acc: DataFrame, *, trigger: float = CUSUM_TRIGGER,
                     threshold: float = CUSUM_THRESHOLD,
                     keys: tuple[str, ...] = SERIES_KEYS, order: str = "date",
                     acc_col: str = "cusum") -> DataFrame:
    """Rows where the latched alert fires."""
    w = series_window(list(keys), order)
    a = F.col(acc_col)
    marked = acc.withColumn(
        "_mark", F.when(a >= F.lit(trigger), F.lit(1)).when(a < F.lit(threshold), F.lit(0)))
    prev = F.coalesce(F.last("_mark", ignorenulls=True).over(before(w)), F.lit(0))
    return (marked.withColumn("_prev", prev)
                  .where((F.col("_mark") == 1) & (F.col("_prev") == 0))
                  .drop("_mark", "_prev"))


def cusum_alerts(long: DataFrame, *, metric: str = "spread_zscore",
                 threshold: float = CUSUM_THRESHOLD,
                 trigger: float = CUSUM_TRIGGER) -> DataFrame:
    """CUSUM breach alerts over every (symbol, horizon) series of a metric."""
    acc = cusum(metric_series(long, metric), threshold=threshold)
    return cusum_alert_rows(hysteresis_fires(acc, trigger=trigger, threshold=threshold))


def cusum_alert_rows(fired: DataFrame) -> DataFrame:
    """Alert rows of fired accumulator rows (symbol, horizon, date, cusum)."""
    return fired.select(
        utc_midnight("date").alias("fired_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(KIND_CUSUM).alias("kind"),
        F.lit(SEVERITY).alias("severity"),
        "symbol", "horizon",
        F.format_string(CUSUM_DESCRIPTION, F.col("cusum")).alias("description"),
        F.lit(None).cast("string").alias("payload"),
    )


def detect_alerts(long: DataFrame, *, with_changepoints: bool = True,
                  metric: str = "spread_zscore", chunk_rows: int | None = None,
                  **kw) -> DataFrame:
    """Both detectors over every series of ``metric``, one alert frame.

    ``chunk_rows`` runs CUSUM, the latch and the changepoint search in their
    blocked forms (same alerts) for series too long for one task; the search
    keeps its own chunk size, as its tasks grow with the square of it.
    """
    if chunk_rows is None:
        alerts = cusum_alerts(long, metric=metric)
    else:
        from .blocked import cusum_alerts_blocked
        alerts = cusum_alerts_blocked(long, metric=metric, chunk_rows=chunk_rows)
    if with_changepoints:
        from .changepoints import changepoint_alerts
        alerts = alerts.unionByName(changepoint_alerts(long, metric=metric, blocked=chunk_rows is not None, **kw))
    return alerts


def alert_counts_by_year(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy(F.year("fired_at").alias("year"), "kind")
                  .agg(F.count(F.lit(1)).alias("n_alerts")))
