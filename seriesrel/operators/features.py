"""Model features: pivot, join, lags, targets and leak-free time folds.

``feature_frame`` reproduces the reference's frame for every symbol at once:
metrics long -> wide (mean per symbol, day and ``metric_horizon``), inner join
with the bars, lag-1/lag-2/momentum of the 30-row z-score, next-day z-score
target and the ``|next z| > cut`` anomaly flag, then drop rows with any NULL.
Lags and targets are computed before the drop, on the joined rows.

``time_folds`` is the expanding split with ``n_splits`` folds and test size
``n div (n_splits + 1)``: fold k tests rows
``[n - (n_splits - k) * t, n - (n_splits - k - 1) * t)`` and trains on all
rows before them. It is expressed with ``row_number`` and a per-symbol count,
then ``explode`` of the fold ids, so each row carries (fold, role) without a
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ANOMALY_CUT, METRICS, N_SPLITS, TARGET_CLASS, WINDOWS
from ..functions.columns import series_window
from .metrics import metric_column, rolling_metrics


def pivot_metrics(long: DataFrame, windows: dict[str, int] = WINDOWS,
                  metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(symbol, date, <metric>_<horizon>...) with the mean of each cell.

    The pivot values are listed explicitly so Spark does not run a job to
    discover them.
    """
    names = [metric_column(m, h) for m in metrics for h in windows]
    keyed = long.withColumn("_mh", F.concat_ws("_", "metric", "horizon"))
    return keyed.groupBy("symbol", "date").pivot("_mh", names).agg(F.avg("value"))


def lags_and_targets(j: DataFrame, cut: float, zscore_col: str, *,
                     keys: tuple[str, ...] = ("symbol",), order: str = "date") -> DataFrame:
    """``j`` with lags, momentum and next-row targets; complete rows only."""
    w = series_window(list(keys), order)
    z = F.col(zscore_col)
    f = j.select(
        *j.columns,
        F.lag(z, 1).over(w).alias("zscore_30d_lag1"),
        F.lag(z, 2).over(w).alias("zscore_30d_lag2"),
        (z - F.lag(z, 1).over(w)).alias("zscore_momentum"),
        F.lead(z, 1).over(w).alias("target_zscore"),
    )
    f = f.withColumn("target_anomaly",
                     (F.abs(F.col("target_zscore")) > F.lit(cut)).cast("int"))
    return f.dropna(how="any")


def feature_frame(bars: DataFrame, long: DataFrame, *, cut: float = ANOMALY_CUT,
                  zscore_col: str = "spread_zscore_30d") -> DataFrame:
    """Wide feature frame with targets, complete rows only (from stored
    bars and long metrics: pivot, then inner join on symbol and day)."""
    wide = pivot_metrics(long)
    j = bars.select("symbol", "date", "lead_logret", "ref_logret") \
            .join(wide, ["symbol", "date"], "inner")
    return lags_and_targets(j, cut, zscore_col)


def features_from_bars(bars: DataFrame, windows: dict[str, int] = WINDOWS, *,
                       cut: float = ANOMALY_CUT,
                       zscore_col: str = "spread_zscore_30d") -> DataFrame:
    """Same frame as ``feature_frame(bars, metrics_long(bars))`` in one pass.

    The pivot of the long metrics has a row for a (symbol, day) exactly when
    at least one metric is non-null, and its cells are the wide values, so
    the pivot + join collapse into a filter on the wide frame. Every window
    (metrics, lags, targets) then shares one ``partitionBy(symbol)``
    exchange and the inputs are scanned once.
    """
    wide = rolling_metrics(bars, windows, keep=("lead_logret", "ref_logret"))
    names = [metric_column(m, h) for m in METRICS for h in windows]
    j = wide.where(F.coalesce(*[F.col(c) for c in names]).isNotNull())
    return lags_and_targets(j.select("symbol", "date", "lead_logret", "ref_logret", *names),
                             cut, zscore_col)


def time_folds(features: DataFrame, n_splits: int = N_SPLITS, *,
               keys: tuple[str, ...] = ("symbol",), order: str = "date") -> DataFrame:
    """Features plus ``row_index``, ``fold`` and ``role`` ('train' / 'test').

    A row appears once per fold it takes part in.
    """
    w = series_window(list(keys), order)
    idx = (F.row_number().over(w) - 1).cast("bigint")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return fold_roles(features.select("*", idx.alias("row_index"), n.alias("_n")), n_splits)


def fold_roles(base: DataFrame, n_splits: int) -> DataFrame:
    """Rows with ``row_index`` and the series' length ``_n``, once per fold they take part in."""
    t = F.expr(f"_n div {n_splits + 1}")
    exploded = base.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("_n") - (F.lit(n_splits) - F.col("fold")) * t
    role = (F.when(F.col("row_index") < start, F.lit("train"))
             .when(F.col("row_index") < start + t, F.lit("test")))
    return exploded.withColumn("role", role).where(F.col("role").isNotNull()).drop("_n")


def class_weights(features: DataFrame, label: str = TARGET_CLASS,
                  keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Balanced class weights n / (k * n_c) per key group."""
    counts = features.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy(*keys)
    weight = F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))
    return counts.select(*keys, label, "n_class", weight.alias("weight"))


def sample_counts(features: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    return features.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"))
