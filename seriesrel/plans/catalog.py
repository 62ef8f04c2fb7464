"""The query catalogue: one entry per operator of the inventory.

Each entry is ``f(spark, sf_dir) -> DataFrame`` over the driver tables (or
data Spark derives from them), so its work grows with the tables. Doubles are
rounded to 6 places only here, at the comparison boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..operators import align as al
from ..operators import detect, evaluate, features, metrics
from ..sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.align(fx.lead_series(spark, sf_dir), fx.reference_series(spark, sf_dir))


def long_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metrics_long(bars(spark, sf_dir))


def _joined(spark, sf_dir):
    return al.join_reference(fx.lead_series(spark, sf_dir), fx.reference_series(spark, sf_dir))


def q_aligned_bars(spark, sf_dir):
    return round_doubles(bars(spark, sf_dir))


def q_forward_fill(spark, sf_dir):
    return round_doubles(al.fill_reference(_joined(spark, sf_dir)))


def q_log_returns(spark, sf_dir):
    r = al.add_log_returns(al.fill_reference(_joined(spark, sf_dir)))
    return round_doubles(r.select("symbol", "date", "lead_logret", "ref_logret"))


def _wide(metric: str) -> Query:
    def q(spark, sf_dir):
        w = metrics.rolling_metrics(bars(spark, sf_dir))
        return round_doubles(w.select("symbol", "date", *[
            metrics.metric_column(metric, h) for h in ("30d", "60d")]))
    q.__name__ = f"q_rolling_{metric}"
    return q


def q_metrics_long(spark, sf_dir):
    return round_doubles(long_metrics(spark, sf_dir))


def q_metric_summary(spark, sf_dir):
    return round_doubles(metrics.metric_summary(long_metrics(spark, sf_dir)))


def q_anomaly_share(spark, sf_dir):
    return round_doubles(metrics.anomaly_share(long_metrics(spark, sf_dir)))


def q_cusum_accumulator(spark, sf_dir):
    acc = detect.cusum(detect.metric_series(long_metrics(spark, sf_dir)))
    return round_doubles(acc.select("symbol", "horizon", "date", "value", "cusum"))


def q_cusum_alerts(spark, sf_dir):
    return detect.cusum_alerts(long_metrics(spark, sf_dir))


def q_alert_counts_by_year(spark, sf_dir):
    return detect.alert_counts_by_year(detect.cusum_alerts(long_metrics(spark, sf_dir)))


def feature_rows(spark, sf_dir) -> DataFrame:
    return features.features_from_bars(bars(spark, sf_dir))


def q_features_joined(spark, sf_dir):
    """The general path (pivot + join of long metrics with bars)."""
    b = bars(spark, sf_dir)
    return round_doubles(features.feature_frame(b, metrics.metrics_long(b)))


def folded_naive(spark, sf_dir) -> DataFrame:
    return evaluate.naive_predictions(features.time_folds(feature_rows(spark, sf_dir)))


def q_features_wide(spark, sf_dir):
    return round_doubles(features.pivot_metrics(long_metrics(spark, sf_dir)))


def q_features_lagged(spark, sf_dir):
    return round_doubles(feature_rows(spark, sf_dir))


def q_sample_count(spark, sf_dir):
    return features.sample_counts(feature_rows(spark, sf_dir))


def q_time_folds(spark, sf_dir):
    return features.time_folds(feature_rows(spark, sf_dir)).select(
        "symbol", "date", "row_index", "fold", "role")


def q_class_weights(spark, sf_dir):
    return round_doubles(features.class_weights(feature_rows(spark, sf_dir)))


def q_mae_by_fold(spark, sf_dir):
    return round_doubles(evaluate.mae_by_fold(folded_naive(spark, sf_dir)))


def q_classification_report(spark, sf_dir):
    return round_doubles(evaluate.classification_report(
        evaluate.last_fold(folded_naive(spark, sf_dir))))


def q_changepoints(spark, sf_dir):
    from ..operators.changepoints import changepoints
    return changepoints(long_metrics(spark, sf_dir))


def q_changepoints_blocked(spark, sf_dir):
    """The search in chunks small enough that every fixture series spans several."""
    from ..operators.changepoints_blocked import changepoints_blocked
    return changepoints_blocked(long_metrics(spark, sf_dir), chunk_rows=2 * BLOCK_ROWS)


def q_changepoint_alerts(spark, sf_dir):
    from ..operators.changepoints import changepoint_alerts
    return changepoint_alerts(long_metrics(spark, sf_dir))


def q_detect_alerts(spark, sf_dir):
    return detect.detect_alerts(long_metrics(spark, sf_dir))


def q_model_regressor(spark, sf_dir):
    """Boosted trees at full size: MAE of every fold."""
    from ..operators.models import train_models
    return round_doubles(train_models(feature_rows(spark, sf_dir), refit=False, classifier=False).mae)


def q_model_classifier(spark, sf_dir):
    """Random forests at full size, fitted on every fold; the report is of the last one."""
    from ..operators.models import train_models
    return round_doubles(train_models(feature_rows(spark, sf_dir), refit=False, regressor=False).report)


# Chunk size for the blocked forms in the catalogue: small enough that every
# fixture series spans several chunks (it changes the plan, not the result).
BLOCK_ROWS = 500


def q_aligned_bars_blocked(spark, sf_dir):
    from ..operators.blocked import align_blocked
    return round_doubles(align_blocked(fx.lead_series(spark, sf_dir),
                                       fx.reference_series(spark, sf_dir), chunk_rows=BLOCK_ROWS))


def q_metrics_long_merged(spark, sf_dir):
    from ..operators.moments import metrics_long_merged
    return round_doubles(metrics_long_merged(bars(spark, sf_dir)))


def q_metrics_long_blocked(spark, sf_dir):
    from ..operators.blocked import metrics_long_blocked
    return round_doubles(metrics_long_blocked(bars(spark, sf_dir), chunk_rows=BLOCK_ROWS))


def q_cusum_accumulator_blocked(spark, sf_dir):
    from ..operators.blocked import cusum_blocked
    acc = cusum_blocked(detect.metric_series(long_metrics(spark, sf_dir)), chunk_rows=BLOCK_ROWS)
    return round_doubles(acc.select("symbol", "horizon", "date", "value", "cusum"))


def q_cusum_alerts_blocked(spark, sf_dir):
    from ..operators.blocked import cusum_alerts_blocked
    return cusum_alerts_blocked(long_metrics(spark, sf_dir), chunk_rows=BLOCK_ROWS)


def blocked_feature_rows(spark, sf_dir) -> DataFrame:
    from ..operators.blocked import features_from_bars_blocked
    return features_from_bars_blocked(bars(spark, sf_dir), chunk_rows=BLOCK_ROWS)


def q_features_lagged_blocked(spark, sf_dir):
    return round_doubles(blocked_feature_rows(spark, sf_dir))


def q_time_folds_blocked(spark, sf_dir):
    from ..operators.blocked import time_folds_blocked
    return time_folds_blocked(blocked_feature_rows(spark, sf_dir), chunk_rows=BLOCK_ROWS).select(
        "symbol", "date", "row_index", "fold", "role")


def q_batch_alerts_table(spark, sf_dir):
    """Run the whole batch chain into tables, twice (the rerun must write
    nothing), and read back the CUSUM alerts."""
    from ..session import scratch_path
    from .batch import run_analytics
    root = scratch_path(spark, "batch")
    lead, ref = fx.lead_series(spark, sf_dir), fx.reference_series(spark, sf_dir)
    run_analytics(spark, lead, ref, root)
    again = run_analytics(spark, lead, ref, root)
    if any(again.written.values()):
        raise AssertionError(f"rerun wrote rows: {again.written}")
    alerts = spark.read.parquet(again.path("alerts")).drop("chunk")
    return alerts.where(F.col("kind") == "cusum_zscore_breach")


QUERIES: dict[str, Query] = {
    "aligned_bars": q_aligned_bars,
    "forward_fill": q_forward_fill,
    "log_returns": q_log_returns,
    "rolling_corr": _wide("pearson_corr"),
    "rolling_beta": _wide("beta"),
    "rolling_spread_zscore": _wide("spread_zscore"),
    "metrics_long": q_metrics_long,
    "metric_summary": q_metric_summary,
    "anomaly_share": q_anomaly_share,
    "cusum_accumulator": q_cusum_accumulator,
    "cusum_alerts": q_cusum_alerts,
    "alert_counts_by_year": q_alert_counts_by_year,
    "features_wide": q_features_wide,
    "features_lagged": q_features_lagged,
    "features_joined": q_features_joined,
    "sample_count": q_sample_count,
    "time_folds": q_time_folds,
    "class_weights": q_class_weights,
    "mae_by_fold": q_mae_by_fold,
    "classification_report": q_classification_report,
    "aligned_bars_blocked": q_aligned_bars_blocked,
    "metrics_long_merged": q_metrics_long_merged,
    "metrics_long_blocked": q_metrics_long_blocked,
    "cusum_accumulator_blocked": q_cusum_accumulator_blocked,
    "cusum_alerts_blocked": q_cusum_alerts_blocked,
    "features_lagged_blocked": q_features_lagged_blocked,
    "time_folds_blocked": q_time_folds_blocked,
    "batch_alerts_table": q_batch_alerts_table,
    "changepoints": q_changepoints,
    "changepoints_blocked": q_changepoints_blocked,
    "changepoint_alerts": q_changepoint_alerts,
    "detect_alerts": q_detect_alerts,
    "model_regressor": q_model_regressor,
    "model_classifier": q_model_classifier,
}


def _register_more() -> None:
    from . import incremental_queries, ingest_queries, landing_queries, serve_queries
    QUERIES.update(ingest_queries.QUERIES)
    QUERIES.update(landing_queries.QUERIES)
    QUERIES.update(serve_queries.QUERIES)
    QUERIES.update(incremental_queries.QUERIES)


_register_more()
