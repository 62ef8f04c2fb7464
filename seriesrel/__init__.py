"""seriesrel: Spark-native analytics for pairs of time series.

Align lead series with a reference series, compute rolling relationship
metrics, raise CUSUM / changepoint alerts, build leak-free model features,
and ingest versioned messages with Structured Streaming. Every operator is a
DataFrame-in, DataFrame-out function where the series name is a column.
"""

__version__ = "0.1.0"

# Main entry points, importable from the package root.
from .operators.align import align, series_from_raw  # noqa: E402,F401
from .operators.metrics import metrics_long, rolling_metrics  # noqa: E402,F401
from .operators.detect import cusum_alerts, detect_alerts  # noqa: E402,F401
from .operators.features import feature_frame, features_from_bars, time_folds  # noqa: E402,F401
from .session import build_session  # noqa: E402,F401
