"""Domain parameters.

Operators take these as keyword arguments; the values below are only defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the reference's for the same results.
# Lead instruments, reference instrument, bar horizon, rolling windows (rows),
# metric names, CUSUM threshold and trigger, changepoint penalty, anomaly cut,
# alert kinds, severity and description formats, class labels.
# ---------------------------------------------------------------------------
LEAD_INSTRUMENTS = ("brent", "wti")
REFERENCE_INSTRUMENT = "usdkzt"
BAR_HORIZON = "1d"
WINDOWS = {"30d": 30, "60d": 60}
METRICS = ("pearson_corr", "beta", "spread_zscore")
CUSUM_THRESHOLD = 1.5
CUSUM_TRIGGER = 4.0
PELT_PENALTY = 3.0
PELT_MIN_SIZE = 2
PELT_JUMP = 5
ANOMALY_CUT = 2.5
N_SPLITS = 3
KIND_CUSUM = "cusum_zscore_breach"
KIND_REGIME = "regime_change"
SEVERITY = "warning"
CUSUM_DESCRIPTION = "CUSUM accumulator reached %.2f on spread_zscore"
REGIME_DESCRIPTION = "Statistical regime change detected at index %d"
CLASS_LABELS = ("normal", "anomalous")
LATEST_ALERTS_LIMIT = 50
STREAM_TOPICS = ("raw.oil_prices", "raw.fx_rates")
STREAM_TRIGGER = "10 seconds"
# Envelope rules.
MIN_SCHEMA_VERSION = 1
QUALITY_FLAG_RANGE = (0, 3)
DEFAULT_SCHEMA_VERSION = 1
DEFAULT_QUALITY_FLAG = 0
# ---------------------------------------------------------------------------

# Feature frame columns, in model order: returns, every metric of every window, then
# what is derived from the z-score of the shortest window.
TARGET_REGRESSION = "target_zscore"
TARGET_CLASS = "target_anomaly"
FEATURE_COLUMNS = (
    "lead_logret", "ref_logret",
    *(f"{metric}_{window}" for metric in METRICS for window in WINDOWS),
    *(f"zscore_{next(iter(WINDOWS))}_lag{k}" for k in (1, 2)),
    "zscore_momentum",
)
