"""Changepoints: penalised exact search (PELT) with an RBF kernel cost.

The reference's "BOCPD" step is PELT with a Gaussian-kernel cost and penalty
3 (Killick et al. 2012; kernel cost as in Truong et al. 2020). It needs the
whole series of one (symbol, horizon) in one place, so it runs as a grouped
map: ``groupBy(symbol, horizon).applyInPandas`` — one series per task, all
series in parallel. Everything else (index -> time, alert rows) is built-in.

Kernel cost of a segment [s, e): ``(e - s) - sum(K[s:e, s:e]) / (e - s)``,
``K = exp(-clip(d^2 / median(d^2), 1e-2, 1e2))`` off the diagonal, 1 on it.
Candidate breakpoints lie on a grid of step ``jump``; segments are at least
``min_size`` long. The search keeps one running sum of K per start that is still
admissible and adds a stripe of ``jump`` rows of K at each step, and the median gap
is found by counting gaps in the sorted values, so memory is O(n) and no series is
too long. Time is quadratic in the distance back to the oldest admissible start: in
the whole length for a series without any change.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (KIND_REGIME, PELT_JUMP, PELT_MIN_SIZE, PELT_PENALTY,
                      REGIME_DESCRIPTION, SEVERITY)
from ..functions.columns import utc_midnight
from .detect import metric_series

# The grouped-map function runs in Python workers: ship this module's code
# with it (by value) so workers need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: needs --py-files
    pass

def _grid(n: int, jump: int, min_size: int) -> list[int]:
    pts = [k for k in range(0, n, jump) if k >= min_size]
    return [0, *pts, n] if not pts or pts[-1] != n else [0, *pts]


def _median_squared_gap(x: np.ndarray) -> float:
    """Median of the n(n-1)/2 squared differences, without listing them."""
    v = np.sort(x)
    places = np.arange(len(v))
    pairs = len(v) * (len(v) - 1) // 2
    if not pairs or v[0] == v[-1]:
        return 0.0

    def smallest(k: int) -> float:
        """The k-th smallest gap: bisection over the ordered bit patterns of doubles."""
        low, high = 0, int(np.nextafter(v[-1] - v[0], np.inf).view(np.int64))
        while low < high:
            mid = (low + high) // 2
            gap = np.int64(mid).view(np.float64)
            if (np.searchsorted(v, v + gap, "right") - 1 - places).sum() >= k:
                high = mid
            else:
                low = mid + 1
        return float(np.int64(low).view(np.float64))

    middle = {(pairs + 1) // 2, pairs // 2 + 1}
    return float(np.mean([smallest(k) ** 2 for k in middle]))


def pelt_rbf(values, pen: float = PELT_PENALTY, min_size: int = PELT_MIN_SIZE,
             jump: int = PELT_JUMP) -> list[int]:
    """Breakpoint indices (segment ends) of a 1-d series, last one excluded."""
    x = np.asarray(values, dtype=float)
    n = len(x)
    if n < 2 * min_size:
        return []
    grid = np.array(_grid(n, jump, min_size))
    gamma = 1.0 / (_median_squared_gap(x) or 1.0)
    index = {int(g): i for i, g in enumerate(grid)}
    total = np.full(len(grid), np.inf)      # best penalised cost of [0, grid[i])
    back = np.zeros(len(grid), dtype=int)   # grid index of the last breakpoint before
    inner = np.zeros(len(grid))             # sum of K over [grid[i], end) squared
    total[0] = 0.0
    admissible = np.empty(0, dtype=int)     # grid indices of candidate starts, in order
    for b in range(1, len(grid)):
        lo, end = int(grid[b - 1]), int(grid[b])
        # Starts from the oldest one that is, or may still become, admissible.
        oldest = int(admissible[0]) if len(admissible) else max(0, b - 1 - (min_size // jump + 1))
        from_ = int(grid[oldest])
        stripe = np.exp(-np.clip((x[lo:end, None] - x[None, from_:end]) ** 2 * gamma, 1e-2, 1e2))
        stripe[np.arange(end - lo), np.arange(lo, end) - from_] = 1.0
        columns = stripe.sum(0)
        after = np.cumsum(columns[:lo - from_][::-1])[::-1] if lo > from_ else np.zeros(0)
        starts = np.arange(oldest, b - 1)
        inner[starts] += 2 * after[grid[starts] - from_] + columns[lo - from_:].sum()
        inner[b - 1] = columns[lo - from_:].sum()
        start_pt = ((end - min_size) // jump) * jump
        if start_pt in index:                # off-grid starts (min_size > jump) are skipped
            admissible = np.append(admissible, index[start_pt])
        a = admissible
        length = end - grid[a]
        cand = total[a] + (length - inner[a] / length) + pen
        k = int(np.argmin(cand))             # first minimum, as in a left-to-right scan
        total[b], back[b] = cand[k], a[k]
        admissible = a[cand <= cand[k] + pen]
    bkps, b = [], len(grid) - 1
    while b > 0:
        bkps.append(int(grid[b]))
        b = back[b]
    return sorted(bkps)[:-1]


CHANGEPOINT_SCHEMA = "symbol string, horizon string, bkp_index long, date date"


def changepoints(long: DataFrame, *, metric: str = "spread_zscore",
                 pen: float = PELT_PENALTY, min_size: int = PELT_MIN_SIZE,
                 jump: int = PELT_JUMP) -> DataFrame:
    """(symbol, horizon, bkp_index, date) for every series of ``metric``."""
    series = metric_series(long, metric).where(F.col("value").isNotNull())

    def detect(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date", kind="stable").reset_index(drop=True)
        bkps = [b for b in pelt_rbf(pdf["value"].to_numpy(), pen, min_size, jump)
                if b < len(pdf)]
        return pd.DataFrame({
            "symbol": pdf["symbol"].iat[0] if len(pdf) else None,
            "horizon": pdf["horizon"].iat[0] if len(pdf) else None,
            "bkp_index": np.array(bkps, dtype="int64"),
            "date": pdf["date"].to_numpy()[bkps] if bkps else pd.Series([], dtype="object"),
        })

    # Kernel search is CPU-bound per series: an explicit partition count keeps
    # AQE from coalescing the (small) shuffle into a few tasks, so series run
    # in parallel; the hash partitioning also satisfies the grouped map.
    n = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = series.repartition(n, "symbol", "horizon")
    return spread.groupBy("symbol", "horizon").applyInPandas(detect, CHANGEPOINT_SCHEMA)


def changepoint_alerts(long: DataFrame, *, metric: str = "spread_zscore", blocked: bool = False, **kw) -> DataFrame:
    """Alert rows of the changepoints; ``blocked`` searches chunk by chunk (same rows)."""
    from .changepoints_blocked import changepoints_blocked
    cps = (changepoints_blocked if blocked else changepoints)(long, metric=metric, **kw)
    return cps.select(
        utc_midnight("date").alias("fired_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(KIND_REGIME).alias("kind"),
        F.lit(SEVERITY).alias("severity"),
        "symbol", "horizon",
        F.format_string(REGIME_DESCRIPTION, F.col("bkp_index")).alias("description"),
        F.lit(None).cast("string").alias("payload"),
    )
