"""Serving queries: the dashboard panels and the analytics reads.

Each function takes a DataFrame (a table read with ``tables.read_range`` or a
lazily computed frame) and returns the panel's rows. Key and time filters
are plain ``where`` clauses, so against the chunked tables they become
partition pruning plus Parquet min/max skipping; ``ORDER BY`` happens only
at the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ANOMALY_CUT, LATEST_ALERTS_LIMIT


def _between(df: DataFrame, col: str, start, end) -> DataFrame:
    c = F.col(col)
    if start is not None:
        df = df.where(c >= F.lit(start).cast(df.schema[col].dataType))
    if end is not None:
        df = df.where(c <= F.lit(end).cast(df.schema[col].dataType))
    return df


def panel_price(bars: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """N1: lead price over time for one symbol."""
    b = _between(bars.where(F.col("symbol") == symbol), "date", start, end)
    return b.select(F.col("date").alias("time"), "lead_price").orderBy("time")


def panel_rate(bars: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """N2: reference rate over time (as aligned with one symbol)."""
    b = _between(bars.where(F.col("symbol") == symbol), "date", start, end)
    return b.select(F.col("date").alias("time"), "ref_rate").orderBy("time")


def metric_series(long: DataFrame, symbol: str, metric: str, horizon: str,
                  start=None, end=None, alias: str = "value") -> DataFrame:
    """N3-N6, N9: one metric of one symbol and horizon over time."""
    m = long.where((F.col("symbol") == symbol) & (F.col("metric") == metric) &
                   (F.col("horizon") == horizon))
    m = _between(m, "date", start, end)
    return m.select(F.col("date").alias("time"), F.col("value").alias(alias)).orderBy("time")


def panel_corr(long: DataFrame, symbol: str, horizon: str, start=None, end=None) -> DataFrame:
    return metric_series(long, symbol, "pearson_corr", horizon, start, end, f"corr_{horizon}")


def panel_zscore(long: DataFrame, symbol: str, horizon: str, start=None, end=None) -> DataFrame:
    return metric_series(long, symbol, "spread_zscore", horizon, start, end, f"zscore_{horizon}")


def zscore_band(long: DataFrame, symbol: str, horizon: str, cut: float = ANOMALY_CUT,
                start=None, end=None) -> DataFrame:
    """P20: z-score points outside the +-cut band."""
    z = panel_zscore(long, symbol, horizon, start, end)
    return z.where(F.abs(F.col(f"zscore_{horizon}")) > F.lit(cut))


def latest_alerts(alerts: DataFrame, limit: int = LATEST_ALERTS_LIMIT) -> DataFrame:
    """N7 / O4 / O5: the newest alerts, then shown by symbol descending.

    The tie-break makes the top-k deterministic; Spark plans it as a
    TakeOrderedAndProject (per-partition top-k, then a merge of k rows each).
    """
    top = (alerts.orderBy(F.col("fired_at").desc(), "kind", "symbol", "horizon")
                 .limit(limit)
                 .select("fired_at", "kind", "severity", "symbol", "horizon", "description"))
    return top.orderBy(F.col("symbol").desc(), F.col("fired_at").desc())


def bars_for_metrics(bars: DataFrame, symbol: str, horizon: str = "1d") -> DataFrame:
    """N8 / N10: the return columns of one symbol's bars in time order."""
    return (bars.where((F.col("symbol") == symbol) & (F.col("horizon") == horizon))
                .select("date", "lead_logret", "ref_logret").orderBy("date"))


def metrics_for_features(long: DataFrame, symbol: str) -> DataFrame:
    """N11: every metric of one symbol in time order."""
    return (long.where(F.col("symbol") == symbol)
                .select("date", "metric", "horizon", "value").orderBy("date"))


# --------------------------------------------------------------- SQL route --
# Any panel is one column of a stored table over time for some keys, or the newest
# alerts. Names are identifiers and user values are bound parameters, never text.
SERIES_SQL = "SELECT date AS time, IDENTIFIER(:column) AS value FROM IDENTIFIER(:table) WHERE {keys} AND date BETWEEN :start AND :end"
NEWEST_SQL = "SELECT fired_at, kind, severity, symbol, horizon, description FROM alerts ORDER BY fired_at DESC, kind, symbol, horizon LIMIT :limit"


def register_views(spark, *, bars: DataFrame | None = None, metrics: DataFrame | None = None,
                   alerts: DataFrame | None = None) -> None:
    for name, df in (("aligned_bars", bars), ("relationship_metrics", metrics), ("alerts", alerts)):
        if df is not None:
            df.createOrReplaceTempView(name)


def register_tables(spark, root: str) -> None:
    """Temp views over the tables written by ``plans.batch.run_analytics``."""
    register_views(spark,
                   bars=spark.read.parquet(f"{root}/aligned_bars"),
                   metrics=spark.read.parquet(f"{root}/relationship_metrics"),
                   alerts=spark.read.parquet(f"{root}/alerts"))


def run_series(spark, table: str, column: str, start, end, **keys) -> DataFrame:
    """``time, value`` of one column of a registered table between two days, for equal ``keys``."""
    import datetime as dt
    day = lambda v: dt.date.fromisoformat(v) if isinstance(v, str) else v
    names = list(keys)
    tests = [f"IDENTIFIER(:name{i}) <=> :key{i}" for i in range(len(names))]
    if "chunk" in spark.table(table).columns:        # a stored table: read only the months of the range
        tests.append("chunk BETWEEN CAST(date_trunc('month', :start) AS DATE) AND :end")
    text = SERIES_SQL.format(keys=" AND ".join(tests) or "true")
    args = {"table": table, "column": column, "start": day(start), "end": day(end)}
    args |= {f"name{i}": k for i, k in enumerate(names)} | {f"key{i}": keys[k] for i, k in enumerate(names)}
    return spark.sql(text, args=args).orderBy("time")


def run_newest_alerts(spark, limit: int = LATEST_ALERTS_LIMIT) -> DataFrame:
    return spark.sql(NEWEST_SQL, args={"limit": limit})
