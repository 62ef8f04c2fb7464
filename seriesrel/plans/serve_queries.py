"""Catalogue entries for the serving queries (dashboard panels and reads).

They read the tables that the batch run writes, by key and time range: no panel
recomputes the chain from the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import KIND_CUSUM, LATEST_ALERTS_LIMIT
from ..functions.columns import round_doubles
from ..operators import detect
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import tables
from . import serve
from .batch import run_analytics

# Panel parameters: the first lead symbol and a time range spanning the data.
PANEL_SYMBOL = "A"
SECOND_SYMBOL = "R"
START, END = "1995-01-01", "2001-12-31"


def stored_root(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the tables of ``sf_dir``, under the shared folder; the batch run fills it.

    The tables are built once per application and state of the input files. A row in ``built`` is
    written after the run, so a run that was cut short is repeated; its writes are
    keyed, and the repetition adds only what is missing.
    """
    app = spark.sparkContext.applicationId
    name = tables.input_stamp(spark, *(f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")))
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/seriesrel/served-{app}-{name}"
    if tables.read_table(spark, f"{root}/built") is None:
        run_analytics(spark, fx.lead_series(spark, sf_dir), fx.reference_series(spark, sf_dir), root)
        spark.range(1).write.mode("overwrite").parquet(f"{root}/built")
    return root


def stored(spark: SparkSession, sf_dir: str, spec: tables.TableSpec, start=None, end=None, **keys) -> DataFrame:
    """Rows of one stored table: chunks of the time range, then the keys."""
    return tables.read_range(spark, f"{stored_root(spark, sf_dir)}/{spec.name}", spec, start=start, end=end, where=keys)


def newest_alerts(spark: SparkSession, sf_dir: str, **keys) -> DataFrame:
    """Stored alerts of the newest chunks that hold the panel's rows."""
    return tables.read_newest(spark, f"{stored_root(spark, sf_dir)}/{tables.ALERTS.name}", tables.ALERTS,
                              LATEST_ALERTS_LIMIT, keys)


def q_panel_price(spark, sf_dir):
    return round_doubles(serve.panel_price(stored(spark, sf_dir, tables.BARS, START, END), PANEL_SYMBOL))


def q_panel_rate(spark, sf_dir):
    return round_doubles(serve.panel_rate(stored(spark, sf_dir, tables.BARS, START, END), PANEL_SYMBOL))


def _panel(kind: str, horizon: str):
    fn = serve.panel_corr if kind == "corr" else serve.panel_zscore

    def q(spark, sf_dir):
        return round_doubles(fn(stored(spark, sf_dir, tables.METRICS, START, END), PANEL_SYMBOL, horizon))
    return q


def q_zscore_band(spark, sf_dir):
    return round_doubles(serve.zscore_band(stored(spark, sf_dir, tables.METRICS, START, END), PANEL_SYMBOL, "30d"))


def q_latest_alerts(spark, sf_dir):
    return serve.latest_alerts(newest_alerts(spark, sf_dir, kind=KIND_CUSUM))


def q_latest_alerts_all_kinds(spark, sf_dir):
    """The panel over both detectors' alerts."""
    return serve.latest_alerts(newest_alerts(spark, sf_dir))


def q_alert_counts_all_kinds(spark, sf_dir):
    return detect.alert_counts_by_year(stored(spark, sf_dir, tables.ALERTS))


def q_metric_series(spark, sf_dir):
    return round_doubles(serve.metric_series(stored(spark, sf_dir, tables.METRICS), SECOND_SYMBOL,
                                             "spread_zscore", "30d"))


def q_bars_for_metrics(spark, sf_dir):
    return round_doubles(serve.bars_for_metrics(stored(spark, sf_dir, tables.BARS), SECOND_SYMBOL))


def q_metrics_for_features(spark, sf_dir):
    return round_doubles(serve.metrics_for_features(stored(spark, sf_dir, tables.METRICS), SECOND_SYMBOL))


def q_sql_panel_zscore_30d(spark, sf_dir):
    serve.register_tables(spark, stored_root(spark, sf_dir))
    z = serve.run_series(spark, "relationship_metrics", "value", START, END,
                         symbol=PANEL_SYMBOL, metric="spread_zscore", horizon="30d")
    return round_doubles(z.withColumnRenamed("value", "zscore_30d"))


def q_sql_latest_alerts(spark, sf_dir):
    serve.register_views(spark, alerts=newest_alerts(spark, sf_dir, kind=KIND_CUSUM))
    return serve.run_newest_alerts(spark)


QUERIES = {
    "panel_price": q_panel_price,
    "panel_rate": q_panel_rate,
    "panel_corr_30d": _panel("corr", "30d"),
    "panel_corr_60d": _panel("corr", "60d"),
    "panel_zscore_30d": _panel("zscore", "30d"),
    "panel_zscore_60d": _panel("zscore", "60d"),
    "zscore_band": q_zscore_band,
    "latest_alerts": q_latest_alerts,
    "latest_alerts_all_kinds": q_latest_alerts_all_kinds,
    "alert_counts_all_kinds": q_alert_counts_all_kinds,
    "metric_series": q_metric_series,
    "bars_for_metrics": q_bars_for_metrics,
    "metrics_for_features": q_metrics_for_features,
    "sql_panel_zscore_30d": q_sql_panel_zscore_30d,
    "sql_latest_alerts": q_sql_latest_alerts,
}
