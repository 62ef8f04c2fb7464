"""Catalogue entries for the incremental run: tables that were filled in several increments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import tables
from . import incremental

_ROOTS: dict[tuple[str, str], str] = {}


def filled_root(spark: SparkSession, sf_dir: str) -> str:
    """Tables of the whole series, landed and taken in by four increments: the first half of
    the span, one day, the time up to three quarters, and the rest."""
    key = (spark.sparkContext.applicationId, tables.input_stamp(spark, *(f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders"))))
    if key not in _ROOTS:
        root = scratch_path(spark, "incremental")
        lead, ref = (incremental._kept(f(spark, sf_dir), "series") for f in (fx.lead_series, fx.reference_series))
        first, last = lead.agg(F.min("date"), F.max("date")).first()
        if first is None:
            first = last = dt.date(1970, 1, 1)
        half, late = (first + dt.timedelta(days=int(share * (last - first).days)) for share in (0.5, 0.75))
        begin = None
        for end in (half, half + dt.timedelta(days=1), late, last):
            for rows, spec in ((lead, incremental.LEAD), (ref, incremental.REFERENCE)):
                part = rows if end == last else rows.where(F.col("date") <= F.lit(end))
                tables.insert_if_absent(part if begin is None else part.where(F.col("date") > F.lit(begin)), f"{root}/{spec.name}", spec)
            incremental.run_stored_increment(spark, f"{root}/{incremental.LEAD.name}", f"{root}/{incremental.REFERENCE.name}", root)
            begin = end
        _ROOTS[key] = root
    return _ROOTS[key]


def _table(spec: tables.TableSpec):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(spark.read.parquet(f"{filled_root(spark, sf_dir)}/{spec.name}").drop("chunk"))
    return q


QUERIES = {
    "incremental_bars": _table(tables.BARS),
    "incremental_metrics": _table(tables.METRICS),
    "incremental_alerts": _table(tables.ALERTS),
}
