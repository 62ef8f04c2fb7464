"""Align lead series with a reference series by calendar day.

Semantics (kept exactly):

1. exact-date LEFT join lead x reference (not as-of: a reference value dated
   on a day without a lead row is never seen);
2. forward-fill the reference over the lead rows of each symbol;
3. one-step log returns of both series, computed after the fill and before
   any row is dropped (filled days give a reference return of exactly 0, and
   the lag sees rows that are dropped later); lead prices are never filled;
4. drop rows where either return is NULL.

Every symbol is aligned in one plan: the symbol is a column, the windows are
``partitionBy(symbol).orderBy(date)``. The reference side is one row per day
(its size grows with the calendar, not with the data); AQE turns the join
into a broadcast hash join when the shuffled reference is small and keeps
the sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BAR_HORIZON
from ..functions.columns import day_of, forward_fill, log_return, series_window

BAR_COLUMNS = ("symbol", "date", "horizon", "lead_price", "lead_quality",
               "ref_rate", "ref_quality", "lead_logret", "ref_logret")


def join_reference(lead: DataFrame, ref: DataFrame, *,
                   symbol_col: str = "symbol", time_col: str = "date",
                   price_col: str = "price", rate_col: str = "rate") -> DataFrame:
    """(symbol, date, lead_price, ref_observed): lead rows left-joined with the
    reference observed on the same calendar day (NULL when there is none)."""
    lead_n = lead.select(F.col(symbol_col).alias("symbol"),
                         day_of(time_col).alias("date"),
                         F.col(price_col).cast("double").alias("lead_price"))
    # One reference row a day (the day's first): a repeated day adds no bars.
    ref_n = ref.groupBy(day_of(time_col).alias("date")).agg(
        F.min_by(F.col(rate_col).cast("double"), F.struct(time_col, rate_col)).alias("ref_observed"))
    return lead_n.join(ref_n, "date", "left").select(
        "symbol", "date", "lead_price", "ref_observed")


def fill_reference(joined: DataFrame) -> DataFrame:
    """Add ``ref_rate``: the reference forward-filled over each symbol's rows."""
    w = series_window(["symbol"], "date")
    return joined.withColumn("ref_rate", forward_fill("ref_observed", w))


def add_log_returns(filled: DataFrame, horizon: str = BAR_HORIZON, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bars (and the ``keep`` columns) with both log returns; rows are not dropped yet."""
    w = series_window(["symbol"], "date")
    return filled.select(
        "symbol", "date",
        F.lit(horizon).alias("horizon"),
        "lead_price",
        F.lit(0).cast("short").alias("lead_quality"),
        "ref_rate",
        F.lit(0).cast("short").alias("ref_quality"),
        log_return("lead_price", w).alias("lead_logret"),
        log_return("ref_rate", w).alias("ref_logret"),
        *keep,
    )


def align(lead: DataFrame, ref: DataFrame, *, horizon: str = BAR_HORIZON,
          **columns) -> DataFrame:
    """Aligned daily bars for every lead symbol.

    ``lead``: (symbol, time, price), one row per symbol and day.
    ``ref``: (time, rate), one row per day.
    ``columns`` renames the inputs (symbol_col, time_col, price_col, rate_col).
    Returns ``BAR_COLUMNS``.
    """
    bars = add_log_returns(fill_reference(join_reference(lead, ref, **columns)), horizon)
    return bars.where(F.col("lead_logret").isNotNull() & F.col("ref_logret").isNotNull())


def series_from_raw(raw: DataFrame, value_col: str, *, symbol_col: str = "instrument_id",
                    time_col: str = "event_time_utc") -> DataFrame:
    """(symbol, date, value) from a raw tick table: the last observation of
    each instrument and UTC calendar day (by event time).

    An aggregate (``max_by``), so it is combined map-side before the shuffle;
    this is how streamed raw tables feed ``align``.
    """
    from pyspark.sql import types as T
    from ..functions.columns import utc_wall_clock
    # Ties of the event time: the later ingest, then source and value, decide.
    full = [time_col, *(c for c in ("ingest_time_utc", "source") if c in raw.columns), value_col]
    t = F.col(time_col)
    if isinstance(raw.schema[time_col].dataType, T.TimestampType):
        t = utc_wall_clock(t)
    return (raw.groupBy(F.col(symbol_col).alias("symbol"), F.to_date(t).alias("date"))
               .agg(F.max_by(value_col, F.struct(*full)).alias(value_col)))
