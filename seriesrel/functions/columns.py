"""Column expressions shared by the operators.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen / the window operator. Division is always guarded: under ANSI mode a
zero divisor (e.g. a constant, forward-filled reference series) would
otherwise fail the whole job; ``try_divide`` gives NULL where pandas gives NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / den``; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(col_(num), col_(den))


def log_ratio(num: str | Column, den: str | Column) -> Column:
    """``ln(num / den)``; NULL when the ratio is undefined or not positive."""
    return F.ln(safe_div(num, den))


def series_window(keys: list[str] | tuple[str, ...], order: str) -> WindowSpec:
    """Window over one series: partition by its keys, order by time."""
    return Window.partitionBy(*keys).orderBy(order)


def running(w: WindowSpec) -> WindowSpec:
    """Frame from the first row of the series to the current row."""
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(w: WindowSpec) -> WindowSpec:
    """Frame from the first row of the series to the previous row."""
    return w.rowsBetween(Window.unboundedPreceding, -1)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """Row-count frame of ``n`` rows ending at the current row."""
    return w.rowsBetween(-(n - 1), Window.currentRow)


def forward_fill(c: str | Column, w: WindowSpec) -> Column:
    """Last non-null value up to and including the current row."""
    return F.last(col_(c), ignorenulls=True).over(running(w))


def log_return(c: str | Column, w: WindowSpec) -> Column:
    """One-step log return ``ln(x / lag(x))`` (plain lag: nulls are not skipped)."""
    return log_ratio(c, F.lag(col_(c), 1).over(w))


def gate(n_rows: Column, min_periods: int, value: Column) -> Column:
    """Emit ``value`` only when the frame holds at least ``min_periods`` rows."""
    return F.when(n_rows >= F.lit(min_periods), value)


def rolling_pearson(x: str | Column, y: str | Column, frame: WindowSpec) -> Column:
    """Sample Pearson correlation over a frame, NULL at zero variance.

    Built from ``covar_samp`` and ``stddev_samp`` rather than ``corr``: the
    window operator evaluates ``corr`` before any guard and raises
    DIVIDE_BY_ZERO on a constant frame under ANSI mode.
    """
    x, y = col_(x), col_(y)
    return safe_div(
        F.covar_samp(x, y).over(frame),
        F.stddev_samp(x).over(frame) * F.stddev_samp(y).over(frame),
    )


def rolling_beta(response: str | Column, explanatory: str | Column,
                 frame: WindowSpec) -> Column:
    """cov(response, explanatory) / var(explanatory), sample versions."""
    r, e = col_(response), col_(explanatory)
    return safe_div(F.covar_samp(r, e).over(frame), F.var_samp(e).over(frame))


def rolling_zscore(x: str | Column, frame: WindowSpec) -> Column:
    """(x - rolling mean) / rolling sample std."""
    x = col_(x)
    return safe_div(x - F.avg(x).over(frame), F.stddev_samp(x).over(frame))


def day_of(c: str | Column) -> Column:
    """Calendar day of a timestamp (or date) column."""
    return F.to_date(col_(c))


def utc_midnight(d: str | Column) -> Column:
    """Midnight of a calendar day as a zone-less UTC timestamp."""
    return col_(d).cast("timestamp_ntz")


def round_doubles(df, digits: int = 6):
    """Round every DOUBLE column (used only where results are compared)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def keep_first(df, keys, order):
    """One row per key: the row with the smallest ``order`` (list of columns).

    Written as an aggregate (``min_by`` of the packed row), so copies of a key
    are reduced inside every input partition before the shuffle (partial
    aggregation): a key with a huge number of copies never lands whole in one
    task, unlike ``row_number`` over a window partitioned by the key.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = [col_(c) for c in order]
    packed = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*order))
    out = df.groupBy(*keys).agg(packed.alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def utc_wall_clock(c: str | Column) -> Column:
    """An instant (TIMESTAMP) as its UTC wall-clock time (TIMESTAMP_NTZ),
    whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col_(c).cast("timestamp_ntz"))
