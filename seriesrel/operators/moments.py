"""Rolling metrics from mergeable moments: work in proportion to rows, not rows x window.

A frame of ``n`` rows is never aggregated as such. Each series is cut into blocks of
``n`` rows; a running aggregate from the front of a block gives the moments of its
first rows, one from the back those of its last rows. The frame that ends at a row is
the last rows of the block before and the first rows of the row's own block, so its
moments are one merge of two summaries:

    mean  = mean_a + d * n_b / n                 d = mean_b - mean_a
    M2    = M2_a + M2_b + d * d * n_a * n_b / n  (and likewise for the co-moment)

Nothing is subtracted when a row leaves the frame, so there is no cancellation on
offset data and no drift. A mean is kept as one value of the block (its first for the
front, its last for the back) and the distance from it, which are never added up: a
constant frame has zero variance exactly, and its metrics are NULL as in the plain form.

Every window of a horizon is partitioned by the series keys and the block, which the
exchange by the keys alone satisfies: one exchange, then sorts inside the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import WINDOWS
from ..functions.columns import gate, running, safe_div, series_window
from .metrics import metric_column, to_long

#: Value columns of a row. ``_x``, ``_y`` and ``_s`` are there where both sides are, ``_l`` wherever the lead is.
VALUES = ("_x", "_y", "_s", "_l")


def _anchored(d: DataFrame, w, side: str) -> DataFrame:
    """Per value its first non-null value in the block, seen from ``side``, as ``<value>_<side>``."""
    return d.select("*", *[F.first(v, ignorenulls=True).over(running(w)).alias(f"{v}_{side}") for v in VALUES])


def _summary(w, side: str) -> Column:
    """Moments from the block's ``side`` up to the row: counts, means, second moments, co-moment."""
    frame = running(w)
    parts = []
    for v in VALUES:
        anchor, dist = F.col(f"{v}_{side}"), F.col(v) - F.col(f"{v}_{side}")
        n = F.count(v).over(frame)
        parts += [n.alias(f"n{v}"),
                  anchor.alias(f"k{v}"),
                  F.avg(dist).over(frame).alias(f"m{v}"),
                  (F.var_pop(dist).over(frame) * n).alias(f"q{v}")]
    dx, dy = (F.col(v) - F.col(f"{v}_{side}") for v in ("_x", "_y"))
    parts.append((F.covar_pop(dx, dy).over(frame) * F.count("_x").over(frame)).alias("c_xy"))
    return F.struct(*parts)


def _apart(a: Column, b: Column, v: str) -> Column:
    """Mean of ``b`` minus mean of ``a``: the difference of two data values and of two distances."""
    return (b.getField(f"k{v}") - a.getField(f"k{v}")) + (b.getField(f"m{v}") - a.getField(f"m{v}"))


def _counts(a: Column, b: Column, v: str) -> tuple[Column, Column, Column]:
    """Counts of both summaries and the second one's share of their sum."""
    na, nb = (F.coalesce(s.getField(f"n{v}"), F.lit(0)) for s in (a, b))
    return na, nb, safe_div(nb.cast("double"), (na + nb).cast("double"))


def merge_second(a: Column, b: Column, v: str) -> tuple[Column, Column]:
    """Count and second moment of ``v`` over two disjoint summaries; either may be NULL or empty."""
    na, nb, share = _counts(a, b, v)
    d, qa, qb = _apart(a, b, v), a.getField(f"q{v}"), b.getField(f"q{v}")
    return na + nb, F.when(na == 0, qb).when(nb == 0, qa).otherwise(qa + qb + d * d * na * share)


def distance_to_mean(value: Column, a: Column, b: Column, v: str) -> Column:
    """``value`` minus the mean of ``v`` over two disjoint summaries."""
    na, nb, share = _counts(a, b, v)
    from_a, from_b = (value - s.getField(f"k{v}") - s.getField(f"m{v}") for s in (a, b))
    return F.when(na == 0, from_b).when(nb == 0, from_a).otherwise(from_a - _apart(a, b, v) * share)


def merge_comoment(a: Column, b: Column) -> Column:
    """Co-moment of ``_x`` and ``_y`` over two disjoint summaries."""
    na, nb, share = _counts(a, b, "_x")
    ca, cb = a.getField("c_xy"), b.getField("c_xy")
    return (F.when(na == 0, cb).when(nb == 0, ca)
             .otherwise(ca + cb + _apart(a, b, "_x") * _apart(a, b, "_y") * na * share))


def _sample(q: Column, n: Column) -> Column:
    """Sample (co)variance of a (co)moment; NULL for fewer than two values."""
    return F.when(n > 1, q / (n - 1))


def rolling_metrics_merged(bars: DataFrame, windows: dict[str, int] = WINDOWS, *,
                           keys: tuple[str, ...] = ("symbol",), order: str = "date",
                           lead_col: str = "lead_logret", ref_col: str = "ref_logret",
                           keep: tuple[str, ...] = ()) -> DataFrame:
    """``rolling_metrics`` by merged moments: same rows, values to rounding.

    Rows with a null side count for the frame's rows and not for its observations. A
    window of one row, an empty table and a series shorter than a window give what the
    plain form gives. Rows of a series with equal ``order`` have no fixed order in either form.
    """
    keys = list(keys)
    w = series_window(keys, order)
    spread = F.col(lead_col) - F.col(ref_col)
    both = spread.isNotNull()
    d = bars.select(*keys, order, *[c for c in keep if c not in (*keys, order)],
                    F.when(both, F.col(lead_col)).alias("_x"), F.when(both, F.col(ref_col)).alias("_y"),
                    spread.alias("_s"), F.col(lead_col).alias("_l"),
                    (F.row_number().over(w) - 1).alias("_i"))
    plain = list(d.columns)
    for h, n in windows.items():
        block = f"_b_{h}"
        d = d.withColumn(block, F.expr(f"_i div {int(n)}"))
        for side, at in (("front", F.col("_i").asc()), ("back", F.col("_i").desc())):
            bw = Window.partitionBy(*keys, block).orderBy(at)
            d = _anchored(d, bw, side)
            d = d.select(*plain, *[c for c in d.columns if c.startswith(("_b_", "_m_"))],
                         _summary(bw, side).alias(f"_m_{side}_{h}"))
    # The back summary n - 1 rows earlier reaches to the end of its block, which is the block
    # before unless the row ends its own: then the front summary is the whole frame.
    by_row = Window.partitionBy(*keys).orderBy("_i")
    earlier = [F.when((F.col("_i") + 1) % n != 0, F.lag(f"_m_back_{h}", n - 1).over(by_row)).alias(f"_a_{h}")
               for h, n in windows.items()]
    d = d.select(*plain, *[f"_m_front_{h}" for h in windows], *earlier)
    cols = [*keys, order, *[c for c in keep if c not in (*keys, order)]]
    for h, n in windows.items():
        a, b = F.col(f"_a_{h}"), F.col(f"_m_front_{h}")
        rows, q_x = merge_second(a, b, "_x")
        _, q_y = merge_second(a, b, "_y")
        _, q_s = merge_second(a, b, "_s")
        n_l, q_l = merge_second(a, b, "_l")
        co = _sample(merge_comoment(a, b), rows)
        corr = safe_div(co, F.sqrt(_sample(q_x, rows)) * F.sqrt(_sample(q_y, rows)))
        cols += [gate(rows, n // 2, corr).alias(metric_column("pearson_corr", h)),
                 gate(rows, n // 2, safe_div(co, _sample(q_l, n_l))).alias(metric_column("beta", h)),
                 gate(rows, n // 2, safe_div(distance_to_mean(F.col("_s"), a, b, "_s"), F.sqrt(_sample(q_s, rows))))
                 .alias(metric_column("spread_zscore", h))]
    return d.select(*cols)


def metrics_long_merged(bars: DataFrame, windows: dict[str, int] = WINDOWS, **kw) -> DataFrame:
    """``metrics_long`` by merged moments."""
    return to_long(rolling_metrics_merged(bars, windows, **kw), windows)
