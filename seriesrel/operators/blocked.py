"""Blocked forms of the series windows, for series too long for one task.

``Window.partitionBy(symbol)`` puts a whole series in one task. That is right
for daily bars (a series is bounded by the calendar), but a raw tick series
of one hot symbol can hold a large share of all rows. The functions here give
the *same results* as the plain windows while every task stays bounded:

1. ``index_rows``: the position of each row in the global (key, time)
   order, from a range partitioning (which splits a hot key over many
   partitions), positions inside each sorted partition, and the sizes of the
   earlier partitions. A key's rows are contiguous in that order.
2. Rows are cut into chunks of ``chunk_rows`` consecutive positions; every
   window runs per (key, chunk).
3. Row-count frames (rolling n, lag, lead): the ``n - 1`` rows before a chunk
   (for a lead, the rows after it) are copied into it as a halo, the window
   runs per (key, chunk), and halo rows are dropped afterwards.
4. Running state (forward fill, CUSUM, hysteresis latch): each chunk is
   summarised (last non-null value; sum and minimum prefix of the CUSUM
   steps; last latch mark), the summaries of earlier chunks are combined by a
   window over the small per-chunk table, and the carry is joined back.

The per-chunk summary tables have one row per chunk, so their windows and
the carry joins (broadcast by AQE) are cheap whatever the series length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (ANOMALY_CUT, BAR_HORIZON, CUSUM_THRESHOLD, CUSUM_TRIGGER, METRICS, N_SPLITS, WINDOWS)
from ..functions.columns import log_ratio, running
from .align import join_reference

DEFAULT_CHUNK_ROWS = 1_000_000


def index_rows(df: DataFrame, keys: tuple[str, ...], order: str,
               partitions: int | None = None) -> DataFrame:
    """Add ``_idx``: the row's position in the global (keys, order) order.

    Range-partition on (keys, order) -- the range partitioner samples the
    data, so a hot key is spread over many partitions -- and sort within
    partitions. A row's position inside its partition is the low bits of
    ``monotonically_increasing_id``; the numbered rows are checkpointed once
    (the numbers depend on the sampled bounds, so every later use and any
    recomputation must see the same ones). Adding the row counts of the
    earlier partitions -- a table with one row per partition, a proven bound,
    broadcast -- gives global positions. The rows of one key are contiguous
    in that order, which is all the chunked windows need.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = (df.repartitionByRange(n, *keys, order).sortWithinPartitions(*keys, order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_pos", F.monotonically_increasing_id()
                       - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    d = d.checkpoint(eager=True)
    sizes = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return (d.join(F.broadcast(offsets), "_pid")
             .withColumn("_idx", (F.col("_off") + F.col("_pos")).cast("long"))
             .drop("_pid", "_pos", "_off"))


def chunk_of(chunk_rows: int) -> Column:
    return F.expr(f"_idx div {int(chunk_rows)}")


def with_halo(indexed: DataFrame, halo: int, chunk_rows: int, ahead: int = 0) -> DataFrame:
    """Each row in its chunk (``_halo`` false), and again (``_halo`` true) in every later
    chunk that begins at most ``halo`` rows after it and every earlier one that ends at
    most ``ahead`` rows before it. A halo may be longer than a chunk."""
    first = F.expr(f"greatest(_idx - {int(ahead)}, 0L) div {int(chunk_rows)}")
    last = F.expr(f"(_idx + {int(halo)}) div {int(chunk_rows)}")
    copies = indexed.select("*", F.explode(F.sequence(first, last)).alias("_chunk"))
    return copies.withColumn("_halo", F.col("_chunk") != chunk_of(chunk_rows))


def _chunk_window(keys):
    return Window.partitionBy(*keys, "_chunk").orderBy("_idx")


def carry_last(d: DataFrame, keys: tuple[str, ...], value: str, out: str) -> DataFrame:
    """``out`` = last non-null ``value`` strictly before each row, across chunks."""
    wc = _chunk_window(keys)
    local = F.last(value, ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_local", local)
    summary = d.groupBy(*keys, "_chunk").agg(
        F.max(F.when(F.col(value).isNotNull(), F.struct("_idx", F.col(value).alias("v"))))
        .getField("v").alias("_chunk_last"))
    prev = Window.partitionBy(*keys).orderBy("_chunk") \
                 .rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, "_chunk",
                           F.last("_chunk_last", ignorenulls=True).over(prev).alias("_carry"))
    return (d.join(carry, [*keys, "_chunk"], "left")
             .withColumn(out, F.coalesce("_local", "_carry"))
             .drop("_local", "_carry"))


# ----------------------------------------------------------------- align --
def align_blocked(lead: DataFrame, ref: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                  horizon: str = BAR_HORIZON) -> DataFrame:
    """``align`` for very long lead series (same rows and values)."""
    j = index_rows(join_reference(lead, ref), ("symbol",), "date")
    j = j.withColumn("_chunk", chunk_of(chunk_rows))
    # forward fill = last non-null up to and including the row
    j = carry_last(j, ("symbol",), "ref_observed", "_ref_prev")
    j = j.withColumn("ref_rate", F.coalesce("ref_observed", "_ref_prev")).drop("_ref_prev", "_chunk")
    # lag 1 through a one-row halo
    h = with_halo(j, 1, chunk_rows)
    w = _chunk_window(("symbol",))
    bars = h.select(
        "symbol", "date", "_halo",
        F.lit(horizon).alias("horizon"), "lead_price",
        F.lit(0).cast("short").alias("lead_quality"), "ref_rate",
        F.lit(0).cast("short").alias("ref_quality"),
        log_ratio("lead_price", F.lag("lead_price", 1).over(w)).alias("lead_logret"),
        log_ratio("ref_rate", F.lag("ref_rate", 1).over(w)).alias("ref_logret"),
    )
    return (bars.where(~F.col("_halo") & F.col("lead_logret").isNotNull()
                       & F.col("ref_logret").isNotNull()).drop("_halo"))


# --------------------------------------------------------------- metrics --
def rolling_metrics_blocked(bars: DataFrame, windows: dict[str, int] = WINDOWS, *,
                            chunk_rows: int = DEFAULT_CHUNK_ROWS,
                            keys: tuple[str, ...] = ("symbol",), order: str = "date",
                            keep: tuple[str, ...] = (), rolling=None) -> DataFrame:
    """``rolling_metrics`` via halos (same rows and values). ``rolling`` computes a chunk:
    ``rolling_metrics``, or ``rolling_metrics_merged`` for wide windows."""
    from .metrics import rolling_metrics
    halo = max(windows.values()) - 1
    d = with_halo(index_rows(bars, keys, order), halo, chunk_rows)
    wide = (rolling or rolling_metrics)(d, windows, keys=(*keys, "_chunk"), order="_idx",
                                        keep=(order, "_halo", *keep))
    return wide.where(~F.col("_halo")).drop("_halo", "_chunk", "_idx")


def metrics_long_blocked(bars: DataFrame, windows: dict[str, int] = WINDOWS, **kw) -> DataFrame:
    from .metrics import to_long
    wide = rolling_metrics_blocked(bars, windows, **kw)
    return to_long(wide.select("symbol", "date", *[c for c in wide.columns
                                                   if c not in ("symbol", "date")]), windows)


# -------------------------------------------------------------- features --
def features_from_bars_blocked(bars: DataFrame, windows: dict[str, int] = WINDOWS, *,
                               cut: float = ANOMALY_CUT, zscore_col: str = "spread_zscore_30d",
                               chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``features_from_bars`` with bounded tasks (same rows and values).

    Lags and the target look two rows back and one ahead among the rows that have a
    metric, so those rows are numbered anew before their halos are added.
    """
    from .features import lags_and_targets
    from .metrics import metric_column
    returns = ("lead_logret", "ref_logret")
    wide = rolling_metrics_blocked(bars, windows, chunk_rows=chunk_rows, keep=returns)
    names = [metric_column(m, h) for m in METRICS for h in windows]
    rows = wide.where(F.coalesce(*[F.col(c) for c in names]).isNotNull()).select("symbol", "date", *returns, *names)
    d = with_halo(index_rows(rows, ("symbol",), "date"), 2, chunk_rows, ahead=1)
    framed = lags_and_targets(d, cut, zscore_col, keys=("symbol", "_chunk"), order="_idx")
    return framed.where(~F.col("_halo")).drop("_idx", "_chunk", "_halo")


def time_folds_blocked(features: DataFrame, n_splits: int = N_SPLITS, *,
                       keys: tuple[str, ...] = ("symbol",), order: str = "date",
                       chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``time_folds`` with bounded tasks: a series' first position and length come from
    its per-chunk counts, and a row's index is its distance from the first position."""
    from .features import fold_roles
    d = index_rows(features, keys, order).withColumn("_chunk", chunk_of(chunk_rows))
    sizes = d.groupBy(*keys, "_chunk").agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    facts = sizes.select(*keys, "_chunk", F.min("_first").over(whole).alias("_first"), F.sum("_n").over(whole).alias("_n"))
    base = d.join(facts, [*keys, "_chunk"]).withColumn("row_index", F.col("_idx") - F.col("_first"))
    return fold_roles(base.drop("_idx", "_chunk", "_first"), n_splits)


# ----------------------------------------------------------------- CUSUM --
def cusum_blocked(series: DataFrame, *, threshold: float = CUSUM_THRESHOLD,
                  chunk_rows: int = DEFAULT_CHUNK_ROWS,
                  keys: tuple[str, ...] = ("symbol", "horizon"), order: str = "date",
                  value_col: str = "value") -> DataFrame:
    """``cusum`` via chunk summaries: a chunk maps the running sum P by its
    total S and contributes min prefix m; carries are combined over chunks.

    The series' first observation counts as a zero step. Only the first
    chunk of a key holds it, so its step x0 is taken out of that chunk's
    prefixes afterwards (a prefix minimum shifts with the prefixes).
    """
    d = index_rows(series, keys, order).withColumn("_chunk", chunk_of(chunk_rows))
    wc = _chunk_window(keys)
    d = d.withColumn("_step", F.abs(F.col(value_col)) - F.lit(threshold)) \
         .withColumn("_lp", F.sum("_step").over(running(wc)))
    d = d.withColumn("_lm", F.min("_lp").over(running(wc)))
    summary = d.groupBy(*keys, "_chunk").agg(
        F.sum("_step").alias("_S"), F.min("_lp").alias("_m"),
        F.min_by("_step", "_idx").alias("_x0"))
    prev = Window.partitionBy(*keys).orderBy("_chunk") \
                 .rowsBetween(Window.unboundedPreceding, -1)
    first = F.count(F.lit(1)).over(prev) == 0
    carry = summary.withColumn("_c", F.when(first, F.col("_x0")).otherwise(F.lit(0.0)))
    carry = carry.withColumn("_P0", F.coalesce(F.sum(F.col("_S") - F.col("_c")).over(prev),
                                               F.lit(0.0)))
    carry = carry.withColumn("_M0", F.min(F.col("_P0") + F.col("_m") - F.col("_c")).over(prev)) \
                 .select(*keys, "_chunk", "_c", "_P0", "_M0")
    out = d.join(carry, [*keys, "_chunk"])
    p = F.col("_P0") + F.col("_lp") - F.col("_c")
    m = F.least(F.col("_M0"), F.col("_P0") + F.col("_lm") - F.col("_c"))   # least() skips NULL
    return (out.withColumn("cusum", p - F.least(F.lit(0.0), m))
               .drop("_step", "_lp", "_lm", "_c", "_P0", "_M0"))


def hysteresis_fires_blocked(acc: DataFrame, *, trigger: float = CUSUM_TRIGGER,
                             threshold: float = CUSUM_THRESHOLD,
                             keys: tuple[str, ...] = ("symbol", "horizon"),
                             acc_col: str = "cusum") -> DataFrame:
    """``hysteresis_fires`` on a ``cusum_blocked`` result (needs _idx, _chunk)."""
    a = F.col(acc_col)
    d = acc.withColumn("_mark", F.when(a >= F.lit(trigger), F.lit(1))
                                 .when(a < F.lit(threshold), F.lit(0)))
    d = carry_last(d, keys, "_mark", "_prev")
    return (d.where((F.col("_mark") == 1) & (F.coalesce(F.col("_prev"), F.lit(0)) == 0))
             .drop("_mark", "_prev"))


def cusum_alerts_blocked(long: DataFrame, *, metric: str = "spread_zscore",
                         threshold: float = CUSUM_THRESHOLD, trigger: float = CUSUM_TRIGGER,
                         chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    from .detect import metric_series
    from ..config import CUSUM_DESCRIPTION, KIND_CUSUM, SEVERITY
    from ..functions.columns import utc_midnight
    acc = cusum_blocked(metric_series(long, metric), threshold=threshold, chunk_rows=chunk_rows)
    fired = hysteresis_fires_blocked(acc, trigger=trigger, threshold=threshold)
    return fired.select(
        utc_midnight("date").alias("fired_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(KIND_CUSUM).alias("kind"), F.lit(SEVERITY).alias("severity"),
        "symbol", "horizon",
        F.format_string(CUSUM_DESCRIPTION, F.col("cusum")).alias("description"),
        F.lit(None).cast("string").alias("payload"))
