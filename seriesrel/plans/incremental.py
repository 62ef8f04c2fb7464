"""The batch analytics day by day: new rows and a small stored state, not the whole history.

What the next day needs of all earlier ones is one row a symbol (the state): the last lead
row with its filled reference rate, the last returns that a rolling frame can still reach
(one less than the longest window), and per horizon the CUSUM sum, its least value so far
and the last latch mark. An increment puts the state in front of the new rows, runs the
same windows as the full run over the few rows, and drops what was put in front; sums go
on in the same order, so the results are those of one full run, row for row.

Bars, metrics and alerts are inserted by key; the new state is written beside the old one
and named in ``state_versions`` last. A run that is cut short leaves the old state in
force: run again, it computes the same rows and adds those that are missing.

Changepoints are a property of a whole series and are not part of an increment. Rows dated
on or before their symbol's last day are late: an increment leaves them out (``late_rows``
lists them), and only a full run takes them in.

Edge cases: a new symbol starts without a state; a symbol without new rows keeps its
state; an increment without rows writes nothing but an equal state; null prices and rates
count as in the full run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BAR_HORIZON, CUSUM_THRESHOLD, CUSUM_TRIGGER, WINDOWS
from ..functions.columns import before, running, series_window
from ..operators.align import add_log_returns, fill_reference, join_reference
from ..operators.detect import cusum_alert_rows, metric_series
from ..operators.metrics import rolling_metrics, to_long
from ..session import scratch_path
from ..sources import tables

TAIL = "array<struct<date:date,lead_logret:double,ref_logret:double>>"
SERIES = "array<struct<horizon:string,p:double,m:double,mark:int>>"
#: Stored lead and reference series, by month: an increment reads the months since the state.
LEAD = tables.TableSpec("lead", "date", ("symbol", "date"), ("symbol",), chunk="month")
REFERENCE = tables.TableSpec("reference", "date", ("date",), (), chunk="month")


@dataclass
class Step:
    bars: DataFrame
    metrics: DataFrame
    alerts: DataFrame
    state: DataFrame


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def late_rows(lead: DataFrame, state: DataFrame, since=None) -> DataFrame:
    """Lead rows up to their symbol's last day, of those after ``since``."""
    known = state.select("symbol", F.col("date").alias("_upto"))
    rows = lead if since is None else lead.where(F.col("date") > F.lit(since).cast("date"))
    return rows.join(known, "symbol").where(F.col("date") <= F.col("_upto")).drop("_upto")


def advance(lead: DataFrame, ref: DataFrame, state: DataFrame | None, *, windows: dict[str, int] = WINDOWS,
            threshold: float = CUSUM_THRESHOLD, trigger: float = CUSUM_TRIGGER, horizon: str = BAR_HORIZON) -> Step:
    """Bars, metrics and CUSUM alerts of the lead rows after the state, and the next state."""
    spark = lead.sparkSession
    new = join_reference(lead, ref).withColumn("_old", F.lit(False))
    if state is None:
        state = spark.createDataFrame([], f"symbol string, date date, lead_price double, ref_rate double, tail {TAIL}, series {SERIES}")
    # Sorted joins on the symbol: windows and sums need that order anyway, and no state goes through the driver.
    known = state.select("symbol", F.col("date").alias("_upto")).hint("merge")
    new = new.join(known, "symbol", "left").where(F.col("_upto").isNull() | (F.col("date") > F.col("_upto"))).drop("_upto")
    old = state.select("symbol", "date", "lead_price", F.col("ref_rate").alias("ref_observed"), F.lit(True).alias("_old"))
    rows = _kept(add_log_returns(fill_reference(old.unionByName(new)), horizon, keep=("_old",)), "returns")
    bars = rows.where(~F.col("_old") & F.col("lead_logret").isNotNull() & F.col("ref_logret").isNotNull()).drop("_old")

    reach = max(windows.values()) - 1
    tail = state.select("symbol", F.inline("tail")).withColumn("_old", F.lit(True))
    pairs = tail.unionByName(bars.select("symbol", "date", "lead_logret", "ref_logret", F.lit(False).alias("_old")))
    wide = rolling_metrics(pairs, windows, keep=("_old",)).where(~F.col("_old")).drop("_old")
    long = _kept(to_long(wide, windows), "metrics")

    acc = _kept(_accumulated(metric_series(long), state, threshold, trigger), "cusum")
    fired = acc.where(~F.col("_old") & (F.col("mark") == 1) & (F.col("_prev") == 0))
    return Step(bars, long, cusum_alert_rows(fired), _next_state(rows, pairs, acc, reach))


def _accumulated(series: DataFrame, state: DataFrame, threshold: float, trigger: float) -> DataFrame:
    """``cusum`` and latch marks of the new values, behind one row that holds the sums so far."""
    held = state.select("symbol", F.inline("series")).select(
        "symbol", "horizon", F.lit("0001-01-01").cast("date").alias("date"), F.lit(None).cast("double").alias("value"),
        F.lit(True).alias("_old"), "p", "m", "mark")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("p", "double"), ("m", "double"), ("mark", "int"))]
    d = held.unionByName(series.select("symbol", "horizon", "date", "value", F.lit(False).alias("_old"), *none))
    w = series_window(["symbol", "horizon"], "date")
    step = F.when(F.col("_old"), F.col("p")).when(F.row_number().over(w) == 1, F.lit(0.0)).otherwise(F.abs("value") - F.lit(threshold))
    d = d.withColumn("p", F.sum(step).over(running(w)))
    d = d.withColumn("m", F.min(F.when(F.col("_old"), F.col("m")).otherwise(F.col("p"))).over(running(w)))
    s = F.col("p") - F.least(F.lit(0.0), F.col("m"))
    d = d.withColumn("cusum", s)
    d = d.withColumn("mark", F.when(F.col("_old"), F.col("mark")).when(F.col("cusum") >= trigger, 1).when(F.col("cusum") < threshold, 0))
    return d.withColumn("_prev", F.coalesce(F.last("mark", ignorenulls=True).over(before(w)), F.lit(0)))


def _next_state(rows: DataFrame, pairs: DataFrame, acc: DataFrame, reach: int) -> DataFrame:
    last = rows.groupBy("symbol").agg(F.max_by(F.struct("date", "lead_price", "ref_rate"), "date").alias("r")).select("symbol", "r.*")
    newest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    near = pairs.withColumn("_k", F.row_number().over(newest)).where(F.col("_k") <= reach)
    tails = near.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("date", "lead_logret", "ref_logret"))).alias("tail"))
    sums = acc.groupBy("symbol", "horizon").agg(
        F.max_by("p", "date").alias("p"), F.max_by("m", "date").alias("m"),
        F.max(F.when(F.col("mark").isNotNull(), F.struct("date", "mark"))).getField("mark").alias("mark"))
    series = sums.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("horizon", "p", "m", "mark"))).alias("series"))
    return (last.join(tails.hint("merge"), "symbol", "left").join(series.hint("merge"), "symbol", "left")
            .select("symbol", "date", "lead_price", "ref_rate", F.coalesce("tail", F.array().cast(TAIL)).alias("tail"),
                    F.coalesce("series", F.array().cast(SERIES)).alias("series")))


# ------------------------------------------------------------------ tables --
def current_version(spark: SparkSession, root: str) -> int | None:
    versions = tables.read_table(spark, f"{root.rstrip('/')}/state_versions")
    return None if versions is None else versions.agg(F.max("version")).first()[0]


def read_state(spark: SparkSession, root: str) -> DataFrame | None:
    version = current_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root.rstrip('/')}/state/v={version}")


def run_increment(spark: SparkSession, lead: DataFrame, ref: DataFrame, root: str, **kw) -> dict[str, int]:
    """Take the lead rows after the stored state into the tables at ``root``; rows written by table."""
    root = root.rstrip("/")
    version = current_version(spark, root)
    step = advance(lead, ref, read_state(spark, root), **kw)
    written = {spec.name: tables.insert_if_absent(df, f"{root}/{spec.name}", spec)
               for df, spec in ((step.bars, tables.BARS), (step.metrics, tables.METRICS), (step.alerts, tables.ALERTS))}
    following = 0 if version is None else version + 1
    step.state.write.mode("overwrite").parquet(f"{root}/state/v={following}")
    spark.range(1).select(F.lit(following).alias("version")).write.mode("append").parquet(f"{root}/state_versions")
    return written


def stored_since(spark: SparkSession, path: str, spec: tables.TableSpec, state: DataFrame | None) -> DataFrame:
    """Rows of a stored series from the least last day of any symbol on: earlier chunks are not read."""
    since = None if state is None else state.agg(F.min("date")).first()[0]
    return tables.read_range(spark, path, spec, start=since).drop("chunk")


def run_stored_increment(spark: SparkSession, lead_path: str, ref_path: str, root: str, **kw) -> dict[str, int]:
    """``run_increment`` from stored series (``LEAD``, ``REFERENCE``), reading the chunks since the state only."""
    state = read_state(spark, root)
    return run_increment(spark, stored_since(spark, lead_path, LEAD, state), stored_since(spark, ref_path, REFERENCE, state), root, **kw)
