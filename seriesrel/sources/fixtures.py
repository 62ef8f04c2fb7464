"""Series fixtures derived from the driver's TPC-H-ish tables.

* lead series: ``lineitem``, one series per return flag; the daily price is
  ``max(l_extendedprice)`` (exact on every engine).
* reference series: ``orders``; the daily rate is ``max(o_totalprice)``. The
  historical and the recent part of it overlap and together use every order.
* envelopes: ``events`` rows re-expressed as versioned messages.

The day aggregates are partial/final hash aggregates: at any scale the shuffle
carries at most one row per (symbol, day) per input partition, so one hot
symbol holding a third of ``lineitem`` costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import day_of

# Fixture parameters (our choice of how to stand the series up on the tables).
RECENT_FROM_PRIORITY = "4"
HISTORY_SHARE = 0.7
FIXTURE_SOURCE = "events"
FIXTURE_LEAD_INSTRUMENTS = ("click", "view", "purchase")
FIXTURE_REFERENCE_INSTRUMENT = "signup"


# Declared schemas of the driver tables the fixtures read (no inference job).
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_series(df: DataFrame, time_col: str, value_col: str,
                 keys: tuple[str, ...] = (), out_col: str = "price") -> DataFrame:
    """Collapse observations to one row per (keys, calendar day), max value."""
    return (df.groupBy(*keys, day_of(time_col).alias("date"))
              .agg(F.max(value_col).alias(out_col)))


def lead_series(spark: SparkSession, sf_dir: str,
                symbols: tuple[str, ...] | None = None) -> DataFrame:
    """(symbol, date, price): one lead series per return flag (all flags by
    default, i.e. the whole table; ``symbols`` restricts to some)."""
    li = table(spark, sf_dir, "lineitem")
    if symbols:
        li = li.where(F.col("l_returnflag").isin(*symbols))
    li = li.select(F.col("l_returnflag").alias("symbol"), "l_shipdate", "l_extendedprice")
    return daily_series(li, "l_shipdate", "l_extendedprice", ("symbol",), "price")


def reference_series(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """(date, rate): the daily reference series of all orders, or of those in ``where``."""
    o = table(spark, sf_dir, "orders")
    if where is not None:
        o = o.where(where)
    return daily_series(o.select("o_orderdate", "o_totalprice"), "o_orderdate", "o_totalprice", (), "rate")


def _is_history(spark: SparkSession, sf_dir: str):
    """Orders of the history: the higher priorities in the first part of the date span."""
    day = day_of("o_orderdate")
    first, last = table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first()
    if first is None:
        return F.lit(True)
    cut = F.date_add(F.lit(first), int(HISTORY_SHARE * (last - first).days))
    return (F.col("o_orderpriority") < RECENT_FROM_PRIORITY) & (day <= cut)


def history_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_series(spark, sf_dir, _is_history(spark, sf_dir))


def recent_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_series(spark, sf_dir, ~F.coalesce(_is_history(spark, sf_dir), F.lit(False)))


def fixture_envelope_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed envelope fields (before JSON encoding).

    instrument = event_type, event time = ts, ingest = ts + (event_id % 7) s,
    quality flag = event_id % 5 (4 is out of range on purpose), payload key
    ``rate`` for the reference instrument and ``price`` otherwise. By other remainders
    of event_id, some messages omit the version or the flag, have version 0 or no
    source, or are ingested a minute before their event.
    """
    ev = table(spark, sf_dir, "events")
    key = F.when(F.col("event_type") == FIXTURE_REFERENCE_INSTRUMENT, F.lit("rate")) \
           .otherwise(F.lit("price"))
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % 23 == 3, F.lit(None).cast("int"))
        .when(F.col("event_id") % 17 == 2, 0).otherwise(1).alias("schema_version"),
        F.when(F.col("event_id") % 13 == 5, "").otherwise(FIXTURE_SOURCE).alias("source"),
        F.col("event_type").alias("instrument_id"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.make_interval(secs=F.when(F.col("event_id") % 11 == 3, -60)
                                       .otherwise((F.col("event_id") % 7).cast("int"))))
        .alias("ingest_time"),
        F.when(F.col("event_id") % 19 == 1, F.lit(None).cast("int"))
        .otherwise((F.col("event_id") % 5).cast("int")).alias("quality_flag"),
        F.create_map(key, F.col("value").cast("string")).alias("payload"),
    )


def fixture_routes():
    """Routes of the ``events`` fixture: three lead instruments, one reference."""
    from ..streaming.ingest import Route
    return (Route("raw_lead", FIXTURE_LEAD_INSTRUMENTS, "price", "price"),
            Route("raw_reference", (FIXTURE_REFERENCE_INSTRUMENT,), "rate", "rate"))
