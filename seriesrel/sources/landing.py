"""Landed source files -> typed series, and series bookkeeping.

The reference fetches over HTTP page by page and day by day. Here the raw
responses are *landed* files (paged JSON, one XML document per day, a
historical CSV) and every reader is a distributed Spark read:

* paged JSON: ``response.data[]`` with ``period`` / ``value`` text, exploded;
* daily XML: the first ``item`` whose trimmed ``title`` is the currency, its
  ``description`` as a double (missing text counts as "0", unparsable text
  drops the day, as a failed fetch did);
* CSV: ``dd.MM.yyyy`` dates and one currency column.

Series bookkeeping: union with keep-first (historical wins), the gap range
after a historical series, calendar days with no observation, high-water
marks, and picking one day's value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import keep_first

PAGE_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("total", T.StringType()),
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("period", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("product", T.StringType()),
        ]))),
    ])),
])
XML_ITEMS = "item array<struct<title:string,description:string>>"
CSV_DATE_FORMAT = "dd.MM.yyyy"


# ------------------------------------------------------------------ corpus --
def read_series(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Corpus Parquet with an explicit schema (no inference)."""
    return spark.read.schema(schema).parquet(path)


def write_series(df: DataFrame, path: str, instrument_col: str = "instrument_id") -> None:
    """Corpus Parquet, one folder per instrument, sorted by date.

    Range partitioning on (instrument, date) splits a large instrument over
    several writer tasks (hash partitioning would give it one).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, instrument_col, "date").sortWithinPartitions(instrument_col, "date")
       .write.mode("overwrite").partitionBy(instrument_col).parquet(path))


# ----------------------------------------------------------------- readers --
def read_json_pages(spark: SparkSession, path: str) -> DataFrame:
    """(product, date, price, page_total) from landed JSON pages."""
    pages = spark.read.schema(PAGE_SCHEMA).json(path)
    rows = pages.select(F.col("response.total").alias("total"),
                        F.explode("response.data").alias("d"))
    return rows.select(
        F.col("d.product").alias("product"),
        F.try_to_date(F.col("d.period")).alias("date"),
        F.col("d.value").try_cast("double").alias("price"),
        F.col("total").try_cast("long").alias("page_total"))


def page_completeness(rows: DataFrame) -> DataFrame:
    """Per product: rows received vs the ``total`` the pages announce."""
    return rows.groupBy("product").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.max("page_total").alias("announced_total"))


def xml_rate(doc: Column, currency: str = "USD") -> Column:
    """The currency's rate from one daily XML document (NULL: day failed)."""
    items = F.from_xml(doc, XML_ITEMS).getField("item")
    hit = F.try_element_at(F.filter(items, lambda it: F.trim(it["title"]) == F.lit(currency)),
                           F.lit(1))
    text = F.trim(F.coalesce(hit["description"], F.lit("0")))
    return F.when(hit.isNotNull(), text.try_cast("double"))


def read_xml_rates(docs: DataFrame, *, doc_col: str = "body", date_col: str = "fdate",
                   date_format: str = CSV_DATE_FORMAT, currency: str = "USD") -> DataFrame:
    """(date, rate) from landed daily documents; the date is the request's."""
    out = docs.select(F.try_to_date(F.col(date_col), date_format).alias("date"),
                      xml_rate(F.col(doc_col), currency).alias("rate"))
    return out.where(F.col("rate").isNotNull() & F.col("date").isNotNull())


def read_history_csv(spark: SparkSession, path: str, *, currency: str = "USD",
                     date_col: str = "Date", date_format: str = CSV_DATE_FORMAT) -> DataFrame:
    """(date, rate) from the historical CSV; other currency columns ignored."""
    raw = spark.read.option("header", True).csv(path)  # all columns as text
    return raw.select(F.try_to_date(F.col(date_col), date_format).alias("date"),
                      F.col(currency).try_cast("double").alias("rate"))


# ------------------------------------------------------------ bookkeeping --
def union_first_wins(*series: DataFrame, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """Union; for a repeated key keep the row from the earliest input, and of several
    rows of one input the least by their other columns, however they are partitioned."""
    tagged = [s.withColumn("_prio", F.lit(i)) for i, s in enumerate(series)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t)
    rest = [c for c in u.columns if c not in (*keys, "_prio")]
    return keep_first(u, keys, ["_prio", *rest]).drop("_prio")


def gap_after(hist: DataFrame, recent: DataFrame, *, time_col: str = "date",
              keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``recent`` strictly after the last ``hist`` time (per key); all of them
    where there is no history.

    Without keys the bound is a scalar subquery (one value, no join); with
    keys it is a join against the per-key maxima (one row per key).
    """
    if not keys:
        last = hist.select(F.max(time_col)).scalar()
        return recent.where(last.isNull() | (F.col(time_col) > last))
    bounds = hist.groupBy(*keys).agg(F.max(time_col).alias("_last"))
    return (recent.join(bounds, list(keys), "left")
                  .where(F.col("_last").isNull() | (F.col(time_col) > F.col("_last")))
                  .drop("_last"))


def next_fetch_start(hist: DataFrame, time_col: str = "date") -> DataFrame:
    """One row: the day after the last historical day."""
    return hist.agg(F.date_add(F.max(time_col), 1).alias("next_start"))


def high_water_mark(landed: DataFrame, keys: tuple[str, ...] = ("instrument_id",),
                    time_col: str = "date") -> DataFrame:
    """Latest landed day per key and the next day to fetch."""
    return landed.groupBy(*keys).agg(F.max(time_col).alias("latest_date")) \
                 .withColumn("next_start", F.date_add("latest_date", 1))


def calendar_days(bounds: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per calendar day between ``start`` and ``end`` (per key)."""
    return bounds.select(*keys, F.explode(F.sequence("start", "end")).alias("date"))


def missing_days(observed: DataFrame, *, keys: tuple[str, ...] = (),
                 time_col: str = "date", start=None, end=None) -> DataFrame:
    """Calendar days in [start, end] (default: the observed span, per key)
    with no observation: the missing-day report of a day-by-day fetch."""
    obs = observed.select(*keys, F.col(time_col).cast("date").alias("date"))
    b = obs.groupBy(*keys).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    if start is not None:
        b = b.withColumn("start", F.lit(start).cast("date"))
    if end is not None:
        b = b.withColumn("end", F.lit(end).cast("date"))
    return calendar_days(b, keys).join(obs.distinct(), [*keys, "date"], "left_anti")


def value_on_day(series: DataFrame, day, *, keys: tuple[str, ...] = ("instrument_id",),
                 time_col: str = "date", order: str | None = None) -> DataFrame:
    """First row of ``day`` per key (by ``order`` or the time column, then the other columns)."""
    d = series.where(F.col(time_col).cast("date") == F.lit(day).cast("date"))
    first = order or time_col
    return keep_first(d, keys, [first, *(c for c in d.columns if c not in (*keys, first))])


def missing_on_day(series: DataFrame, day: Column, *, keys: tuple[str, ...] = ("instrument_id",),
                   time_col: str = "date") -> DataFrame:
    """Per key without a row on ``day``: its latest day. The report beside :func:`value_on_day`."""
    seen = F.max(F.when(F.col(time_col).cast("date") == day.cast("date"), 1))
    facts = series.groupBy(*keys).agg(F.max(time_col).alias("latest_date"), seen.alias("_seen"))
    return facts.where(F.col("_seen").isNull()).drop("_seen")


def newest_day(series: DataFrame, *, keys: tuple[str, ...] = ("instrument_id",),
               time_col: str = "date") -> DataFrame:
    """Rows on each key's newest day (the live producer's single poll).

    The per-key maxima (one row per key) are joined back, so no key's whole
    history is gathered in one task.
    """
    last = series.groupBy(*keys).agg(F.max(time_col).alias("_last"))
    return (series.join(last, list(keys), "inner")
                  .where(F.col(time_col) == F.col("_last")).drop("_last"))
