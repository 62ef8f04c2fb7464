"""Catalogue entries for landed sources and series bookkeeping.

Fixture files are produced by Spark from the driver tables (lead series from
``lineitem``, reference series from ``orders``) into the shared scratch
folder, then read back through the readers under test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_doubles, utc_wall_clock
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import landing, tables
from ..streaming import ingest

# The historical CSV holds the higher order priorities of the first part of the span;
# daily XML holds all other orders, so the two overlap and then extend.
XML_TEMPLATE = ("<rates><item><title> EUR </title><description>%s</description></item>"
                "<item><title> USD </title><description>%s</description></item></rates>")


@dataclass
class Landed:
    pages: str
    csv: str
    xml: str


_LANDED: dict[tuple[str, str], Landed] = {}


def land(spark: SparkSession, sf_dir: str) -> Landed:
    key = (spark.sparkContext.applicationId, tables.input_stamp(spark, *(f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders"))))
    if key in _LANDED:
        return _LANDED[key]
    root = scratch_path(spark, "landing")
    out = Landed(f"{root}/pages", f"{root}/history_csv", f"{root}/daily_xml")

    lead = fx.lead_series(spark, sf_dir)
    rows = lead.select(F.col("symbol").alias("product"),
                       F.date_format("date", "yyyy-MM-dd").alias("period"),
                       F.col("price").cast("string").alias("value"),
                       F.date_format("date", "yyyy-MM").alias("page"))
    totals = rows.groupBy("product").agg(F.count(F.lit(1)).alias("total"))
    pages = (rows.groupBy("product", "page")
                 .agg(F.collect_list(F.struct("period", "value", "product")).alias("data"))
                 .join(totals, "product"))
    pages.select(F.to_json(F.struct(F.struct(F.col("total").cast("string").alias("total"),
                                             "data").alias("response"))).alias("value")) \
         .write.text(out.pages)

    hist = fx.history_series(spark, sf_dir)
    hist.select(F.date_format("date", "dd.MM.yyyy").alias("Date"),
                F.col("rate").cast("string").alias("USD"),
                F.round(F.col("rate") / 1.1, 2).cast("string").alias("EUR")) \
        .write.option("header", True).csv(out.csv)

    recent = fx.recent_series(spark, sf_dir)
    recent.select(F.date_format("date", "dd.MM.yyyy").alias("fdate"),
                  F.format_string(XML_TEMPLATE, F.round(F.col("rate") / 1.1, 2).cast("string"),
                                  F.col("rate").cast("string")).alias("body")) \
          .write.parquet(out.xml)
    _LANDED[key] = out
    return out


def json_rows(spark, sf_dir) -> DataFrame:
    return landing.read_json_pages(spark, land(spark, sf_dir).pages)


def csv_hist(spark, sf_dir) -> DataFrame:
    return landing.read_history_csv(spark, land(spark, sf_dir).csv)


def xml_recent(spark, sf_dir) -> DataFrame:
    return landing.read_xml_rates(spark.read.parquet(land(spark, sf_dir).xml))


def fx_union(spark, sf_dir) -> DataFrame:
    return landing.union_first_wins(csv_hist(spark, sf_dir), xml_recent(spark, sf_dir))


def q_landed_json_series(spark, sf_dir):
    return round_doubles(json_rows(spark, sf_dir).select(
        F.col("product").alias("symbol"), "date", "price"))


def q_page_completeness(spark, sf_dir):
    return landing.page_completeness(json_rows(spark, sf_dir))


def q_landed_csv_history(spark, sf_dir):
    return round_doubles(csv_hist(spark, sf_dir))


def q_landed_xml_rates(spark, sf_dir):
    return round_doubles(xml_recent(spark, sf_dir))


def q_series_union_first_wins(spark, sf_dir):
    return round_doubles(fx_union(spark, sf_dir))


def q_series_gap_range(spark, sf_dir):
    return round_doubles(landing.gap_after(csv_hist(spark, sf_dir), xml_recent(spark, sf_dir)))


def q_next_fetch_start(spark, sf_dir):
    return landing.next_fetch_start(csv_hist(spark, sf_dir))


def q_missing_days(spark, sf_dir):
    return landing.missing_days(fx_union(spark, sf_dir))


def q_high_water_mark(spark, sf_dir):
    return landing.high_water_mark(json_rows(spark, sf_dir), keys=("product",))


def q_latest_day_envelopes(spark, sf_dir):
    newest = landing.newest_day(json_rows(spark, sf_dir), keys=("product",))
    env = ingest.series_to_envelopes(
        newest, instrument_col="product", time_col="date", value_col="price",
        payload_key="price", source="pages",
        ingest_time=F.date_add("date", 1).cast("timestamp_ntz"))
    c = ingest.valid(ingest.validate(ingest.decode(env)))
    return round_doubles(c.select(
        "instrument_id", utc_wall_clock("event_time_utc").alias("event_time_utc"),
        F.col("payload")["price"].try_cast("double").alias("price")))


def q_corpus_roundtrip(spark, sf_dir):
    path = f"{scratch_path(spark, 'corpus')}/lead_daily"
    rows = json_rows(spark, sf_dir).select(F.col("product").alias("instrument_id"), "date", "price")
    landing.write_series(rows, path)
    back = landing.read_series(spark, path, "date date, price double, instrument_id string")
    return round_doubles(back)


# Fixture parameter: the day the single-day pick asks for.
PICK_DAY = "1998-06-15"


def q_value_on_day(spark, sf_dir):
    rows = json_rows(spark, sf_dir)
    return round_doubles(landing.value_on_day(rows, PICK_DAY, keys=("product",))
                         .select("product", "date", "price"))


def q_missing_on_newest_day(spark, sf_dir):
    rows = json_rows(spark, sf_dir)
    return landing.missing_on_day(rows, rows.select(F.max("date")).scalar(), keys=("product",))


QUERIES = {
    "landed_json_series": q_landed_json_series,
    "page_completeness": q_page_completeness,
    "landed_csv_history": q_landed_csv_history,
    "landed_xml_rates": q_landed_xml_rates,
    "series_union_first_wins": q_series_union_first_wins,
    "series_gap_range": q_series_gap_range,
    "next_fetch_start": q_next_fetch_start,
    "missing_days": q_missing_days,
    "high_water_mark": q_high_water_mark,
    "latest_day_envelopes": q_latest_day_envelopes,
    "corpus_roundtrip": q_corpus_roundtrip,
    "value_on_day": q_value_on_day,
    "missing_on_newest_day": q_missing_on_newest_day,
}
