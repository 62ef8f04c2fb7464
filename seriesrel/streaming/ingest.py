"""Envelope encode / decode / validate / route, as plain DataFrame functions.

The same functions run on a batch DataFrame and inside a streaming
``foreachBatch``. Nothing raises on bad input: every check is a column
predicate that adds a reason to ``reject_reasons``; rows with reasons go to
quarantine instead of failing the stream (ANSI-safe ``try_*`` parsers only).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (DEFAULT_QUALITY_FLAG, DEFAULT_SCHEMA_VERSION, LEAD_INSTRUMENTS,
                      MIN_SCHEMA_VERSION, QUALITY_FLAG_RANGE, REFERENCE_INSTRUMENT)

# Wire schema: times as text, payload values as text (cast per route).
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("instrument_id", T.StringType()),
    T.StructField("event_time_utc", T.StringType()),
    T.StructField("ingest_time_utc", T.StringType()),
    T.StructField("quality_flag", T.IntegerType()),
    T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
])
ENVELOPE_FIELDS = [f.name for f in ENVELOPE_SCHEMA.fields]
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


@dataclass(frozen=True)
class Route:
    """Which valid envelopes land in which table, and the payload value."""
    table: str
    instruments: tuple[str, ...]
    payload_key: str
    value_col: str


LEAD_ROUTE = Route("raw_lead", LEAD_INSTRUMENTS, "price", "price")
REFERENCE_ROUTE = Route("raw_reference", (REFERENCE_INSTRUMENT,), "rate", "rate")


def encode(fields: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed envelope fields -> (keep..., value) with ``value`` the JSON text.

    ``fields`` has schema_version, source, instrument_id, event_time,
    ingest_time (timestamps), quality_flag and payload (map of text).
    """
    body = F.struct(
        F.col("schema_version").cast("int").alias("schema_version"),
        F.col("source"), F.col("instrument_id"),
        F.date_format("event_time", ISO_UTC).alias("event_time_utc"),
        F.date_format("ingest_time", ISO_UTC).alias("ingest_time_utc"),
        F.col("quality_flag").cast("int").alias("quality_flag"),
        F.col("payload"),
    )
    return fields.select(*keep, F.to_json(body).alias("value"))


def series_to_envelopes(series: DataFrame, *, instrument_col: str, time_col: str,
                        value_col: str, payload_key: str, source: str,
                        ingest_time: Column | None = None) -> DataFrame:
    """A (instrument, time, value) series as JSON envelopes, one per row.

    ``ingest_time`` defaults to ``current_timestamp()`` (one value per query,
    like the reference's single stamp per replay run).
    """
    fields = series.select(
        F.lit(DEFAULT_SCHEMA_VERSION).alias("schema_version"),
        F.lit(source).alias("source"),
        F.col(instrument_col).alias("instrument_id"),
        F.col(time_col).cast("timestamp_ntz").alias("event_time"),
        (ingest_time if ingest_time is not None else F.current_timestamp()).alias("ingest_time"),
        F.lit(DEFAULT_QUALITY_FLAG).alias("quality_flag"),
        F.create_map(F.lit(payload_key), F.col(value_col).cast("string")).alias("payload"),
    )
    return encode(fields)


# Parse schema: integer fields as text (so "present but not an integer" is
# visible without a second parse) plus the corrupt-record column.
_CORRUPT = "_corrupt"
_PARSE_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.IntegerType) else f
     for f in ENVELOPE_SCHEMA.fields] + [T.StructField(_CORRUPT, T.StringType())])


def decode(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse the JSON text once; keep the other columns and the raw text.

    ``inline`` of the parsed struct is a Generate node: filters on the parsed
    fields (e.g. ``valid()``) stay above it, so Catalyst cannot push them down
    by re-inlining ``from_json`` once per referenced field.
    """
    raw = F.col(value_col).cast("string")
    others = [c for c in df.columns if c != value_col]
    parsed = F.from_json(F.col("raw"), _PARSE_SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT})
    return df.select(*others, raw.alias("raw")).select(*others, "raw", F.inline(F.array(parsed)))


def _present_not_int(field: str) -> Column:
    return F.col(field).isNotNull() & F.col(field).try_cast("int").isNull()


def validate(decoded: DataFrame) -> DataFrame:
    """Typed columns plus ``reject_reasons`` (empty array = valid)."""
    lo, hi = QUALITY_FLAG_RANGE
    version = F.coalesce(F.col("schema_version").try_cast("int"), F.lit(DEFAULT_SCHEMA_VERSION))
    flag = F.coalesce(F.col("quality_flag").try_cast("int"), F.lit(DEFAULT_QUALITY_FLAG))
    ev = F.try_to_timestamp(F.col("event_time_utc"))
    ing = F.try_to_timestamp(F.col("ingest_time_utc"))
    malformed = F.col(_CORRUPT).isNotNull() | F.col("raw").isNull()
    checks = [
        (_present_not_int("schema_version") | (version < MIN_SCHEMA_VERSION),
         "schema_version_invalid"),
        (F.coalesce(F.length("source"), F.lit(0)) == 0, "source_empty"),
        (F.coalesce(F.length("instrument_id"), F.lit(0)) == 0, "instrument_empty"),
        (ev.isNull(), "event_time_invalid"),
        (ing.isNull(), "ingest_time_invalid"),
        (_present_not_int("quality_flag") | (flag < lo) | (flag > hi), "quality_flag_invalid"),
        (F.coalesce(ev > ing, F.lit(False)), "event_after_ingest"),
        (F.col("payload").isNull(), "payload_missing"),
    ]
    none = F.array().cast("array<string>")
    field_reasons = F.concat(*[F.when(c, F.array(F.lit(r))).otherwise(none) for c, r in checks])
    reasons = F.when(malformed, F.array(F.lit("malformed_json"))).otherwise(field_reasons)
    keep = [c for c in decoded.columns if c not in (*ENVELOPE_FIELDS, "raw", _CORRUPT)]
    return decoded.select(
        *keep, "raw",
        version.alias("schema_version"), "source", "instrument_id",
        ev.alias("event_time_utc"), ing.alias("ingest_time_utc"),
        flag.alias("quality_flag"), "payload",
        reasons.alias("reject_reasons"))


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reject_reasons") == 0)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reject_reasons") > 0)


def route_rows(checked_valid: DataFrame, route: Route, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one route as the raw table's typed projection (value may be NULL
    when the payload key is missing or not a number)."""
    return checked_valid.where(F.col("instrument_id").isin(*route.instruments)).select(
        *keep,
        "event_time_utc", "instrument_id",
        F.col("payload")[route.payload_key].try_cast("double").alias(route.value_col),
        "source",
        F.col("quality_flag").cast("short").alias("quality_flag"),
        "ingest_time_utc",
    )


def split_route(routed: DataFrame, route: Route) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable value, rows to quarantine for a bad payload value)."""
    ok = F.col(route.value_col).isNotNull()
    return routed.where(ok), routed.where(~ok)


def ingest_lag(checked_valid: DataFrame) -> DataFrame:
    """Event-to-ingest lag in seconds, avg and max per instrument."""
    lag_s = (F.unix_micros("ingest_time_utc") - F.unix_micros("event_time_utc")) / F.lit(1e6)
    return checked_valid.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.avg(lag_s).alias("avg_lag_s"),
        F.max(lag_s).alias("max_lag_s"))
