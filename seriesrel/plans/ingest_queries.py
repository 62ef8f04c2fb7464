"""Catalogue entries for envelopes, routing, streaming ingest and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_doubles, utc_wall_clock
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import tables
from ..streaming import ingest
from ..streaming.job import IngestConfig, file_source, read_accounting, run_until_drained


def checked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = ingest.encode(fx.fixture_envelope_fields(spark, sf_dir), keep=("event_id",))
    return ingest.validate(ingest.decode(enc))


def _ntz(c: str):
    return utc_wall_clock(c).alias(c)


def q_envelope_decode(spark, sf_dir):
    enc = ingest.encode(fx.fixture_envelope_fields(spark, sf_dir), keep=("event_id",))
    d = ingest.decode(enc)
    return round_doubles(d.select(
        "event_id", "schema_version", "source", "instrument_id",
        utc_wall_clock(F.try_to_timestamp("event_time_utc")).alias("event_time_utc"),
        utc_wall_clock(F.try_to_timestamp("ingest_time_utc")).alias("ingest_time_utc"),
        "quality_flag",
        F.col("payload")["price"].try_cast("double").alias("price"),
        F.col("payload")["rate"].try_cast("double").alias("rate")))


def q_envelope_validate(spark, sf_dir):
    c = checked_events(spark, sf_dir)
    return c.select("event_id", "instrument_id",
                    (F.size("reject_reasons") == 0).alias("is_valid"),
                    F.array_join("reject_reasons", ",").alias("reasons"))


def q_envelope_quarantine(spark, sf_dir):
    c = ingest.rejected(checked_events(spark, sf_dir))
    return c.select("event_id", F.array_join("reject_reasons", ",").alias("reasons"))


def _route(i: int):
    def q(spark, sf_dir):
        route = fx.fixture_routes()[i]
        r = ingest.route_rows(ingest.valid(checked_events(spark, sf_dir)), route, keep=("event_id",))
        return round_doubles(r.select("event_id", _ntz("event_time_utc"), "instrument_id",
                                      route.value_col, "source", "quality_flag",
                                      _ntz("ingest_time_utc")))
    return q


def q_ingest_lag(spark, sf_dir):
    return round_doubles(ingest.ingest_lag(ingest.valid(checked_events(spark, sf_dir))))


_RUNS: dict[tuple[str, str], IngestConfig] = {}
_LANDINGS: dict[tuple[str, str], str] = {}


def _run_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, tables.input_stamp(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def stream_run(spark: SparkSession, sf_dir: str) -> IngestConfig:
    """Land ``events`` as JSON-lines files and drain them through the stream job."""
    key = _run_key(spark, sf_dir)
    if key not in _RUNS:
        root = scratch_path(spark, "ingest")
        enc = ingest.encode(fx.fixture_envelope_fields(spark, sf_dir))
        enc.repartition(8).write.text(f"{root}/landing")
        cfg = IngestConfig(sink_root=f"{root}/tables", checkpoint=f"{root}/checkpoint",
                           routes=fx.fixture_routes(), trigger=None)
        run_until_drained(spark, file_source(spark, f"{root}/landing", 2), cfg)
        _RUNS[key] = cfg
        _LANDINGS[key] = f"{root}/landing"
    return _RUNS[key]


def q_stream_ingest_lead(spark, sf_dir):
    cfg = stream_run(spark, sf_dir)
    t = spark.read.parquet(cfg.table_path("raw_lead"))
    return round_doubles(t.select(_ntz("event_time_utc"), "instrument_id", "price", "source",
                                  "quality_flag", _ntz("ingest_time_utc")))


def q_stream_quarantine(spark, sf_dir):
    """How many messages of each instrument were refused, and why."""
    cfg = stream_run(spark, sf_dir)
    refused = read_accounting(spark, cfg).where(~F.col("outcome").isin([r.table for r in cfg.routes]))
    return refused.groupBy("instrument_id", F.col("outcome").alias("reasons")).agg(F.sum("n").alias("n_messages"))


def q_stream_accounting(spark, sf_dir):
    """Where every message went: a raw table, or the quarantine with its reason."""
    cfg = stream_run(spark, sf_dir)
    return read_accounting(spark, cfg).groupBy("outcome").agg(F.sum("n").alias("n_messages"))


def q_stream_lag_monitor(spark, sf_dir):
    """Event-to-ingest lag per instrument and 1-hour ingest window over all landed messages."""
    from ..streaming.job import read_lag, start_lag_monitor
    stream_run(spark, sf_dir)                     # lands the envelopes
    out = scratch_path(spark, "lag")
    start_lag_monitor(file_source(spark, _LANDINGS[_run_key(spark, sf_dir)], 2), f"{out}/table", f"{out}/checkpoint",
                      window="1 hour").awaitTermination()
    return round_doubles(read_lag(spark, f"{out}/table").select(
        _ntz("window_start"), _ntz("window_end"), "instrument_id", "n_messages", "avg_lag_s", "max_lag_s"))


def q_bars_from_stream(spark, sf_dir):
    """The streamed raw tables feed the batch analytics: daily closes of the
    raw lead and reference tables, aligned."""
    from ..operators.align import align, series_from_raw
    cfg = stream_run(spark, sf_dir)
    lead = series_from_raw(spark.read.parquet(cfg.table_path("raw_lead")), "price")
    ref = series_from_raw(spark.read.parquet(cfg.table_path("raw_reference")), "rate") \
        .drop("symbol")
    return round_doubles(align(lead, ref))


def q_insert_if_absent(spark, sf_dir):
    from .catalog import bars
    b = bars(spark, sf_dir)
    path = f"{scratch_path(spark, 'bars')}/aligned_bars"
    tables.insert_if_absent(b.where(F.col("date") < F.lit("1998-01-01").cast("date")),
                            path, tables.BARS)
    tables.insert_if_absent(b.where(F.col("date") >= F.lit("1997-01-01").cast("date")),
                            path, tables.BARS)
    return round_doubles(spark.read.parquet(path).drop("chunk"))


def q_partitioned_roundtrip(spark, sf_dir):
    from .catalog import long_metrics
    path = f"{scratch_path(spark, 'metrics')}/relationship_metrics"
    tables.write_partitioned(long_metrics(spark, sf_dir), path, tables.METRICS, mode="overwrite")
    r = tables.read_range(spark, path, tables.METRICS, start="1996-01-01", end="1998-12-31",
                          where={"metric": "spread_zscore", "horizon": "30d"})
    return round_doubles(r.drop("chunk"))


QUERIES = {
    "envelope_decode": q_envelope_decode,
    "envelope_validate": q_envelope_validate,
    "envelope_quarantine": q_envelope_quarantine,
    "route_lead": _route(0),
    "route_reference": _route(1),
    "ingest_lag": q_ingest_lag,
    "stream_ingest_lead": q_stream_ingest_lead,
    "stream_quarantine": q_stream_quarantine,
    "stream_accounting": q_stream_accounting,
    "stream_lag_monitor": q_stream_lag_monitor,
    "bars_from_stream": q_bars_from_stream,
    "insert_if_absent": q_insert_if_absent,
    "partitioned_roundtrip": q_partitioned_roundtrip,
}
