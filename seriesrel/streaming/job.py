"""Structured Streaming ingest: source -> decode -> one keyed micro-batch sink.

The reference attaches two queries to one parsed stream, so every message is
read and decoded twice, sinks append blindly (a retried batch duplicates
rows) and malformed messages vanish. Here one query decodes each micro-batch
once, validates it, and in ``foreachBatch``:

* writes every route (lead, reference, ...) with insert-if-absent on the
  table key (de-duplicated within the batch too), so replays are no-ops;
* writes rejected messages with their reasons, and valid ones that no route
  takes, to a quarantine table keyed by a hash of the raw text and the reasons,
  so that neither a retry nor a run with another checkpoint loses or repeats one.

Sources: Kafka when the connector is on the classpath, otherwise a folder
of JSON-lines files; both give a ``value`` text column and a per-trigger
rate limit. The checkpoint lives under the session's shared checkpoint dir.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import STREAM_TOPICS, STREAM_TRIGGER
from ..sources import tables
from . import ingest

DEFAULT_TOPICS = STREAM_TOPICS


@dataclass
class IngestConfig:
    sink_root: str
    checkpoint: str
    routes: tuple[ingest.Route, ...] = (ingest.LEAD_ROUTE, ingest.REFERENCE_ROUTE)
    trigger: str | None = STREAM_TRIGGER     # None -> availableNow (drain, then stop)
    source: str = "messages"                 # names what is read, for the accounting

    def table_path(self, name: str) -> str:
        return f"{self.sink_root.rstrip('/')}/{name}"


def route_spec(route: ingest.Route) -> tables.TableSpec:
    return tables.TableSpec(route.table, "event_time_utc",
                            ("instrument_id", "event_time_utc", "source"), ("instrument_id",))


def file_source(spark: SparkSession, path: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files landed in ``path``, one message per line; paced only on request."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_source(spark: SparkSession, servers: str, topics=DEFAULT_TOPICS,
                 max_offsets: int | None = None) -> DataFrame:
    """Kafka topics from the earliest offset (needs the Kafka connector jar); paced only on request."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def process_batch(batch: DataFrame, batch_id: int, cfg: IngestConfig) -> dict[str, int]:
    """Validate one micro-batch and write every route and the quarantine."""
    if batch.isEmpty():
        return {}
    checked = ingest.validate(ingest.decode(batch)).persist()
    try:
        written = {}
        good = ingest.valid(checked)
        bad_values = []
        for route in cfg.routes:
            ok, bad = ingest.split_route(ingest.route_rows(good, route, keep=("raw",)), route)
            written[route.table] = tables.insert_if_absent(
                ok.drop("raw"), cfg.table_path(route.table), route_spec(route),
                order=[F.col("ingest_time_utc"), F.col("quality_flag")])
            bad_values.append(bad.select(
                "raw", F.array(F.lit(f"{route.payload_key}_invalid")).alias("reject_reasons")))
        quarantine = ingest.rejected(checked).select("raw", "reject_reasons")
        for b in bad_values:
            quarantine = quarantine.unionByName(b)
        routed = [i for route in cfg.routes for i in route.instruments]
        quarantine = quarantine.unionByName(good.where(~F.col("instrument_id").isin(*routed)).select(
            "raw", F.array(F.lit("unrouted_instrument")).alias("reject_reasons")))
        written["quarantine"] = tables.insert_if_absent(
            quarantine_rows(quarantine), cfg.table_path("quarantine"), QUARANTINE)
        account(checked, batch_id, cfg)
        return written
    finally:
        checked.unpersist()


#: Rejects are chunked by the message's own ingest day where it can be read, so equal
#: messages fall in one chunk whenever they come.
QUARANTINE = tables.TableSpec("quarantine", "reject_day", ("message_key",), (), chunk="month")


def quarantine_rows(rejects: DataFrame) -> DataFrame:
    """``raw, reject_reasons`` with the number of equal copies in this batch, their key and day.

    A message that comes again in a later batch adds no row; :func:`account` counts all.
    """
    day = F.try_to_date(F.substring(F.get_json_object("raw", "$.ingest_time_utc"), 1, 10), "yyyy-MM-dd")
    return (rejects.groupBy("raw", "reject_reasons").agg(F.count(F.lit(1)).alias("n_copies"))
            .select("raw", "reject_reasons", "n_copies",
                    F.sha2(F.concat_ws("\u0001", "raw", F.array_join("reject_reasons", ",")), 256).alias("message_key"),
                    F.coalesce(day, F.lit("1970-01-01").cast("date")).alias("reject_day")))


def outcome(routes: tuple[ingest.Route, ...]):
    """Where a validated message goes: a route's table, or the reasons it is refused for."""
    out = F.when(F.size("reject_reasons") > 0, F.array_join("reject_reasons", ","))
    for r in routes:
        mine = F.col("instrument_id").isin(*r.instruments)
        out = out.when(mine & F.col("payload")[r.payload_key].try_cast("double").isNotNull(), r.table).when(mine, f"{r.payload_key}_invalid")
    return out.otherwise("unrouted_instrument")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream wrote into its checkpoint; a new checkpoint has a new one."""
    if (text := tables.read_text(spark, f"{checkpoint.rstrip('/')}/metadata")) is None:
        return "none"
    return json.loads(text)["id"]


def account(checked: DataFrame, batch_id: int, cfg: IngestConfig) -> None:
    """Count one micro-batch's messages by outcome, copies included. A retried batch overwrites its own folder."""
    path = f"{cfg.table_path('accounting')}/source={cfg.source}/run={run_of(checked.sparkSession, cfg.checkpoint)}/batch={batch_id}"
    (checked.groupBy("instrument_id", outcome(cfg.routes).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
     .withColumn("written_at", F.current_timestamp()).write.mode("overwrite").parquet(path))


ACCOUNTING = "instrument_id string, outcome string, n long, written_at timestamp, source string, run string, batch long"


def read_accounting(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """``(instrument_id, outcome, n, source)`` per batch: every landed message once.

    A run with a new checkpoint reads its source from the start again, so of each source
    the newest run counts.
    """
    rows = spark.read.schema(ACCOUNTING).parquet(cfg.table_path("accounting"))
    newest = rows.groupBy("source").agg(F.max_by("run", "written_at").alias("run"))
    return rows.join(newest, ["source", "run"]).select("instrument_id", "outcome", "n", "source")


def start_ingest(source: DataFrame, cfg: IngestConfig,
                 query_name: str | None = None) -> StreamingQuery:
    w = (source.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, cfg))
         .option("checkpointLocation", cfg.checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if cfg.trigger is None else w.trigger(processingTime=cfg.trigger)
    return w.start()


def run_until_drained(spark: SparkSession, source: DataFrame, cfg: IngestConfig) -> None:
    """availableNow run: process everything present, then stop (tests, backfills)."""
    cfg.trigger = None
    q = start_ingest(source, cfg)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def await_all(spark: SparkSession) -> None:
    """Block until any query stops; surfaces the first failure (T5). A query that stopped earlier in
    the session counts too, until ``spark.streams.resetTerminated()``."""
    spark.streams.awaitAnyTermination()


# ------------------------------------------------------------- publishing --
def publish_files(envelopes: DataFrame, path: str, files: int | None = None) -> None:
    """Write envelope JSON (column ``value``) as JSON-lines files into a landing
    folder the file source reads; ``files`` sets how many files (pacing is the
    reader's ``maxFilesPerTrigger``)."""
    out = envelopes.select("value")
    if files:
        out = out.repartition(files)
    out.write.mode("append").text(path)


def publish_kafka(envelopes: DataFrame, servers: str, topic: str) -> None:
    """Write envelope JSON to a Kafka topic, no key (needs the connector)."""
    (envelopes.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


# ------------------------------------------------------------ lag monitor --
def lag_partials(batch: DataFrame, batch_id: int, path: str, window: str) -> None:
    """Count, sum and maximum of one micro-batch's lags per instrument and window.

    A retried batch overwrites its own folder; there is no watermark, so nothing is late.
    """
    good = ingest.valid(ingest.validate(ingest.decode(batch)))
    lag_us = F.unix_micros("ingest_time_utc") - F.unix_micros("event_time_utc")
    (good.groupBy(F.window("ingest_time_utc", window).alias("w"), "instrument_id")
         .agg(F.count(F.lit(1)).alias("n"), F.sum(lag_us).alias("sum_us"), F.max(lag_us).alias("max_us"))
         .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "instrument_id", "n", "sum_us", "max_us")
         .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))


def start_lag_monitor(source: DataFrame, path: str, checkpoint: str, *, window: str = "1 minute",
                      trigger: str | None = None) -> StreamingQuery:
    """Keep partial lag sums of a stream at ``path``; the table belongs to ``checkpoint``."""
    w = source.writeStream.foreachBatch(lambda df, i: lag_partials(df, i, path, window)).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


LAG_SCHEMA = ("window_start timestamp, window_end timestamp, instrument_id string, n long, sum_us long, "
              "max_us long, batch long")


def read_lag(spark: SparkSession, path: str) -> DataFrame:
    """Lag per instrument and window over all batches so far."""
    return (spark.read.schema(LAG_SCHEMA).parquet(path)
            .groupBy("window_start", "window_end", "instrument_id")
            .agg(F.sum("n").alias("n_messages"), (F.sum("sum_us") / F.sum("n") / 1e6).alias("avg_lag_s"),
                 (F.max("max_us") / 1e6).alias("max_lag_s")))
