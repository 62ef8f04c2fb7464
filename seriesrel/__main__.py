"""Command line: ``python -m seriesrel <job> ...``.

Jobs (each is a thin argument parser around the library functions):

* ``ingest``  stream envelopes from a landing folder (or Kafka) into the raw
  tables and the quarantine; ``--once`` drains what is there and stops.
* ``batch``   align + metrics + alerts from corpus Parquet into tables.
* ``train``   fold-evaluate and fit the two models per symbol from tables.
"""

from __future__ import annotations

import argparse
import json

from .config import STREAM_TOPICS
from .session import build_session


def _ingest(spark, a):
    from .streaming.job import IngestConfig, await_all, file_source, kafka_source, start_ingest
    cfg = IngestConfig(sink_root=a.tables,
                       checkpoint=a.checkpoint or f"{a.tables.rstrip('/')}/_ingest_checkpoint",
                       trigger=None if a.once else a.trigger)
    src = (kafka_source(spark, a.kafka, a.topics.split(","), a.max_per_trigger) if a.kafka
           else file_source(spark, a.landing, a.max_per_trigger))
    q = start_ingest(src, cfg, query_name="seriesrel-ingest")
    if a.once:
        q.awaitTermination()
    else:
        await_all(spark)


def _batch(spark, a):
    from .plans.batch import run_analytics
    from .sources.landing import read_series
    lead = read_series(spark, a.lead, "date date, price double, symbol string")
    ref = read_series(spark, a.reference, "date date, rate double")
    res = run_analytics(spark, lead, ref, a.tables, chunk_rows=a.chunk_rows,
                        with_changepoints=not a.no_changepoints)
    print(json.dumps(res.written))


def _train(spark, a):
    from .operators.features import feature_frame
    from .operators.models import ModelParams, train_models
    bars = spark.read.parquet(f"{a.tables}/aligned_bars").drop("chunk")
    long = spark.read.parquet(f"{a.tables}/relationship_metrics").drop("chunk")
    res = train_models(feature_frame(bars, long), ModelParams(gbt_iter=a.gbt_iter),
                       model_dir=a.model_dir)
    res.mae.show(truncate=False)
    res.report.show(truncate=False)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="seriesrel")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landing")
    i.add_argument("--kafka", help="bootstrap servers (needs the Kafka connector)")
    i.add_argument("--tables", required=True)
    i.add_argument("--checkpoint")
    i.add_argument("--trigger", default="10 seconds")
    i.add_argument("--topics", default=",".join(STREAM_TOPICS), help="Kafka topics, comma-separated")
    i.add_argument("--max-per-trigger", type=int, help="messages (Kafka) or files a trigger; all by default")
    i.add_argument("--once", action="store_true")
    b = sub.add_parser("batch")
    b.add_argument("--lead", required=True, help="Parquet: date, price, symbol")
    b.add_argument("--reference", required=True, help="Parquet: date, rate")
    b.add_argument("--tables", required=True)
    b.add_argument("--chunk-rows", type=int, default=1_000_000, help="rows of a series in one task")
    b.add_argument("--no-changepoints", action="store_true")
    t = sub.add_parser("train")
    t.add_argument("--tables", required=True)
    t.add_argument("--model-dir", required=True)
    t.add_argument("--gbt-iter", type=int, default=100)
    a = p.parse_args(argv)
    spark = build_session(a.master, app_name=f"seriesrel-{a.job}")
    {"ingest": _ingest, "batch": _batch, "train": _train}[a.job](spark, a)


if __name__ == "__main__":
    main()
