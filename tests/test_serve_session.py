import datetime as dt
import os
import time


from seriesrel.plans import serve
from seriesrel.session import cluster_conf, ensure_checkpoint_dir, scratch_path


def test_latest_alerts_top_k_with_ties(spark):
    rows = [(dt.datetime(2024, 1, d % 5 + 1), "k", "warning", s, h, "x")
            for d in range(30) for s in ("a", "b") for h in ("30d", "60d")]
    alerts = spark.createDataFrame(rows, "fired_at timestamp_ntz, kind string, severity string, "
                                         "symbol string, horizon string, description string")
    top = serve.latest_alerts(alerts, limit=7).collect()
    assert len(top) == 7
    assert all(r["fired_at"] == dt.datetime(2024, 1, 5) for r in top)
    assert [r["symbol"] for r in top] == sorted([r["symbol"] for r in top], reverse=True)


def test_sql_panels_bind_parameters(spark):
    long = spark.createDataFrame(
        [("a", dt.date(2024, 1, d), "30d", "spread_zscore", float(d)) for d in range(1, 11)],
        "symbol string, date date, horizon string, metric string, value double")
    serve.register_views(spark, metrics=long)
    got = serve.run_series(spark, "relationship_metrics", "value", "2024-01-03", "2024-01-05",
                           symbol="a", metric="spread_zscore", horizon="30d")
    assert [r["value"] for r in got.collect()] == [3.0, 4.0, 5.0]
    none = serve.run_series(spark, "relationship_metrics", "value", "2024-01-01", "2024-12-31",
                            symbol="a' OR '1'='1")
    assert none.count() == 0          # values are bound, never spliced into the SQL


def test_scratch_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    p = scratch_path(spark, "x")
    assert p.startswith(base.rstrip("/")) and scratch_path(spark, "x") != p
    c = cluster_conf(1000)
    assert c["spark.sql.shuffle.partitions"] == "4000"


def test_processing_time_trigger_runs_and_stops(spark):
    from seriesrel.streaming.job import IngestConfig, file_source, start_ingest
    root = scratch_path(spark, "t-trigger")
    os.makedirs(f"{root}/landing")
    cfg = IngestConfig(sink_root=f"{root}/tables", checkpoint=f"{root}/ck", trigger="1 second")
    q = start_ingest(file_source(spark, f"{root}/landing", 5), cfg, query_name="t_trigger")
    try:
        q.processAllAvailable()                      # empty source: nothing written
        assert not os.path.exists(f"{root}/tables/raw_lead")
        with open(f"{root}/landing/a.json", "w") as f:
            f.write('{"source":"feed","instrument_id":"wti","event_time_utc":"2024-01-01T00:00:00Z",'
                    '"ingest_time_utc":"2024-01-01T00:00:01Z","payload":{"price":"70.5"}}\n')
        deadline = time.time() + 60
        while time.time() < deadline and not os.path.exists(f"{root}/tables/raw_lead"):
            q.processAllAvailable()
            time.sleep(0.5)
        assert spark.read.parquet(f"{root}/tables/raw_lead").select("price").first()[0] == 70.5
    finally:
        q.stop()
