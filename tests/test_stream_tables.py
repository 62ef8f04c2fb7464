import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from seriesrel.session import scratch_path
from seriesrel.sources import tables
from seriesrel.streaming.job import IngestConfig, file_source, run_until_drained


def env(i, instrument="brent", key="price", value="80.0", flag=0):
    return json.dumps({"schema_version": 1, "source": "feed", "instrument_id": instrument,
                       "event_time_utc": f"2024-01-{i:02d}T00:00:00Z",
                       "ingest_time_utc": f"2024-01-{i:02d}T01:00:00Z",
                       "quality_flag": flag, "payload": {key: value}})


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_keyed_sink_is_idempotent(spark):
    root = scratch_path(spark, "test-stream")
    landing = f"{root}/landing"
    write_lines(landing, "a.json", [env(1), env(2), env(2), env(3, "usdkzt", "rate", "475.2")])
    write_lines(landing, "b.json", [env(2), "{broken", env(4, flag=4), env(5, value="abc")])
    cfg = IngestConfig(sink_root=f"{root}/tables", checkpoint=f"{root}/ck1", trigger=None)
    run_until_drained(spark, file_source(spark, landing, 1), cfg)
    lead = spark.read.parquet(cfg.table_path("raw_lead"))
    assert sorted(r["event_time_utc"].day for r in lead.collect()) == [1, 2]
    assert spark.read.parquet(cfg.table_path("raw_reference")).count() == 1
    q = spark.read.parquet(cfg.table_path("quarantine"))
    reasons = sorted(",".join(r["reject_reasons"]) for r in q.collect())
    assert reasons == ["malformed_json", "price_invalid", "quality_flag_invalid"]
    # replay everything with a lost checkpoint: tables do not change
    cfg2 = IngestConfig(sink_root=cfg.sink_root, checkpoint=f"{root}/ck2", trigger=None)
    run_until_drained(spark, file_source(spark, landing, 1), cfg2)
    assert spark.read.parquet(cfg.table_path("raw_lead")).count() == 2
    assert spark.read.parquet(cfg.table_path("raw_reference")).count() == 1
    # other messages under another checkpoint: the first run's rejects stay
    write_lines(f"{root}/landing3", "c.json", [env(6, "gold"), env(7, flag=4), "{broken"])
    cfg3 = IngestConfig(sink_root=cfg.sink_root, checkpoint=f"{root}/ck3", trigger=None)
    run_until_drained(spark, file_source(spark, f"{root}/landing3"), cfg3)
    q = spark.read.parquet(cfg.table_path("quarantine"))
    assert sorted(",".join(r["reject_reasons"]) for r in q.collect()) == [
        "malformed_json", "price_invalid", "quality_flag_invalid", "quality_flag_invalid", "unrouted_instrument"]


def test_table_without_rows_can_be_read_and_filled(spark):
    path = f"{scratch_path(spark, 'test-empty')}/alerts"
    some = spark.createDataFrame([("2024-01-02", "k", "s", "30d")], "fired_at string, kind string, symbol string, horizon string") \
                .withColumn("fired_at", F.to_date("fired_at"))
    assert tables.insert_if_absent(some.limit(0), path, tables.ALERTS) == 0
    assert spark.read.parquet(path).count() == 0
    assert tables.insert_if_absent(some, path, tables.ALERTS) == 1
    assert spark.read.parquet(path).drop("chunk").collect() == some.collect()


def test_one_chunk_makes_few_files(spark):
    path = f"{scratch_path(spark, 'test-files')}/bars"
    df = spark.range(1000).select(F.lit("2024-01-01").cast("date").alias("date"), F.lit("1d").alias("horizon"),
                                  F.col("id").cast("string").alias("symbol"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        tables.write_partitioned(df, path, tables.BARS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(spark.read.parquet(path).inputFiles()) <= 4


def test_insert_if_absent_rerun_leaves_table_unchanged(spark):
    path = f"{scratch_path(spark, 'test-bars')}/bars"
    df = spark.createDataFrame(
        [(f"2024-01-{d:02d}", "1d", s, float(d)) for d in range(1, 21) for s in "ab"],
        "date string, horizon string, symbol string, lead_price double").withColumn("date", F.to_date("date"))
    first = df.where("date < '2024-01-12'")
    assert tables.insert_if_absent(first, path, tables.BARS) == 22
    assert tables.insert_if_absent(df, path, tables.BARS) == 18
    assert tables.insert_if_absent(df, path, tables.BARS) == 0
    back = spark.read.parquet(path)
    assert back.count() == 40 and back.select("date", "symbol").distinct().count() == 40


def test_read_range_prunes_partitions(spark):
    path = f"{scratch_path(spark, 'test-metrics')}/m"
    df = spark.createDataFrame(
        [(f"2024-{m:02d}-{d:02d}", "30d", "a", "beta", float(d)) for m in (1, 2, 3) for d in (1, 15)],
        "date string, horizon string, symbol string, metric string, value double"
    ).withColumn("date", F.to_date("date"))
    tables.write_partitioned(df, path, tables.METRICS, mode="overwrite")
    r = tables.read_range(spark, path, tables.METRICS, start="2024-02-01", end="2024-02-28",
                          where={"metric": "beta"})
    assert r.count() == 2
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "chunk" in plan
    assert "PushedFilters" in plan and "metric" in plan


def test_lag_counts_every_message_however_files_arrive(spark):
    from seriesrel.streaming.job import publish_files, read_lag, start_lag_monitor
    from seriesrel.streaming import ingest as ing
    root = scratch_path(spark, "test-lag")
    rows = spark.createDataFrame(
        [("wti", f"2024-01-0{d} {h:02d}:00:00", float(h)) for d in (1, 2) for h in range(12)],
        "i string, t string, p double").withColumn("t", F.to_timestamp("t"))
    env_rows = ing.series_to_envelopes(rows, instrument_col="i", time_col="t", value_col="p",
                                       payload_key="price", source="feed",
                                       ingest_time=F.col("t") + F.expr("INTERVAL 30 SECONDS"))
    publish_files(env_rows, f"{root}/landing", files=6)
    seen = []
    for files in (1, 2, None):
        start_lag_monitor(file_source(spark, f"{root}/landing", files), f"{root}/lag{files}", f"{root}/ck{files}",
                          window="1 day").awaitTermination()
        seen.append(sorted((r["n_messages"], r["avg_lag_s"], r["max_lag_s"]) for r in read_lag(spark, f"{root}/lag{files}").collect()))
    assert seen == [[(12, 30.0, 30.0)] * 2] * 3


def test_accounting_counts_every_landed_message(spark):
    """Equal messages in one batch and in different ones, a retried batch, a lost checkpoint, a second source."""
    from seriesrel.streaming.job import process_batch, read_accounting
    root = scratch_path(spark, "test-accounting")
    landing = f"{root}/landing"
    write_lines(landing, "a.json", [env(1), env(1), "{broken", "{broken", env(9, "gold")])
    write_lines(landing, "b.json", [env(1), "{broken", env(5, value="abc"), env(3, "usdkzt", "rate", "475.2")])
    def totals(cfg):
        rows = read_accounting(spark, cfg).groupBy("source", "outcome").agg(F.sum("n").alias("n")).collect()
        return {(r.source, r.outcome): r.n for r in rows}
    want = {("messages", k): n for k, n in {"raw_lead": 3, "raw_reference": 1, "malformed_json": 3, "price_invalid": 1, "unrouted_instrument": 1}.items()}
    cfg = IngestConfig(sink_root=f"{root}/tables", checkpoint=f"{root}/ck1", trigger=None)
    run_until_drained(spark, file_source(spark, landing, 1), cfg)
    assert totals(cfg) == want
    first = spark.read.text(f"{landing}/a.json")
    process_batch(first, 0, cfg)                                # the same batch again
    assert sum(totals(cfg).values()) in (9, 10)                 # batch 0 may have been either file
    cfg2 = IngestConfig(sink_root=cfg.sink_root, checkpoint=f"{root}/ck2", trigger=None)
    run_until_drained(spark, file_source(spark, landing), cfg2)  # everything in one batch
    assert totals(cfg2) == want
    write_lines(f"{root}/more", "c.json", [env(6), "{broken"])
    cfg3 = IngestConfig(sink_root=cfg.sink_root, checkpoint=f"{root}/ck3", trigger=None, source="more")
    run_until_drained(spark, file_source(spark, f"{root}/more"), cfg3)
    assert totals(cfg3) == want | {("more", "raw_lead"): 1, ("more", "malformed_json"): 1}
    assert spark.read.parquet(cfg.table_path("raw_lead")).count() == 2


def _alerts(spark, rows):
    return spark.createDataFrame(
        rows, "fired_at timestamp_ntz, kind string, severity string, symbol string, horizon string, description string")


def test_newest_alerts_are_read_from_the_newest_chunks(spark):
    from seriesrel.plans import serve
    path = f"{scratch_path(spark, 'test-newest')}/alerts"
    rng = random.Random(3)
    day = lambda m, d: dt.datetime(2020 + m // 12, m % 12 + 1, d)
    rows = [(day(m, rng.choice((1, 15, 28))), rng.choice("ab"), "w", f"s{i}", "30d", "x") for m in range(30) for i in range(6)]
    rows += [(day(29, 28), "rare", "w", "late", "30d", "x"), (day(2, 1), "rare", "w", "old", "30d", "x")]
    rng.shuffle(rows)
    # without any counts the table is read whole
    tables.write_partitioned(_alerts(spark, rows[:20]), path, tables.ALERTS)
    assert tables.newest_chunk(spark, path, tables.ALERTS, 5) is None
    # by two keyed writes that overlap, then rows whose counts were lost, in old and in new chunks
    assert tables.insert_if_absent(_alerts(spark, rows[:100]), path, tables.ALERTS) == 80
    assert tables.insert_if_absent(_alerts(spark, rows[60:]), path, tables.ALERTS) == len(rows) - 100
    uncounted = [(day(m, 28), "a", "w", f"u{i}", "30d", "x") for m in (1, 31) for i in range(4)]
    tables.write_partitioned(_alerts(spark, uncounted), path, tables.ALERTS)
    assert tables.insert_if_absent(_alerts(spark, rows), path, tables.ALERTS) == 0
    whole = spark.read.parquet(path)
    assert whole.count() == len(rows) + 8
    for where in ({}, {"kind": "a"}, {"kind": "rare"}, {"kind": "none"}, {"symbol": "s1"}):
        for limit in (1, 2, 7, 50, 1000):
            want = whole
            for k, v in where.items():
                want = want.where(F.col(k) == v)
            got = serve.latest_alerts(tables.read_newest(spark, path, tables.ALERTS, limit, where), limit)
            assert sorted(got.collect()) == sorted(serve.latest_alerts(want, limit).collect()), (where, limit)
    # one filter on the partition column, and few of the files
    few = tables.read_newest(spark, path, tables.ALERTS, 7)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "chunk" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    scanned = few.select("chunk").distinct().count()
    assert 1 <= scanned <= 6 < whole.select("chunk").distinct().count()


def test_newest_of_an_empty_table(spark):
    path = f"{scratch_path(spark, 'test-newest-empty')}/alerts"
    assert tables.insert_if_absent(_alerts(spark, []), path, tables.ALERTS) == 0
    assert tables.read_newest(spark, path, tables.ALERTS, 5).collect() == []


def test_waiting_surfaces_the_failure_of_any_query(spark):
    import pytest
    from pyspark.errors import StreamingQueryException
    from seriesrel.streaming.job import await_all
    root = scratch_path(spark, "test-await")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def broken(df, batch_id):
        raise ValueError("planned failure")

    spark.streams.resetTerminated()
    runs = ticks.writeStream.format("noop").option("checkpointLocation", f"{root}/runs").start()
    fails = ticks.writeStream.foreachBatch(broken).option("checkpointLocation", f"{root}/fails").start()
    try:
        with pytest.raises(StreamingQueryException, match="planned failure"):
            await_all(spark)
        assert runs.isActive and not fails.isActive
        # a query that is stopped without a failure ends the wait as well
        spark.streams.resetTerminated()
        runs.stop()
        await_all(spark)
    finally:
        runs.stop()
        fails.stop()
        spark.streams.resetTerminated()


def test_stored_keys_are_not_broadcast(spark):
    path = f"{scratch_path(spark, 'test-absent')}/bars"
    df = spark.range(40).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit("1d").alias("horizon"),
                                F.when(F.col("id") != 7, "a").alias("symbol"))
    assert tables.insert_if_absent(df.where(F.col("date") < "2020-01-31"), path, tables.BARS) == 30
    rows = tables.with_chunk(df, tables.BARS)
    chunks = [r[0] for r in rows.select("chunk").distinct().collect()]
    fresh = tables.absent(rows, spark.read.parquet(path), chunks, tables.BARS)
    assert fresh.count() == 11                            # a null key is never found, as before
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
