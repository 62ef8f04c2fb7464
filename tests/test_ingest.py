import json

from pyspark.sql import functions as F

from seriesrel.streaming import ingest


def env(**over):
    base = {"schema_version": 1, "source": "feed", "instrument_id": "brent",
            "event_time_utc": "2024-01-01T00:00:00Z", "ingest_time_utc": "2024-01-01T00:00:00Z",
            "quality_flag": 0, "payload": {"price": "82.1"}}
    base.update(over)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def check(spark, messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "id long, value string")
    return {r["id"]: r for r in ingest.validate(ingest.decode(df)).collect()}


def test_valid_envelope_equal_times_and_defaults(spark):
    out = check(spark, [env(), env(schema_version=..., quality_flag=...)])
    assert out[0]["reject_reasons"] == []
    assert out[1]["reject_reasons"] == [] and out[1]["schema_version"] == 1 and out[1]["quality_flag"] == 0


def test_adversarial_messages_are_quarantined_not_fatal(spark):
    msgs = ["{not json", env(quality_flag=4), env(source=""), env(instrument_id=...),
            env(event_time_utc="2024-01-02T00:00:00Z"), env(event_time_utc="junk"),
            env(schema_version=0), env(quality_flag="high"), env(payload=...)]
    out = check(spark, msgs)
    reasons = {i: set(r["reject_reasons"]) for i, r in out.items()}
    assert "malformed_json" in reasons[0]
    assert reasons[1] == {"quality_flag_invalid"}
    assert reasons[2] == {"source_empty"}
    assert reasons[3] == {"instrument_empty"}
    assert reasons[4] == {"event_after_ingest"}
    assert reasons[5] == {"event_time_invalid"}
    assert reasons[6] == {"schema_version_invalid"}
    assert reasons[7] == {"quality_flag_invalid"}
    assert reasons[8] == {"payload_missing"}


def test_routes_and_payload_values(spark):
    msgs = [env(), env(instrument_id="usdkzt", payload={"rate": "475.2"}),
            env(payload={"price": "abc"}), env(payload={"other": "1"}), env(instrument_id="zzz")]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "id long, value string")
    good = ingest.valid(ingest.validate(ingest.decode(df)))
    lead = {r["id"]: r["price"] for r in ingest.route_rows(good, ingest.LEAD_ROUTE, ("id",)).collect()}
    assert lead == {0: 82.1, 2: None, 3: None}
    ok, bad = ingest.split_route(ingest.route_rows(good, ingest.LEAD_ROUTE, ("id",)), ingest.LEAD_ROUTE)
    assert ok.count() == 1 and bad.count() == 2
    refr = ingest.route_rows(good, ingest.REFERENCE_ROUTE).collect()
    assert [r["rate"] for r in refr] == [475.2]


def test_encode_decode_roundtrip(spark):
    s = spark.createDataFrame([("brent", "2024-03-01", 82.5)], "i string, d string, p double") \
             .withColumn("d", F.to_date("d"))
    e = ingest.series_to_envelopes(s, instrument_col="i", time_col="d", value_col="p",
                                   payload_key="price", source="feed")
    r = ingest.validate(ingest.decode(e)).collect()[0]
    assert r["reject_reasons"] == [] and r["payload"] == {"price": "82.5"}
    assert str(r["event_time_utc"]).startswith("2024-03-01")
