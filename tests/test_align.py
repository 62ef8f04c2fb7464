import datetime as dt
import math

from pyspark.sql import functions as F

from seriesrel.operators.align import align, add_log_returns, fill_reference, join_reference

D = dt.date


def lead(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, price double")


def ref(spark, rows):
    return spark.createDataFrame(rows, "date date, rate double")


def test_docstring_example(spark):
    out = align(lead(spark, [("brent", D(2024, 1, 1), 80.0), ("brent", D(2024, 1, 2), 84.0)]),
                ref(spark, [(D(2024, 1, 1), 450.0), (D(2024, 1, 2), 459.0)])).collect()
    assert len(out) == 1
    assert round(out[0]["lead_logret"], 4) == 0.0488
    assert out[0]["horizon"] == "1d" and out[0]["lead_quality"] == 0 and out[0]["ref_quality"] == 0


def test_exact_date_left_join_then_fill(spark):
    # reference on 01-02 has no lead row: never seen, not even by 01-03
    l = lead(spark, [("a", D(2024, 1, 1), 10.0), ("a", D(2024, 1, 3), 11.0), ("a", D(2024, 1, 4), 12.0)])
    r = ref(spark, [(D(2024, 1, 1), 100.0), (D(2024, 1, 2), 999.0), (D(2024, 1, 4), 110.0)])
    f = {x["date"]: x["ref_rate"] for x in fill_reference(join_reference(l, r)).collect()}
    assert f == {D(2024, 1, 1): 100.0, D(2024, 1, 3): 100.0, D(2024, 1, 4): 110.0}
    bars = {x["date"]: x for x in align(l, r).collect()}
    assert bars[D(2024, 1, 3)]["ref_logret"] == 0.0          # filled day: return exactly 0
    assert math.isclose(bars[D(2024, 1, 4)]["ref_logret"], math.log(1.1))


def test_missing_lead_price_kills_two_returns(spark):
    l = lead(spark, [("a", D(2024, 1, d), p) for d, p in [(1, 1.0), (2, None), (3, 2.0), (4, 3.0)]])
    r = ref(spark, [(D(2024, 1, d), 5.0 + d) for d in range(1, 5)])
    assert [x["date"] for x in align(l, r).orderBy("date").collect()] == [D(2024, 1, 4)]


def test_null_leading_reference_and_nonpositive_prices(spark):
    l = lead(spark, [("a", D(2024, 1, d), p) for d, p in [(1, 1.0), (2, 2.0), (3, 0.0), (4, 3.0), (5, -1.0), (6, -2.0)]])
    r = ref(spark, [(D(2024, 1, d), 5.0 + d) for d in range(2, 7)])
    rets = {x["date"]: x for x in add_log_returns(fill_reference(join_reference(l, r))).collect()}
    assert rets[D(2024, 1, 2)]["ref_logret"] is None          # previous reference is NULL
    assert rets[D(2024, 1, 3)]["lead_logret"] is None         # ln(0): NULL (deviation V1)
    assert rets[D(2024, 1, 4)]["lead_logret"] is None         # ratio 3/0 undefined
    assert rets[D(2024, 1, 5)]["lead_logret"] is None         # negative ratio
    assert math.isclose(rets[D(2024, 1, 6)]["lead_logret"], math.log(2.0))  # -2/-1
    got = [x["date"] for x in align(l, r).orderBy("date").collect()]
    assert got == [D(2024, 1, 6)]


def test_many_symbols_one_plan(spark):
    rows = [(s, D(2024, 1, d), float(d * (i + 1))) for i, s in enumerate("xyz") for d in range(1, 6)]
    r = ref(spark, [(D(2024, 1, d), 100.0 + d) for d in range(1, 6)])
    out = align(lead(spark, rows), r)
    assert out.groupBy("symbol").count().where(F.col("count") == 4).count() == 3


def test_series_from_raw_takes_last_tick_of_each_utc_day(spark):
    from seriesrel.operators.align import series_from_raw
    raw = spark.createDataFrame(
        [("wti", "2024-01-01T09:00:00Z", 70.0), ("wti", "2024-01-01T23:59:59Z", 71.0),
         ("wti", "2024-01-02T00:00:01Z", 72.0), ("brent", "2024-01-01T12:00:00Z", 80.0)],
        "instrument_id string, t string, price double"
    ).withColumn("event_time_utc", F.to_timestamp("t")).drop("t")
    got = {(r["symbol"], r["date"]): r["price"] for r in series_from_raw(raw, "price").collect()}
    assert got == {("wti", D(2024, 1, 1)): 71.0, ("wti", D(2024, 1, 2)): 72.0,
                   ("brent", D(2024, 1, 1)): 80.0}


def test_one_answer_however_rows_are_partitioned(spark):
    from seriesrel.operators.align import align, series_from_raw
    from seriesrel.sources.landing import union_first_wins, value_on_day
    raw = spark.createDataFrame(
        [("a", f"2024-01-0{1 + i % 3}T05:00:00", f"2024-01-0{1 + i % 3}T06:00:00", "s", float(i * 7 % 11)) for i in range(12)],
        "instrument_id string, e string, g string, source string, price double").selectExpr(
        "instrument_id", "CAST(e AS TIMESTAMP) AS event_time_utc", "CAST(g AS TIMESTAMP) AS ingest_time_utc", "source", "price")
    days = raw.selectExpr("CAST(event_time_utc AS DATE) AS date", "instrument_id", "price")
    answers = set()
    for n in (1, 2, 3, 5, 8):
        answers.add((tuple(sorted(map(tuple, series_from_raw(raw.repartition(n), "price").collect()))),
                     tuple(sorted(map(tuple, union_first_wins(days.repartition(n), days, keys=("date",)).collect()))),
                     tuple(map(tuple, value_on_day(days.repartition(n), "2024-01-02").collect()))))
    assert len(answers) == 1
    lead = spark.createDataFrame([("x", f"2024-01-0{d}", 80.0 + d) for d in (1, 2, 3, 4)], "symbol string, date string, price double")
    ref = spark.createDataFrame([(f"2024-01-0{d}", 450.0 + d) for d in (1, 2, 2, 3, 4)] + [("2024-01-03", 460.0)], "date string, rate double")
    assert align(lead, ref).count() == 3
