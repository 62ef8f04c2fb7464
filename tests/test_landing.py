import datetime as dt


from seriesrel.sources import landing

D = dt.date
T = "<rates><item><title> EUR </title><description>1.1</description></item>%s</rates>"


def test_xml_rules(spark):
    docs = spark.createDataFrame([
        ("01.02.2024", T % "<item><title> USD </title><description> 475.2 </description></item>"),
        ("02.02.2024", T % "<item><title>USD</title></item>"),                 # missing text -> 0
        ("03.02.2024", T % "<item><title>USD</title><description></description></item>"),  # fails
        ("04.02.2024", T % ""),                                                 # no USD -> skipped
        ("05.02.2024", "<rates><item>"),                                        # broken -> skipped
        ("06.02.2024", T % ("<item><title>USD</title><description>2</description></item>"
                            "<item><title>USD</title><description>3</description></item>")),
    ], "fdate string, body string")
    got = {r["date"]: r["rate"] for r in landing.read_xml_rates(docs).collect()}
    assert got == {D(2024, 2, 1): 475.2, D(2024, 2, 2): 0.0, D(2024, 2, 6): 2.0}


def test_union_first_wins_gap_and_missing_days(spark):
    hist = spark.createDataFrame([(D(2024, 1, d), 1.0) for d in (1, 2, 3, 5)], "date date, rate double")
    recent = spark.createDataFrame([(D(2024, 1, d), 2.0) for d in (3, 4, 6, 8)], "date date, rate double")
    u = {r["date"].day: r["rate"] for r in landing.union_first_wins(hist, recent).collect()}
    assert u == {1: 1.0, 2: 1.0, 3: 1.0, 4: 2.0, 5: 1.0, 6: 2.0, 8: 2.0}
    gap = sorted(r["date"].day for r in landing.gap_after(hist, recent).collect())
    assert gap == [6, 8]
    miss = sorted(r["date"].day for r in landing.missing_days(landing.union_first_wins(hist, recent)).collect())
    assert miss == [7]
    assert landing.next_fetch_start(hist).collect()[0][0] == D(2024, 1, 6)


def test_gap_per_key_and_value_on_day(spark):
    hist = spark.createDataFrame([("a", D(2024, 1, 2), 1.0), ("b", D(2024, 1, 5), 1.0)],
                                 "instrument_id string, date date, v double")
    new = spark.createDataFrame([("a", D(2024, 1, d), 2.0) for d in (1, 3)] + [("c", D(2024, 1, 1), 3.0)],
                                "instrument_id string, date date, v double")
    got = sorted((r["instrument_id"], r["date"].day) for r in
                 landing.gap_after(hist, new, keys=("instrument_id",)).collect())
    assert got == [("a", 3), ("c", 1)]
    pick = landing.value_on_day(new, "2024-01-03").collect()
    assert [(r["instrument_id"], r["v"]) for r in pick] == [("a", 2.0)]
    newest = sorted((r["instrument_id"], r["date"].day) for r in landing.newest_day(new).collect())
    assert newest == [("a", 3), ("c", 1)]


def test_csv_and_json_pages(spark, tmp_path):
    csv = tmp_path / "hist.csv"
    csv.write_text("Date,USD,EUR\n31.12.2023,450.5,500\n01.01.2024,x,1\n02.01.2024,451,2\n")
    got = {r["date"]: r["rate"] for r in landing.read_history_csv(spark, str(csv)).collect()}
    assert got == {D(2023, 12, 31): 450.5, D(2024, 1, 1): None, D(2024, 1, 2): 451.0}
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p1.json").write_text(
        '{"response": {"total": 3, "data": [{"period": "2024-01-02", "value": "80.5", "product": "b"},'
        ' {"period": "2024-01-03", "value": 81, "product": "b"}]}}\n'
        '{"response": {"total": "3", "data": [{"period": "2024-01-04", "value": "82", "product": "b"}]}}\n')
    rows = landing.read_json_pages(spark, str(pages))
    assert sorted(r["price"] for r in rows.collect()) == [80.5, 81.0, 82.0]
    c = landing.page_completeness(rows).collect()[0]
    assert (c["n_rows"], c["announced_total"]) == (3, 3)


def test_gap_after_an_empty_history(spark):
    import datetime as dt
    recent = spark.createDataFrame([(dt.date(2020, 1, k), float(k)) for k in range(1, 7)], "date date, rate double")
    assert landing.gap_after(recent.limit(0), recent).count() == 6
    assert landing.gap_after(recent.where("rate < 3"), recent).count() == 4
    assert landing.gap_after(recent, recent).count() == 0


def test_missing_on_day(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("a", dt.date(2020, 1, 2)), ("b", dt.date(2020, 1, 1))], "instrument_id string, date date")
    got = landing.missing_on_day(rows, F.lit("2020-01-02"))
    assert [tuple(r) for r in got.collect()] == [("b", dt.date(2020, 1, 1))]
