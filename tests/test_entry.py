import duckdb
import pytest

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["symbol", "date", "horizon", "metric", "value"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    import __spark_entry__ as e
    rows_only = set(e.queries()) - set(e.oracle_sql()) - set(e.LLM_QUERIES)
    assert rows_only == {"changepoints", "changepoint_alerts", "changepoints_blocked", "detect_alerts",
                         "latest_alerts_all_kinds", "alert_counts_all_kinds",
                         "model_regressor", "model_classifier"}


@pytest.mark.parametrize("name", ["aligned_bars", "metrics_long", "cusum_alerts",
                                  "features_lagged", "classification_report",
                                  "series_union_first_wins", "latest_alerts"])
def test_oracle_small(spark, name):
    import __spark_entry__ as e
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    ours = e.queries()[name](spark, SF_SMALL)
    res = con.execute(e.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    theirs = sorted(tuple(str(v) for v in r) for r in res.fetchall())
    mine = sorted(tuple(str(v) for v in r) for r in ours.select(*cols).collect())
    assert mine == theirs
