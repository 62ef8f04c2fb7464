import pandas as pd
import pytest

from seriesrel.operators.evaluate import classification_report
from seriesrel.operators.features import class_weights, time_folds


def expanding_split_rule(n, n_splits=3):
    t = n // (n_splits + 1)
    out = []
    for k in range(n_splits):
        start = n - (n_splits - k) * t
        out.append((list(range(0, start)), list(range(start, start + t))))
    return out


@pytest.mark.parametrize("n", [8, 13, 40])
def test_time_folds_match_expanding_split(spark, n):
    pdf = pd.DataFrame({"symbol": "a", "date": pd.date_range("2020-01-01", periods=n).date, "x": 1.0})
    f = time_folds(spark.createDataFrame(pdf)).toPandas()
    for k, (tr, te) in enumerate(expanding_split_rule(n)):
        sub = f[f.fold == k]
        assert sorted(sub[sub.role == "train"].row_index) == tr
        assert sorted(sub[sub.role == "test"].row_index) == te


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("a", 0)] * 9 + [("a", 1)] + [("b", 0)] * 4, "symbol string, target_anomaly int")
    w = {(r["symbol"], r["target_anomaly"]): r["weight"] for r in class_weights(df).collect()}
    assert w == {("a", 0): 10 / 18, ("a", 1): 5.0, ("b", 0): 1.0}


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 0, 0), ("a", 1, 0)],
                               "symbol string, target_anomaly int, pred_anomaly int")
    r = {x["label"]: x for x in classification_report(df).collect()}
    assert r["anomalous"]["precision"] == 0.0 and r["anomalous"]["recall"] == 0.0
    assert r["normal"]["precision"] == pytest.approx(2 / 3) and r["normal"]["recall"] == 1.0
    assert r["accuracy"]["f1_score"] == pytest.approx(2 / 3) and r["accuracy"]["support"] == 3
    assert r["macro avg"]["f1_score"] == pytest.approx(0.4)
    assert r["weighted avg"]["recall"] == pytest.approx(2 / 3)
