from conftest import SF_SMALL


def test_train_models_small(spark):
    from seriesrel.operators.features import features_from_bars
    from seriesrel.operators.models import ModelParams, train_models
    from seriesrel.plans.catalog import bars
    from seriesrel.session import scratch_path
    feats = features_from_bars(bars(spark, SF_SMALL))
    root = scratch_path(spark, "t-models")
    res = train_models(feats, ModelParams(gbt_iter=3, rf_trees=5, parallelism=2), model_dir=root)
    mae = res.mae.collect()
    assert len(mae) == 3 * feats.select("symbol").distinct().count()
    assert all(r["mae"] >= 0 for r in mae)
    labels = {r["label"] for r in res.report.collect()}
    assert labels == {"normal", "anomalous", "accuracy", "macro avg", "weighted avg"}
    from pyspark.ml.regression import GBTRegressionModel
    sym = sorted(res.models)[0]
    assert GBTRegressionModel.load(f"{root}/{sym}/gbt_regressor").getNumTrees == 3


def test_balanced_weights_by_aggregate(spark):
    from collections import Counter
    from seriesrel.operators.models import with_balanced_weights
    rows = [(s, f, i, label) for s in "ab" for f in (0, 1) for i, label in enumerate([0] * (5 + f) + [1] * 2)]
    rows += [("one", 0, i, 1) for i in range(4)] + [("a", 0, 99, None)]
    df = spark.createDataFrame(rows, "symbol string, fold int, id int, label int")
    got = with_balanced_weights(df, ("symbol", "fold"), "label").collect()
    labelled = [r for r in rows if r[3] is not None]
    size = Counter((s, f) for s, f, _, _ in labelled)
    of_class = Counter((s, f, y) for s, f, _, y in labelled)
    classes = Counter((s, f) for s, f, _ in of_class)
    want = {(s, f, i): size[s, f] / (classes[s, f] * of_class[s, f, y]) for s, f, i, y in labelled}
    assert {(r["symbol"], r["fold"], r["id"]): r["class_weight"] for r in got} == want
