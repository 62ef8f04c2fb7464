"""Next-day models on Spark ML, evaluated on expanding time folds.

* regressor: gradient-boosted trees on the next-day z-score
  (100 trees, depth 3, step 0.1, seed 42); MAE per fold and the fold mean.
* classifier: random forest on the next-day anomaly flag (100 trees, depth 4,
  seed 42) with balanced class weights computed on each training set; the
  report covers the last fold only.

Both are refit on all rows of the symbol and can be saved with Spark ML
persistence. Each fit is a distributed Spark ML job; fits of different
symbols / folds are independent and are submitted concurrently from a small
thread pool (Spark schedules them side by side). The feature pipeline is
checkpointed once so the fits do not recompute it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS, N_SPLITS, TARGET_CLASS, TARGET_REGRESSION
from .evaluate import classification_report, last_fold, mae_by_fold
from .features import class_weights, time_folds


@dataclass
class ModelParams:
    gbt_iter: int = 100
    gbt_depth: int = 3
    gbt_step: float = 0.1
    rf_trees: int = 100
    rf_depth: int = 4
    seed: int = 42
    parallelism: int = 4


@dataclass
class TrainResult:
    predictions: DataFrame            # test-fold rows with pred_zscore / pred_anomaly
    mae: DataFrame                    # mae_by_fold of the regressor
    report: DataFrame                 # classification report, last fold
    models: dict = field(default_factory=dict)   # symbol -> (gbt, rf) fit on all rows


def with_balanced_weights(df: DataFrame, keys: tuple[str, ...], label: str = TARGET_CLASS) -> DataFrame:
    """Rows with ``class_weight`` of their label within ``keys``: a small aggregate joined back, so no
    task holds a whole training set. Rows with a null label have no weight and are left out."""
    weights = class_weights(df.where(F.col(label).isNotNull()), label, keys)
    return df.join(weights.select(*keys, label, F.col("weight").alias("class_weight")), [*keys, label])


def train_models(features: DataFrame, params: ModelParams | None = None, *,
                 n_splits: int = N_SPLITS, model_dir: str | None = None,
                 refit: bool = True, regressor: bool = True, classifier: bool = True) -> TrainResult:
    """Evaluate on every fold and, with ``refit``, fit on all rows; either model can be left out."""
    p = params or ModelParams()
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(features.sparkSession)
    assembler = VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")
    folded = time_folds(features, n_splits)
    data = assembler.transform(folded)
    # Cut the lineage once: the fits below re-read this frame many times.
    data = data.checkpoint(eager=True)
    train = with_balanced_weights(data.where(F.col("role") == "train"), ("symbol", "fold"))
    test = data.where(F.col("role") == "test")
    # The distinct symbols are the unit of model ownership (bounded by series
    # count); each fit itself is distributed.
    symbols = [r[0] for r in data.select("symbol").distinct().orderBy("symbol").collect()]

    def gbt():
        return GBTRegressor(featuresCol="features", labelCol=TARGET_REGRESSION,
                            predictionCol="pred_zscore", maxIter=p.gbt_iter,
                            maxDepth=p.gbt_depth, stepSize=p.gbt_step, seed=p.seed)

    def rf():
        return RandomForestClassifier(featuresCol="features", labelCol=TARGET_CLASS,
                                      predictionCol="pred_class", numTrees=p.rf_trees,
                                      maxDepth=p.rf_depth, seed=p.seed,
                                      weightCol="class_weight")

    def fit_fold(sym, k):
        tr = train.where((F.col("symbol") == sym) & (F.col("fold") == k))
        te = test.where((F.col("symbol") == sym) & (F.col("fold") == k))
        out = gbt().fit(tr).transform(te) if regressor else te.withColumn("pred_zscore", F.lit(None).cast("double"))
        if classifier:
            out = rf().fit(tr).transform(out.drop("rawPrediction", "probability"))
            out = out.withColumn("pred_anomaly", F.col("pred_class").cast("int"))
        else:
            out = out.withColumn("pred_anomaly", F.lit(None).cast("int"))
        return out.select("symbol", "date", "fold", "role", TARGET_REGRESSION, TARGET_CLASS,
                          "pred_zscore", "pred_anomaly")

    jobs = [(s, k) for s in symbols for k in range(n_splits)]
    with ThreadPoolExecutor(max_workers=p.parallelism) as pool:
        parts = list(pool.map(lambda a: fit_fold(*a), jobs))
    preds = parts[0]
    for part in parts[1:]:
        preds = preds.unionByName(part)

    models = {}
    if refit:
        # The last fold's train + test rows are every row exactly once.
        base = data.where(F.col("fold") == n_splits - 1).drop("fold", "role")
        # Class weights over all rows of each symbol for the final fit.
        base = with_balanced_weights(base, ("symbol",))

        def fit_all(sym):
            d = base.where(F.col("symbol") == sym)
            g, r = gbt().fit(d), rf().fit(d)
            if model_dir:
                g.write().overwrite().save(f"{model_dir}/{sym}/gbt_regressor")
                r.write().overwrite().save(f"{model_dir}/{sym}/rf_classifier")
            return sym, (g, r)

        with ThreadPoolExecutor(max_workers=p.parallelism) as pool:
            models = dict(pool.map(fit_all, symbols))

    return TrainResult(predictions=preds, mae=mae_by_fold(preds),
                       report=classification_report(last_fold(preds, n_splits)),
                       models=models)
