"""Forecast evaluation: MAE per fold and the two-class classification report.

Both are aggregations over prediction frames, so they work the same for the
naive baseline and for Spark ML predictions, for one symbol or thousands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ANOMALY_CUT, CLASS_LABELS, N_SPLITS, TARGET_CLASS, TARGET_REGRESSION


def naive_predictions(folded: DataFrame, *, cut: float = ANOMALY_CUT,
                      zscore_col: str = "spread_zscore_30d") -> DataFrame:
    """Persistence forecast: tomorrow's z-score is today's; tomorrow is
    anomalous when today is."""
    z = F.col(zscore_col)
    return folded.withColumn("pred_zscore", z) \
                 .withColumn("pred_anomaly", (F.abs(z) > F.lit(cut)).cast("int"))


def mae_by_fold(preds: DataFrame, *, target: str = TARGET_REGRESSION,
                pred: str = "pred_zscore", keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """MAE of each test fold and the mean of the fold MAEs per key group."""
    test = preds.where(F.col("role") == "test")
    per_fold = test.groupBy(*keys, "fold").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(F.abs(F.col(target) - F.col(pred))).alias("mae"))
    return per_fold.withColumn("mae_mean", F.avg("mae").over(Window.partitionBy(*keys)))


def classification_report(preds: DataFrame, *, label: str = TARGET_CLASS,
                          pred: str = "pred_anomaly", keys: tuple[str, ...] = ("symbol",),
                          labels: tuple[str, str] = CLASS_LABELS) -> DataFrame:
    """Precision / recall / F1 / support per class, accuracy, macro and
    weighted averages; undefined ratios are 0 (``zero_division=0``)."""
    y, p = F.col(label), F.col(pred)

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    c = preds.groupBy(*keys).agg(
        n((y == 1) & (p == 1)).alias("tp1"), n((y == 0) & (p == 1)).alias("fp1"),
        n((y == 1) & (p == 0)).alias("fn1"), n((y == 0) & (p == 0)).alias("tn1"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp1, fp1, fn1, tn1 = (F.col(x) for x in ("tp1", "fp1", "fn1", "tn1"))
    s1, s0 = tp1 + fn1, tn1 + fp1
    total = s1 + s0
    p1, r1, f1 = ratio(tp1, tp1 + fp1), ratio(tp1, s1), ratio(2 * tp1, 2 * tp1 + fp1 + fn1)
    p0, r0, f0 = ratio(tn1, tn1 + fn1), ratio(tn1, s0), ratio(2 * tn1, 2 * tn1 + fn1 + fp1)
    acc = ratio(tp1 + tn1, total)

    def row(name, pr, rc, f, sup):
        return F.struct(F.lit(name).alias("label"), pr.alias("precision"),
                        rc.alias("recall"), f.alias("f1_score"), sup.alias("support"))

    null = F.lit(None).cast("double")
    wavg = lambda a, b: ratio(a * s0 + b * s1, total)
    rows = F.array(
        row(labels[0], p0, r0, f0, s0),
        row(labels[1], p1, r1, f1, s1),
        row("accuracy", null, null, acc, total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        row("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), total),
    )
    return c.select(*keys, F.inline(rows))


def last_fold(preds: DataFrame, n_splits: int = N_SPLITS) -> DataFrame:
    """Test rows of the last fold (the reference reports only that one)."""
    return preds.where((F.col("fold") == n_splits - 1) & (F.col("role") == "test"))
