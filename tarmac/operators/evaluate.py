"""Exact evaluation tables over (label, score / prediction) columns.

All metrics are aggregates, so they run on any number of prediction rows:

* confusion matrix, class balance: grouped counts;
* RMSE / R²: sums of squares in one pass (R² = 1 - SSE / SST);
* exact AUC (rank formula with ties counted half) and the ROC curve: per-score
  positive / negative counts (partial aggregation collapses repeated scores),
  then running sums along the score with ``prefix_sums`` — no single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.numbering import prefix_sums


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def confusion_matrix(df: DataFrame, label: str = "delayed", prediction: str = "prediction") -> DataFrame:
    """count per (y, yhat), ordered by y, yhat."""
    return (
        df.groupBy(_c(label).cast("int").alias("y"), _c(prediction).cast("int").alias("yhat"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("y", "yhat")
    )


def confusion_summary(df: DataFrame, label: str = "delayed", prediction: str = "prediction") -> DataFrame:
    """TN, FP, FN, TP, accuracy, precision, recall in one row."""
    y, p = _c(label).cast("int"), _c(prediction).cast("int")
    counts = df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.select(
        "tn", "fp", "fn", "tp",
        F.try_divide(F.col("tn") + F.col("tp"), total).alias("accuracy"),
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )


def class_balance(df: DataFrame, label: str = "delayed") -> DataFrame:
    y = _c(label)
    return df.agg(F.count_if(y == 1).alias("positive"), F.count_if(y == 0).alias("negative"))


def regression_metrics(df: DataFrame, label: str = "arr_delay", prediction: str = "prediction",
                       digits: int = 6) -> DataFrame:
    """n, RMSE and R² in one aggregate (exact, no sampling)."""
    y, p = _c(label), _c(prediction)
    pairs = df.where(y.isNotNull() & p.isNotNull())
    err = y - p
    agg = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(y).alias("_var"),
    )
    return agg.select(
        "n",
        F.round(F.sqrt(F.try_divide("_sse", "n")), digits).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide("_sse", F.col("_var") * F.col("n")), digits).alias("r2"),
    )


def score_counts(df: DataFrame, label: str = "delayed", score: str | Column = "score") -> DataFrame:
    """(score, pos, neg): one row per distinct score."""
    y = _c(label)
    return (
        df.where(_c(score).isNotNull() & y.isNotNull())
        .groupBy(_c(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def exact_auc(df: DataFrame, label: str = "delayed", score: str | Column = "score") -> DataFrame:
    """Area under the ROC curve: P(score+ > score-) + P(score+ = score-) / 2.

    One row: n_pos, n_neg, auc (NULL when a class is absent).
    """
    counts = score_counts(df, label, score)
    below = prefix_sums(counts, "score", ["neg", "pos"], inclusive=False)
    agg = below.agg(
        # doubles: products of two counts leave the long range at a few billion rows
        F.sum(F.col("pos").cast("double") * (F.col("cum_neg") + F.col("neg") * 0.5)).alias("_num"),
        F.first("total_pos").alias("n_pos"),
        F.first("total_neg").alias("n_neg"),
    )
    return agg.select(
        F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
        F.coalesce("n_neg", F.lit(0)).alias("n_neg"),
        F.try_divide("_num", F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"),
    )


def roc_curve(df: DataFrame, label: str = "delayed", score: str | Column = "score",
              digits: int | None = None) -> DataFrame:
    """One ROC point per distinct score (descending thresholds) plus the origin.

    threshold, fpr, tpr: rates of rows with score >= threshold (NULL for an absent
    class).  ``digits`` thins the curve: of the thresholds whose rates round to the same
    point the lowest stays.
    """
    counts = score_counts(df, label, score)
    cum = prefix_sums(counts, "score", ["pos", "neg"], descending=True, inclusive=True)
    points = cum.select(
        F.col("score").alias("threshold"),
        F.try_divide("cum_neg", "total_neg").alias("fpr"),
        F.try_divide("cum_pos", "total_pos").alias("tpr"),
    )
    if digits is not None:
        points = (points.groupBy(F.round("fpr", digits).alias("fpr"), F.round("tpr", digits).alias("tpr"))
                  .agg(F.min("threshold").alias("threshold")).select("threshold", "fpr", "tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points).orderBy(F.col("threshold").desc_nulls_first())
