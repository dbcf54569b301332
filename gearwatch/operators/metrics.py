"""Classifier metrics from confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """0 when there is nothing to divide by."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision and recall of class 1, and accuracy, in one row."""
    truth, guess = F.col(label) == 1, F.col(prediction) == 1
    hit, guessed, true = F.count_if(truth & guess), F.count_if(guess), F.count_if(truth)
    return df.agg(_ratio(hit, guessed).alias("precision"), _ratio(hit, true).alias("recall"),
                  _ratio(F.count_if(F.col(label) == F.col(prediction)), F.count(F.lit(1))).alias("accuracy"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, f1 and support per class, with accuracy, macro and weighted averages.

    The data is read once for the confusion counts; the rest works on one row per class pair.
    """
    counts = (df.groupBy(F.col(label).cast("int").alias("t"), F.col(prediction).cast("int").alias("p"))
              .agg(F.count(F.lit(1)).alias("n")))
    sides = counts.selectExpr("stack(2, t, n, 0L, IF(t = p, n, 0L), p, 0L, n, 0L) AS (class, support, guessed, hit)")
    totals = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    precision, recall = _ratio(F.col("hit"), F.col("guessed")), _ratio(F.col("hit"), F.col("support"))
    classes = totals.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f1", _ratio(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    names = ["precision", "recall", "f1"]
    per_class = classes.select(F.col("class").cast("string").alias("class"), *names, "support")
    support = F.sum("support")
    macro = classes.agg(*[F.avg(c).alias(c) for c in names], support.alias("support")).select(F.lit("macro avg").alias("class"), "*")
    weighted = (classes.agg(*[_ratio(F.sum(F.col(c) * F.col("support")), support).alias(c) for c in names], support.alias("support"))
                .select(F.lit("weighted avg").alias("class"), "*"))
    accuracy = (classes.agg(_ratio(F.sum("hit"), support).alias("a"), support.alias("support"))
                .select(F.lit("accuracy").alias("class"), *[F.col("a").alias(c) for c in names], "support"))
    return per_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def label_counts(df: DataFrame, label: Column) -> DataFrame:
    return df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("rows"))
