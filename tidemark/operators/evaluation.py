"""Evaluation of scored rows: AUC, ROC, confusion counts and group fairness."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as fixed
from .prefix import ROWS_PER_BUCKET, running_sums


def _class_sums(label: str) -> dict:
    return {
        "pos": F.when(F.col(label) == 1, 1).otherwise(0),
        "neg": F.when(F.col(label) == 0, 1).otherwise(0),
    }


def auc(df: DataFrame, label: str, score: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs ranked right.

    Ties count half.  Null when a class is absent.
    """
    frame, totals = running_sums(df, score, _class_sums(label), rows_per_bucket=rows_per_bucket)
    lower = (F.col("upto_neg") - F.col("neg")).cast("double") + F.col("neg") / 2
    pairs = float(totals["pos"]) * float(totals["neg"])
    return frame.agg(
        F.try_divide(F.sum(F.col("pos") * lower), F.lit(pairs)).alias("auc"),
        F.lit(int(totals["pos"])).cast("bigint").alias("n_positive"),
        F.lit(int(totals["neg"])).cast("bigint").alias("n_negative"),
    )


def roc_points(
    df: DataFrame, label: str, score: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """One point per distinct score, and the origin at an infinite threshold."""
    frame, totals = running_sums(df, score, _class_sums(label), rows_per_bucket=rows_per_bucket)
    pos, neg = int(totals["pos"]), int(totals["neg"])

    def share(name: str, whole: int):
        at_or_over = F.lit(whole) - F.col(f"upto_{name}") + F.col(name)
        return F.try_divide(at_or_over.cast("double"), F.lit(float(whole)))

    points = frame.select(
        F.col(score).alias("threshold"), share("neg", neg).alias("fpr"), share("pos", pos).alias("tpr")
    )
    origin = df.sparkSession.range(1, numPartitions=1).select(
        F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, names: Mapping[str, str] = fixed.CONFUSION_LABELS
) -> DataFrame:
    """The four counts as rows, zero where a combination does not occur."""
    cells = {
        "true_negative": (0, 0),
        "false_positive": (0, 1),
        "false_negative": (1, 0),
        "true_positive": (1, 1),
    }
    counted = [
        F.struct(
            F.lit(cell).alias("cell"),
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted)).alias("n"),
            F.lit(names[cell]).alias("meaning"),
        )
        for cell, (actual, predicted) in cells.items()
    ]
    return df.agg(F.array(*counted).alias("cells")).select(F.inline("cells"))


def group_rates(df: DataFrame, group: str, prediction: str) -> DataFrame:
    """Share of positive predictions per group."""
    return df.groupBy(F.col(group).alias("group_value")).agg(
        F.avg(F.col(prediction).cast("int")).alias("positive_rate"), F.count("*").alias("n_rows")
    )


def disparate_impact(rates: DataFrame, limit: float = fixed.FOUR_FIFTHS) -> DataFrame:
    """Smallest over largest group rate; 1 for a single group, null if no group is ever positive."""
    ratio = F.when(F.count("*") > 1, F.try_divide(F.min("positive_rate"), F.max("positive_rate"))).otherwise(
        F.lit(1.0)
    )
    return rates.agg(ratio.alias("disparate_impact_ratio"), F.count("*").alias("n_groups")).withColumn(
        "four_fifths_flag", F.col("disparate_impact_ratio") < F.lit(limit)
    )


def fairness_report(df: DataFrame, prediction: str, gender="gender", age="age") -> DataFrame:
    """Positive rates by gender and age band, and the gender impact ratio, as long rows.

    Rows are combined per (gender, band) once; both breakdowns and the ratio
    come from that small table.
    """
    band = "age_band"
    cells = (
        df.withColumn(band, C.banded(F.col(age)))
        .groupBy(gender, band)
        .agg(F.count(prediction).alias("n"), F.sum(F.col(prediction).cast("int")).alias("hits"))
    )

    def rates(column: str, metric: str) -> DataFrame:
        return cells.groupBy(F.col(column).alias("label")).agg(
            F.try_divide(F.sum("hits"), F.sum("n")).alias("value")
        ).select(F.lit(metric).alias("metric"), "label", "value")

    by_gender = rates(gender, "positive_rate_by_gender")
    impact = disparate_impact(by_gender.withColumnRenamed("value", "positive_rate"))
    ratio = impact.select(
        F.lit("disparate_impact_ratio").alias("metric"),
        F.lit(gender).alias("label"),
        F.col("disparate_impact_ratio").alias("value"),
    )
    flag = impact.select(
        F.lit("four_fifths_flag").alias("metric"),
        F.lit(gender).alias("label"),
        F.col("four_fifths_flag").cast("int").cast("double").alias("value"),
    )
    return by_gender.unionByName(rates(band, "positive_rate_by_age_band")).unionByName(ratio).unionByName(flag)
