"""Feature screens: variance, collinearity and class separation.

Every screen reads the table once; what reaches the driver is one row, two rows
or a square matrix with a side per feature.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import pvalues
from ..session import durable, literal_frame


def column_variances(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Sample variance per feature, smallest first."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.var_samp(F.col(c).cast("double")).alias("variance"))
        for c in features
    ]
    return df.agg(F.array(*cells).alias("v")).select(F.inline("v")).orderBy("variance", "feature")


def low_variance(df: DataFrame, features: Sequence[str], threshold: float = fixed.MIN_VARIANCE) -> DataFrame:
    """Variances with a drop mark for those at or under the threshold."""
    return column_variances(df, features).withColumn(
        "dropped", F.coalesce(F.col("variance"), F.lit(0.0)) <= F.lit(threshold)
    )


def keep_varying(df: DataFrame, features: Sequence[str], threshold: float = fixed.MIN_VARIANCE):
    """Feature names kept and dropped by the variance screen, in input order."""
    dropped = {r["feature"] for r in low_variance(df, features, threshold).where("dropped").collect()}
    return [c for c in features if c not in dropped], [c for c in features if c in dropped]


def is_complete(features: Sequence[str]) -> Column:
    """Whether every feature of a row is a number."""
    usable = F.lit(True)
    for c in features:
        usable = usable & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return usable


def complete_cases(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.where(is_complete(features))


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    """Pearson matrix over complete cases, from one distributed pass."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="_v").transform(
        complete_cases(df, features).select(*[F.col(c).cast("double") for c in features])
    )
    return Correlation.corr(vectors.select("_v"), "_v", "pearson").first()[0].toArray()


def _inflation(matrix: np.ndarray) -> np.ndarray:
    return np.diag(np.linalg.pinv(matrix))


def is_singular(matrix: np.ndarray) -> bool:
    return bool(np.linalg.matrix_rank(matrix) < len(matrix))


def vif(df: DataFrame, features: Sequence[str], limit: float = fixed.MAX_VIF) -> DataFrame:
    """Variance inflation factor per feature, largest first.

    ``is_singular`` marks a set whose columns are linearly dependent (a complete
    family of 0/1 flags, say); the pseudo-inverse then understates the factors.
    """
    matrix = correlation_matrix(df, features)
    singular = is_singular(matrix)
    rows = sorted(zip(features, _inflation(matrix)), key=lambda r: (-r[1], r[0]))
    return literal_frame(
        df.sparkSession,
        {"feature": "string", "vif": "double", "flagged": "boolean", "is_singular": "boolean"},
        [(name, float(v), bool(v > limit), singular) for name, v in rows],
    )


def vif_prune(df: DataFrame, features: Sequence[str], limit: float = fixed.MAX_VIF):
    """Names kept and dropped when the worst feature is removed until all are within the limit.

    The correlation of a subset of features is a sub-matrix of the full one, so
    the data are read once however many features fall.
    """
    matrix = correlation_matrix(df, features)
    keep, dropped = list(range(len(features))), []
    while len(keep) > 1:
        factors = _inflation(matrix[np.ix_(keep, keep)])
        worst = int(np.argmax(factors))
        if factors[worst] <= limit:
            break
        dropped.append(keep.pop(worst))
    return [features[i] for i in keep], [features[i] for i in dropped]


def vif_prune_table(df: DataFrame, features: Sequence[str], limit: float = fixed.MAX_VIF) -> DataFrame:
    kept, dropped = vif_prune(df, features, limit)
    rows = [(c, True, None) for c in kept] + [(c, False, i + 1) for i, c in enumerate(dropped)]
    return literal_frame(
        df.sparkSession, {"feature": "string", "kept": "boolean", "dropped_in_step": "int"}, rows
    )


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """F ratio, p-value and score scaled to 0-1 per feature, for a two-class label.

    Counts are per feature, so nulls neither count nor weigh.
    """
    moments = []
    for i, c in enumerate(features):
        x = F.col(c).cast("double")
        moments += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_samp(x).alias(f"v{i}")]
    per_class = durable(df.where(F.col(label).isNotNull()).groupBy(label).agg(*moments))
    found = per_class.count()
    if found != 2:
        raise ValueError(f"{label} must have two classes, found {found}")
    classes = per_class.collect()

    def ratio(i: int) -> tuple[float, float]:
        sizes = [r[f"n{i}"] for r in classes]
        if min(sizes) == 0:
            return math.nan, math.nan
        means = [r[f"m{i}"] for r in classes]
        centre = sum(n * m for n, m in zip(sizes, means)) / sum(sizes)
        between = sum(n * (m - centre) ** 2 for n, m in zip(sizes, means))
        within = sum((n - 1) * (r[f"v{i}"] or 0.0) for n, r in zip(sizes, classes))
        if within <= 0:
            return math.nan, math.nan
        freedom = sum(sizes) - 2
        f = between / (within / freedom)
        return f, pvalues.f_ratio(f, 1, freedom)

    scores = [(c, *ratio(i)) for i, c in enumerate(features)]
    known = [f for _, f, _ in scores if not math.isnan(f)]
    low, high = (min(known), max(known)) if known else (math.nan, math.nan)
    scaled = [(c, f, p, (f - low) / (high - low) if high > low else 0.0) for c, f, p in scores]
    scaled.sort(key=lambda r: (math.isnan(r[1]), -r[1], r[0]))
    return literal_frame(
        df.sparkSession,
        {"feature": "string", "f_score": "double", "p_value": "double", "scaled_score": "double"},
        scaled,
    )
