"""Data-quality checks.  Each is one or two aggregates whose result is tiny."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..session import durable_with
from .quantiles import exact_quantiles


def percent(part, whole):
    """Percentage with two decimals, 0 for an empty table."""
    return F.coalesce(F.round(F.try_divide(100.0 * part, whole), 2), F.lit(0.0))


def referential_integrity(parents: DataFrame, children: Mapping[str, DataFrame], key="id") -> DataFrame:
    """Distinct child keys without a parent, per child table.

    Child keys are made distinct before the anti-join, so a hot key is one row.
    """
    known = parents.select(key).distinct()
    parts = [
        child.select(key)
        .distinct()
        .join(known, key, "left_anti")
        .agg(F.count("*").alias("orphan_keys"))
        .select(F.lit(name).alias("child"), "orphan_keys", (F.col("orphan_keys") == 0).alias("passed"))
        for name, child in children.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], sentinels: Sequence[float] = fixed.SENTINELS
) -> DataFrame:
    """Interquartile fence, rows outside it, range and placeholder hits per column.

    All columns share the quantile passes and one counting pass.
    """
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    facts = []
    for c in columns:
        x = F.col(c)
        q1, q3 = quartiles[c]
        if q1 is None:
            low = high = F.lit(None).cast("double")
        else:
            low = F.lit(q1 - fixed.FENCE_WIDTH * (q3 - q1))
            high = F.lit(q3 + fixed.FENCE_WIDTH * (q3 - q1))
        outside = F.count_if((x < low) | (x > high))
        facts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.first(low).alias("lower_bound"),
                F.first(high).alias("upper_bound"),
                F.min(x).cast("double").alias("min_value"),
                F.max(x).cast("double").alias("max_value"),
                outside.alias("n_outliers"),
                percent(outside, F.count("*")).alias("pct_outliers"),
                F.count_if(x.isin(*sentinels)).alias("n_sentinel_hits"),
            )
        )
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def negative_values(df: DataFrame, value="balance", key="id") -> DataFrame:
    """How often, for how many customers and how deep a value is negative."""
    below = F.col(value) < 0
    return (
        df.groupBy(key)
        .agg(
            F.count("*").alias("n"),
            F.count_if(below).alias("negative"),
            F.min(F.when(below, F.col(value))).alias("deepest"),
            F.sum(F.when(below, F.col(value))).alias("total"),
        )
        .agg(
            F.coalesce(F.sum("negative"), F.lit(0)).alias("n_negative_rows"),
            percent(F.sum("negative"), F.sum("n")).alias("pct_negative_rows"),
            F.count_if(F.col("negative") > 0).alias("n_keys_ever_negative"),
            percent(F.count_if(F.col("negative") > 0), F.count("*")).alias("pct_keys_ever_negative"),
            F.min("deepest").alias("min_value"),
            F.try_divide(F.sum("total"), F.sum("negative")).alias("avg_negative"),
        )
    )


def thin_history_flag(df: DataFrame, count_column: str, threshold: float, name="flag_insufficient_history"):
    return df.withColumn(name, (F.col(count_column) <= F.lit(threshold)).cast("int"))


def thin_history(df: DataFrame, count_column: str, level: float = fixed.THIN_HISTORY_LEVEL) -> DataFrame:
    """Low quantile of the history length and the customers at or under it."""
    threshold = exact_quantiles(df, {count_column: [level]})[count_column][0]
    flagged = F.count_if(F.col(count_column) <= F.lit(threshold))
    return df.agg(
        F.lit(level).alias("level"),
        F.lit(threshold).cast("double").alias("threshold"),
        flagged.alias("n_flagged"),
        percent(flagged, F.count("*")).alias("pct_flagged"),
    )


def empirical_thresholds(
    transactions: DataFrame, customers: DataFrame, balance="balance", age="age"
) -> dict[str, float | None]:
    """Low-balance limit (tenth percentile of positive balances) and age tertiles."""
    positive = transactions.select(F.when(F.col(balance) > 0, F.col(balance)).alias("positive"))
    (low,) = exact_quantiles(positive, {"positive": [fixed.LOW_BALANCE_LEVEL]})["positive"]
    young, middle = exact_quantiles(customers, {age: list(fixed.AGE_TERTILE_LEVELS)})[age]
    return {"low_balance_threshold": low, "age_tertile_33": young, "age_tertile_66": middle}


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage per class, null being a class of its own."""
    counts, seen = durable_with(df.groupBy(label).agg(F.count("*").alias("n")), total=F.sum("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.lit(seen["total"]).cast("bigint")))


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts as rows; a null category is the text ``null``."""
    return df.groupBy(
        *[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in (a, b)]
    ).agg(F.count("*").alias("n"))


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, in one aggregate.

    Pairs with a null on either side are skipped pairwise; a constant column has
    no correlation (NaN, and 1 with itself).
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    names = {frozenset(p): f"r{i}" for i, p in enumerate(pairs)}
    one_row = df.agg(*[F.corr(a, b).alias(names[frozenset((a, b))]) for a, b in pairs])
    cells = [
        F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            (F.lit(1.0) if a == b else F.col(names[frozenset((a, b))])).alias("correlation"),
        )
        for a in columns
        for b in columns
    ]
    return one_row.select(F.inline(F.array(*cells)))
