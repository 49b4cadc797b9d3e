"""The tables behind charts, aggregated over all rows instead of a sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from .quantiles import quantiles_by_group


def _range(df: DataFrame, value: str):
    x = F.col(value).cast("double")
    usable = x.isNotNull() & ~F.isnan(x)
    return F.min(F.when(usable, x)), F.max(F.when(usable, x))


def _widened(low: float, high: float) -> tuple[float, float]:
    return (low, high) if low < high else (low - 0.5, high + 0.5)


def _bin(value: str, low: float, high: float, bins: int):
    place = F.floor((F.col(value) - F.lit(low)) / F.lit(high - low) * bins)
    return F.least(place, F.lit(bins - 1)).cast("int")


def _edges(low: float, high: float, bins: int):
    step = F.lit((high - low) / bins)
    return [
        (F.lit(low) + F.col("bin") * step).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * step).alias("bin_high"),
    ]


def _all_bins(df: DataFrame, bins: int) -> DataFrame:
    return df.sparkSession.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))


def histogram(df: DataFrame, value: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins over the value range, empty bins included.

    Bins are closed on the left, the last one on both sides.
    """
    low, high = df.agg(*_range(df, value)).first()
    if low is None:
        return _all_bins(df, bins).select("bin", *_edges(0.0, 1.0, bins), F.lit(0).cast("bigint").alias("n"))
    low, high = _widened(low, high)
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(_bin(value, low, high, bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return (
        _all_bins(df, bins)
        .join(counts, "bin", "left")
        .select("bin", *_edges(low, high, bins), F.coalesce("n", F.lit(0)).alias("n"))
    )


def grouped_histogram(
    df: DataFrame, value: str, group: str, group_values: Sequence, bins: int = fixed.HISTOGRAM_BINS
) -> DataFrame:
    """One histogram per listed group value, each over that group's own range."""
    chosen = df.where(F.col(group).isin(*group_values) & F.col(value).isNotNull())
    low, high = _range(chosen, value)
    ranges = {
        r[0]: _widened(r["low"], r["high"])
        for r in chosen.groupBy(group).agg(low.alias("low"), high.alias("high")).collect()
        if r["low"] is not None
    }
    if not ranges:
        return _all_bins(df, 0).select(F.lit("").alias(group), "bin", *_edges(0.0, 1.0, bins), F.lit(0).alias("n"))
    place = edge_low = edge_high = None
    for name, (low, high) in ranges.items():
        here = F.col(group) == F.lit(name)
        parts = (_bin(value, low, high, bins), F.lit(low), F.lit((high - low) / bins))
        if place is None:
            place, edge_low, edge_high = (F.when(here, p) for p in parts)
        else:
            place, edge_low, edge_high = (
                c.when(here, p) for c, p in zip((place, edge_low, edge_high), parts)
            )
    counts = (
        chosen.where(~F.isnan(F.col(value).cast("double")))
        .groupBy(group, place.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    names = df.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.array(*[F.lit(n) for n in ranges])).alias(group),
    )
    every = names.select(group, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counts, [group, "bin"], "left").select(
        group,
        "bin",
        (edge_low + F.col("bin") * edge_high).alias("bin_low"),
        (edge_low + (F.col("bin") + 1) * edge_high).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Row count, range, quartiles and mean per group; quartiles are interpolated."""
    found = quantiles_by_group(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, interpolate=True)
    return found.select(by, "n", "min_value", "q1", "median", "q3", "max_value", "mean")


def top_n(df: DataFrame, measure: str, key: str, n: int = fixed.TOP_ROWS) -> DataFrame:
    """The ``n`` largest rows by a measure, ties by key, with their rank.

    The sort and limit are one operator that keeps ``n`` rows per task.
    """
    best = df.select(key, measure).orderBy(F.desc(measure), key).limit(n)
    ranked = Window.partitionBy(F.lit(1)).orderBy(F.desc(measure), key)
    return best.withColumn("rank", F.row_number().over(ranked))
