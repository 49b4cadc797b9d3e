"""Quantile sketches that are kept as bytes, say one a day, and merged when they are read.

``exact_quantiles`` reads the rows again for every question.  A sketch is a few
kilobytes however many rows it stands for; sketches of days, tables or sources
merge to that of all their rows, with the same bound on the error of a rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch size.  The error of a rank falls about as fast as this grows.
SIZE = 1024


def rank_bound(size: int = SIZE) -> float:
    """Promised error of a rank, as a share of the rows: twice what 99 of 100 sketches keep to."""
    return 2 * 2.296 / size**0.9723


def sketch_table(df: DataFrame, columns: Sequence[str], by: Sequence[Column], size: int = SIZE) -> DataFrame:
    """A sketch per column and group of rows, as bytes, with ``by`` before them.

    Sketches are built on the map side and merged, so a group may hold any share
    of the rows.  Null and NaN are not counted; a column without values has none.
    """
    def known(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    sketches = [F.call_function("kll_sketch_agg_double", known(c), F.lit(size)).alias(c) for c in columns]
    held = [F.when(F.count(known(c)) > 0, s).alias(c) for c, s in zip(columns, sketches, strict=True)]
    return df.groupBy(*by).agg(*held)


def sketched_quantiles(sketches: DataFrame, levels: Mapping[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """Merge sketches and read ``column_name, level, value, n`` per level, and per group of ``by``."""
    held = [F.count(F.col(c)).alias(f"held_{i}") for i, c in enumerate(levels)]
    merged = sketches.groupBy(*by).agg(*[F.call_function("kll_merge_agg_double", F.col(c)).alias(c) for c in levels], *held)
    parts = []
    for i, (c, ps) in enumerate(levels.items()):
        values = F.call_function("kll_sketch_get_quantile_double", F.col(c), F.array(*[F.lit(float(p)) for p in ps]))
        parts.append(
            merged.where(F.col(f"held_{i}") > 0)  # an empty sketch has no quantiles
            .select(*by, F.call_function("kll_sketch_get_n_double", F.col(c)).alias("n"), F.posexplode(values).alias("place", "value"))
            .select(*by, F.lit(c).alias("column_name"), F.element_at(F.array(*[F.lit(float(p)) for p in ps]), F.col("place") + 1).alias("level"), "value", "n")
        )
    return reduce(DataFrame.unionByName, parts)


def rank_errors(df: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``quantiles`` with the exact error of their ranks in ``df``, as a share of the rows.

    A value answers every level between the shares of rows below it and up to it.
    The few values are read once; the rows are counted in one pass.
    """
    asked = quantiles.collect()  # a row per column and level
    counts = []
    for i, q in enumerate(asked):
        x = F.col(q["column_name"]).cast("double")
        known = x.isNotNull() & ~F.isnan(x)
        n, value = F.count_if(known), F.lit(q["value"])
        below, upto = F.try_divide(F.count_if(known & (x < value)), n), F.try_divide(F.count_if(known & (x <= value)), n)
        level = F.lit(q["level"])
        counts.append(
            F.struct(
                F.lit(q["column_name"]).alias("column_name"), level.alias("level"), value.alias("value"), n.alias("n"),
                F.greatest(below - level, level - upto, F.lit(0.0)).alias("rank_error"),
            )
        )
    if not counts:
        return quantiles.withColumn("rank_error", F.lit(None).cast("double"))
    return df.agg(F.array(*counts).alias("found")).select(F.inline("found"))
