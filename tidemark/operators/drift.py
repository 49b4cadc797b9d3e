"""Distribution comparisons: Kolmogorov-Smirnov, chi-square and population stability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import pvalues
from ..session import durable_with, literal_frame
from .prefix import ROWS_PER_BUCKET, running_sums
from .quality import crosstab_long
from .quantiles import exact_quantiles


def ks_two_sample(
    df: DataFrame, value: str, group: str, a, b, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Largest distance between the value distributions of two groups, on all rows.

    One row with the statistic and the group sizes; the statistic is null when a
    group is empty.
    """
    frame, totals = running_sums(
        df.where(F.col(group).isin(a, b)),
        value,
        {
            "a": F.when(F.col(group) == a, 1).otherwise(0),
            "b": F.when(F.col(group) == b, 1).otherwise(0),
        },
        rows_per_bucket=rows_per_bucket,
    )
    n_a, n_b = int(totals["a"]), int(totals["b"])
    gap = (
        F.abs(F.col("upto_a") / F.lit(n_a) - F.col("upto_b") / F.lit(n_b))
        if n_a and n_b
        else F.lit(None).cast("double")
    )
    return frame.agg(
        F.max(gap).alias("ks_statistic"),
        F.lit(n_a).cast("bigint").alias("n_a"),
        F.lit(n_b).cast("bigint").alias("n_b"),
    )


def ks_test(df: DataFrame, value: str, group: str, a, b, method: str = "asymptotic", **options) -> DataFrame:
    """KS statistic with its p-value and the verdict at the usual level.

    ``method`` is ``asymptotic`` (the limiting distribution) or ``exact`` (time
    grows with the product of the sample sizes); ``p_method`` repeats it.
    """
    r = ks_two_sample(df, value, group, a, b, **options).first()
    columns = {
        "test": "string", "value_column": "string", "group_column": "string", "group_a": "string",
        "group_b": "string", "n_a": "bigint", "n_b": "bigint", "ks_statistic": "double",
        "p_value": "double", "significant": "boolean", "error": "string", "p_method": "string",
    }
    named = ("two_sample_ks", value, group, str(a), str(b), r["n_a"], r["n_b"])
    if r["ks_statistic"] is None:
        row = (*named, None, None, None, "one or both groups have no values", method)
    else:
        p = pvalues.ks_two_sample(r["ks_statistic"], r["n_a"], r["n_b"], method)
        row = (*named, r["ks_statistic"], p, p < fixed.SIGNIFICANCE, None, method)
    return literal_frame(df.sparkSession, columns, [row])


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square statistic of independence and its degrees of freedom.

    A 2 x 2 table gets the continuity correction.  With observed and expected
    counts O and E the plain statistic is the sum of (O - E)^2 / E over the grid;
    a cell that does not occur adds its E, which follows from the exact totals of
    the columns that its row lacks.  The cells are counted once; their total is
    observed while they are written.
    """
    cells, seen = durable_with(crosstab_long(df, a, b), total=F.sum("n"))
    total = F.lit(seen["total"]).cast("bigint")
    of_row, of_column = Window.partitionBy(a), Window.partitionBy(b)
    sided = cells.withColumns({"c": F.sum("n").over(of_column), "first": F.row_number().over(of_column.orderBy(a)) == 1})
    expected = F.col("r") / total * F.col("c")
    placed = sided.withColumn("r", F.sum("n").over(of_row))
    per_row = placed.groupBy(a).agg(
        F.sum("n").alias("n"),
        F.first("r").alias("r"),
        F.sum(F.pow(F.col("n") - expected, 2) / expected).alias("found"),
        F.max(F.abs(F.col("n") - expected)).alias("distance"),
        (total - F.sum("c")).alias("lacking"),
        F.min("c").alias("c"),
        F.count_if("first").alias("columns"),
    )
    totals = per_row.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("found") + F.col("r") / total * F.col("lacking")).alias("plain"),
        F.max("distance").alias("distance"),
        (F.count("*") - 1).alias("da"),
        (F.sum("columns") - 1).alias("db"),
        F.min("r").cast("double").alias("r"),
        F.min("c").cast("double").alias("c"),
    )
    n, r, c = F.col("n"), F.col("r"), F.col("c")
    margins = r * (n - r) / n * c * (n - c) / n
    corrected = F.try_divide(n * F.pow(F.greatest(F.col("distance") - 0.5, F.lit(0.0)), 2), margins)
    return totals.select(
        F.when((F.col("da") == 1) & (F.col("db") == 1), corrected).otherwise(F.col("plain")).alias("chi2_statistic"),
        (F.col("da") * F.col("db")).cast("bigint").alias("degrees_of_freedom"),
        F.col("n").cast("bigint").alias("n_rows"),
    )


def chi_square_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square statistic with its p-value and the verdict at the usual level."""
    r = chi_square(df, a, b).first()
    columns = {
        "test": "string", "column_a": "string", "column_b": "string", "chi2_statistic": "double",
        "degrees_of_freedom": "bigint", "p_value": "double", "significant": "boolean",
    }
    statistic = r["chi2_statistic"]
    p = None if statistic is None else pvalues.chi_square(statistic, r["degrees_of_freedom"])
    row = (
        "chi_square_independence", a, b, statistic, r["degrees_of_freedom"], p,
        None if p is None else p < fixed.SIGNIFICANCE,
    )
    return literal_frame(df.sparkSession, columns, [row])


def baseline_edges(baseline: DataFrame, column: str, bins: int = fixed.PSI_BINS) -> list[float]:
    """Distinct quantiles of the baseline; the outer two are replaced by infinity."""
    levels = [i / bins for i in range(bins + 1)]
    found = exact_quantiles(baseline, {column: levels})[column]
    return sorted({v for v in found if v is not None})


def bin_number(column: str, edges: Sequence[float], legacy: bool = False) -> Column:
    """Bin of a value between baseline edges; ``-1`` for null and NaN.

    ``legacy`` counts null and NaN in the last bin.
    """
    x = F.col(column)
    chain = F.when(x.isNull() | F.isnan(x.cast("double")), F.lit(len(edges) - 2 if legacy else -1))
    for i, upper in enumerate(edges[1:-1]):
        chain = chain.when(x < F.lit(upper), F.lit(i))
    return chain.otherwise(F.lit(len(edges) - 2))


def _stability(psi: Column) -> Column:
    return (
        F.when(psi < fixed.PSI_STABLE_BELOW, "stable")
        .when(psi <= fixed.PSI_MODERATE_TO, "moderate_shift")
        .otherwise("significant_shift")
    )


def _bin_term(base_rows: Column, base_all: Column, rows: Column, all_rows: Column) -> Column:
    def share(part: Column, whole: Column) -> Column:
        return F.when(part > 0, part / whole).otherwise(F.lit(fixed.PSI_EMPTY_SHARE))

    b, c = share(base_rows, base_all), share(rows, all_rows)
    return (c - b) * F.ln(c / b)


def _bin_list(edges: Sequence[float]) -> Column:
    return F.array(*[F.lit(i) for i in range(len(edges) - 1)])


def psi(
    baseline: DataFrame,
    current: DataFrame,
    column: str,
    bins: int = fixed.PSI_BINS,
    legacy: bool = False,
) -> DataFrame:
    """Population stability index of one column, as one row.

    Bins that are empty on one side get a small share.  The null bin takes part
    only if a side has nulls.  Fewer than two distinct edges give an error row;
    exactly two give one bin, an index of 0, and ``is_degenerate``.
    """
    spark = baseline.sparkSession
    edges = baseline_edges(baseline, column, bins)
    columns = {
        "column_name": "string", "psi": "double", "stability": "string", "num_bins": "int",
        "is_degenerate": "boolean", "error": "string",
    }
    if len(edges) < 2:
        return literal_frame(spark, columns, [(column, None, None, 0, True, "not enough distinct values to bin")])

    def counted(df: DataFrame, side: int) -> DataFrame:
        return df.select(bin_number(column, edges, legacy).alias("bin"), F.lit(side).alias("side"))

    both = counted(baseline, 0).unionByName(counted(current, 1))
    per_bin = both.groupBy("bin").agg(
        F.count_if(F.col("side") == 0).alias("b"), F.count_if(F.col("side") == 1).alias("c")
    )
    whole = Window.partitionBy(F.lit(1))
    # one row per bin that occurs: at most bins + 1 rows; bins empty on both
    # sides contribute nothing because both shares are the same
    terms = per_bin.withColumn(
        "term",
        _bin_term(
            F.col("b"),
            F.greatest(F.sum("b").over(whole), F.lit(1)),
            F.col("c"),
            F.greatest(F.sum("c").over(whole), F.lit(1)),
        ),
    )
    return terms.agg(F.coalesce(F.sum("term"), F.lit(0.0)).alias("psi")).select(
        F.lit(column).alias("column_name"),
        "psi",
        _stability(F.col("psi")).alias("stability"),
        F.lit(len(edges) - 1).alias("num_bins"),
        F.lit(len(edges) == 2).alias("is_degenerate"),
        F.lit(None).cast("string").alias("error"),
    )


def baseline_counts(baseline: DataFrame, column: str, bins: int = fixed.PSI_BINS) -> tuple[list[float], dict[int, int]]:
    """Bin edges of a baseline and its rows per bin: all that later comparisons need."""
    edges = baseline_edges(baseline, column, bins)
    if len(edges) < 2:
        raise ValueError(f"baseline column {column} has too few distinct values")
    rows = baseline.select(bin_number(column, edges).alias("bin")).where("bin >= 0").groupBy("bin").agg(F.count("*").alias("n"))
    return edges, {r["bin"]: r["n"] for r in rows.collect()}


def psi_against(
    baseline: DataFrame,
    current: DataFrame,
    column: str,
    keys: Sequence[Column],
    bins: int = fixed.PSI_BINS,
) -> DataFrame:
    """Stability index of every group of ``current`` (a time window, a batch) to one baseline.

    The baseline is reduced to its shares once; each group needs one aggregate.
    Values that are null or NaN are left out on both sides.
    """
    return psi_with(*baseline_counts(baseline, column, bins), current, column, keys)


def psi_with(
    edges: Sequence[float], counts: Mapping[int, int], current: DataFrame, column: str, keys: Sequence[Column]
) -> DataFrame:
    """:func:`psi_against` a baseline that has been reduced by :func:`baseline_counts`."""
    total = sum(counts.values())
    names = [f"_n{i}" for i in range(len(edges) - 1)]
    binned = current.select(*keys, bin_number(column, edges).alias("_bin")).where("_bin >= 0")
    key_names = [c for c in binned.columns if c != "_bin"]
    grouped = binned.groupBy(*key_names).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col("_bin") == i).alias(n) for i, n in enumerate(names)],
    )
    index = F.lit(0.0)
    for i, n in enumerate(names):
        index = index + _bin_term(F.lit(counts.get(i, 0)), F.lit(total), F.col(n), F.col("n_rows"))
    return grouped.select(*key_names, "n_rows", index.alias("psi")).withColumn(
        "stability", _stability(F.col("psi"))
    )
