"""Running sums along a numeric value, without an unpartitioned window over rows.

Rows are first combined per distinct value, so repeated values cost one row.
The value axis is cut into buckets of bounded size by a deterministic function
of the value; bucket totals are cumulated and added to the
running sums computed inside each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .quantiles import Span, column_facts, count_cells

ROWS_PER_BUCKET = 1_000_000
#: Spans that one pass cuts; only the length of its expression depends on it.
_SPANS_AT_ONCE = 32


def split_points(data: DataFrame, name: str, facts, target_rows: int) -> list[float]:
    """Values that cut the column into pieces of about ``target_rows`` rows.

    Spans are cut until each holds at most that many rows or a single value, so a
    piece is never larger, except for one value's rows.  Only balance depends on
    the cuts, never a result.
    """
    pieces = math.ceil(facts["rows"] / target_rows)
    if pieces < 2 or facts["low"] == facts["high"]:
        return []
    target = facts["rows"] / pieces
    waiting, cells = [Span(0, facts["low"], facts["high"], 0, facts["rows"])], []
    while waiting:
        now, waiting = waiting[:_SPANS_AT_ONCE], waiting[_SPANS_AT_ONCE:]
        for found in count_cells(data, [name], now, 4 * pieces).values():
            for span in found:
                (waiting if span.rows > target and span.low < span.high else cells).append(span)
    cuts, held = [], 0
    for cell in sorted(cells, key=lambda s: s.low):
        if held and held + cell.rows > target:
            cuts.append(cell.low)
            held = 0
        held += cell.rows
    return cuts


def running_sums(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, dict[str, float]]:
    """Per distinct value: the sums and their running totals.

    Returns a frame with ``by``, ``value``, each sum, ``upto_<sum>`` (including
    the row's own) and ``all_<sum>`` (the total of the ``by`` group), and the
    grand totals as numbers.  Rows whose value is null or NaN are left out.
    Each entry of ``sums`` must be a row-level expression.
    """
    by = list(by)
    names = list(sums)
    x = F.col(value).cast("double")
    data = df.select(*by, x.alias(value), *[e.alias(n) for n, e in sums.items()]).where(
        F.col(value).isNotNull() & ~F.isnan(value)
    )
    # a narrow table, written once: the source may be a join or a model's scores
    per_value = durable(data.groupBy(*by, value).agg(*[F.sum(n).alias(n) for n in names]))
    facts = column_facts(per_value, [value], {n: F.sum(n) for n in names})
    cuts = split_points(per_value, value, facts[value], rows_per_bucket)

    if cuts:
        bucketizer = Bucketizer(
            splits=[-math.inf, *cuts, math.inf], inputCol=value, outputCol="_bucket"
        )
        placed = bucketizer.transform(per_value)
    else:
        placed = per_value.withColumn("_bucket", F.lit(0.0))

    inside = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.select("*", *[F.sum(n).over(inside).alias(f"upto_{n}") for n in names])

    if not cuts:
        # one bucket: at most ``rows_per_bucket`` distinct values (of every group)
        group = Window.partitionBy(*(by or ["_bucket"]))
        frame = within.withColumns({f"all_{n}": F.sum(n).over(group) for n in names})
        return frame.drop("_bucket"), {n: facts[f"_{n}"] or 0 for n in names}

    # at most buckets x groups rows: bucket totals, cumulated
    ahead = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    offsets = (
        placed.groupBy(*by, "_bucket")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(
            *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
            F.col("_bucket").alias("_at"),
            *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"_ahead_{n}") for n in names],
            *[F.sum(n).over(group).alias(f"all_{n}") for n in names],
        )
    )
    on = F.col("_bucket") == F.col("_at")
    for i, b in enumerate(by):
        on = on & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    # a row per bucket and group: the optimizer decides from the measured size
    joined = within.join(offsets, on)
    frame = joined.select(
        *by,
        value,
        *names,
        *[(F.col(f"upto_{n}") + F.col(f"_ahead_{n}")).alias(f"upto_{n}") for n in names],
        *[f"all_{n}" for n in names],
    )
    return frame, {n: facts[f"_{n}"] or 0 for n in names}


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    levels: Mapping[str, float],
    interpolate: bool = False,
    extra: Mapping[str, Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact quantiles per group, one column per named level.

    With ``interpolate`` the two neighbouring order statistics are mixed
    linearly; otherwise the smallest value whose share reaches the level is
    taken.  ``extra`` aggregates are taken over the group's distinct values, each
    with its row count ``n``.
    """
    frame, _ = running_sums(df, value, {"n": F.lit(1)}, by, rows_per_bucket)
    n, upto, x = F.col("all_n"), F.col("upto_n"), F.col(value)

    def at(rank: Column) -> Column:
        return F.max(F.when((upto >= rank) & (upto - F.col("n") < rank), x))

    picks, finish = [], []
    for name, level in levels.items():
        exact = F.lit(str(level)).cast("decimal(10,8)")
        if interpolate:
            position = (n - 1) * exact
            picks += [
                at(F.floor(position) + 1).alias(f"_{name}_low"),
                at(F.ceil(position) + 1).alias(f"_{name}_high"),
                F.max(position - F.floor(position)).cast("double").alias(f"_{name}_part"),
            ]
            low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
            finish.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
        else:
            picks.append(at(F.greatest(F.ceil(n * exact), F.lit(1))).alias(name))
            finish.append(F.col(name))
    more = extra or {}
    return (
        frame.groupBy(*by)
        .agg(*picks, *[e.alias(name) for name, e in more.items()])
        .select(*by, *finish, *more)
    )
