"""Event-time telemetry over a stream or a table of scored requests.

The same functions serve both.  Rows are combined once into panes as long as the
slide; sliding ranges are then rolled up from panes, so a row is not repeated for
every range it belongs to.  On a stream both steps are chained aggregations
under one watermark, in append mode: a range is emitted once it is closed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..session import durable


def with_watermark(df: DataFrame, delay: str, ts="ts") -> DataFrame:
    """Timestamp with time zone and a watermark; local timestamps carry none."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def panes(
    df: DataFrame, seconds: int, measures: Mapping[str, Column], keys: Sequence[str] = (), ts="ts"
) -> DataFrame:
    """Additive measures per non-overlapping interval and key, column ``pane``."""
    return df.groupBy(F.window(ts, f"{seconds} seconds").alias("pane"), *keys).agg(
        *[e.alias(n) for n, e in measures.items()]
    )


def roll_up(
    paned: DataFrame, length: int, slide: int, measures: Sequence[str] | Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Sum panes into ranges of ``length`` seconds that start every ``slide`` seconds."""
    if length % slide:
        raise ValueError("the length of a range must be a multiple of its slide")
    sums = measures if isinstance(measures, Mapping) else {m: F.sum(m) for m in measures}
    return (
        paned.groupBy(
            F.window(F.window_time("pane"), f"{length} seconds", f"{slide} seconds").alias("range"), *keys
        )
        .agg(*[e.alias(n) for n, e in sums.items()])
        .select(
            F.col("range.start").alias("window_start"),
            F.col("range.end").alias("window_end"),
            *keys,
            *sums,
        )
    )


def windowed(
    df: DataFrame,
    length: int,
    slide: int | None,
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
    ts="ts",
) -> DataFrame:
    """Additive measures per range; without a slide the ranges do not overlap."""
    step = slide or length
    paned = panes(df, step, measures, keys, ts)
    if step == length:
        return paned.select(
            F.col("pane.start").alias("window_start"), F.col("pane.end").alias("window_end"), *keys, *measures
        )
    return roll_up(paned, length, step, list(measures), keys)


def request_rate(df: DataFrame, length=300, slide=60, keys: Sequence[str] = (), ts="ts") -> DataFrame:
    """Requests per second; ``keys`` (the status, say) splits the rate."""
    counted = windowed(df, length, slide, {"n": F.count("*")}, keys, ts)
    return counted.withColumn("per_second", F.col("n") / F.lit(length))


def rate_by_status(df: DataFrame, length=300, slide=60, status="status", ts="ts") -> DataFrame:
    return request_rate(df, length, slide, [status], ts)


def error_rate(df: DataFrame, length=300, slide=60, status="status", error="error", ts="ts") -> DataFrame:
    """Share of failed requests in percent."""
    counted = windowed(
        df, length, slide, {"n": F.count("*"), "errors": F.count_if(F.col(status) == error)}, (), ts
    )
    return counted.withColumn(
        "error_pct", 100.0 * F.col("errors") / F.greatest(F.col("n").cast("double"), F.lit(fixed.RATIO_FLOOR))
    )


def windowed_mean(df: DataFrame, value: str, length=900, slide=60, ts="ts") -> DataFrame:
    """Sum over count of a value."""
    counted = windowed(df, length, slide, {"total": F.sum(value), "n": F.count(value)}, (), ts)
    return counted.withColumn(
        "mean_value", F.col("total") / F.greatest(F.col("n").cast("double"), F.lit(fixed.RATIO_FLOOR))
    )


def daily_total(df: DataFrame, ts="ts") -> DataFrame:
    return windowed(df, 86_400, None, {"n": F.count("*")}, (), ts)


def _bound_name(bound: float) -> str:
    return "+Inf" if math.isinf(bound) else str(float(bound))


def _under_counts(value: str, bounds: Sequence[float], weight: Column | None = None) -> dict[str, Column]:
    """Cumulative counts at or under each bound, the last one counting all."""
    x = F.col(value)
    tests = [(x <= b) for b in bounds] + [x.isNotNull()]
    if weight is None:
        return {f"le{i}": F.count_if(t) for i, t in enumerate(tests)}
    return {f"le{i}": F.sum(F.when(t, weight).otherwise(0)) for i, t in enumerate(tests)}


def _bucket_rows(counted: DataFrame, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    cells = F.array(
        *[
            F.struct(F.lit(_bound_name(b)).alias("le"), F.col(f"le{i}").alias("n"))
            for i, b in enumerate([*bounds, math.inf])
        ]
    )
    return counted.select("window_start", "window_end", *keys, F.inline(cells))


def score_buckets(
    df: DataFrame, value="score", bounds: Sequence[float] = fixed.SCORE_BOUNDS, length=900, slide=60, ts="ts"
) -> DataFrame:
    """Cumulative counts per upper bound, one row per range and bound."""
    counted = windowed(df, length, slide, _under_counts(value, bounds), (), ts)
    return _bucket_rows(counted, bounds)


def bucket_quantile(
    df: DataFrame, value: str, bounds: Sequence[float], levels: Mapping[str, float], length=300, slide=60, ts="ts"
) -> DataFrame:
    """Quantiles read from cumulative buckets, linear inside a bucket.

    The first bucket starts at 0 when its bound is positive.  A rank in the
    unbounded bucket gives the last finite bound.
    """
    counted = windowed(df, length, slide, _under_counts(value, bounds), (), ts)
    total = F.col(f"le{len(bounds)}")

    def at(level: float) -> Column:
        rank = F.lit(level) * total
        chain = None
        for i, upper in enumerate(bounds):
            lower = bounds[i - 1] if i else min(0.0, upper)
            under = F.col(f"le{i - 1}") if i else F.lit(0)
            inside = F.lit(lower) + F.lit(upper - lower) * F.try_divide(rank - under, F.col(f"le{i}") - under)
            reached = F.col(f"le{i}") >= rank
            chain = F.when(reached, inside) if chain is None else chain.when(reached, inside)
        return F.when(total > 0, chain.otherwise(F.lit(float(bounds[-1]))))

    return counted.select(
        "window_start", "window_end", total.alias("n"), *[at(q).alias(name) for name, q in levels.items()]
    )


#: Cells of the logarithmic scale per power of e, how often a cell can be split, and into how many.
_CELLS, _SPLITS, _FINER = 64, 4, 256


def _cell(value: Column, depth: int) -> Column:
    """Cell of a value at a depth.  Cells follow the order of values; each holds whole cells of the next depth."""
    size = F.ln(F.abs(value)) + F.lit(800.0)  # above 0 for the smallest double
    place = F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0.0))
    return F.floor(place * F.lit(float(_CELLS * _FINER**depth)))


def range_quantile(
    df: DataFrame,
    value: str,
    levels: Mapping[str, float],
    length=300,
    slide=60,
    ts="ts",
    max_values: int = 100_000,
) -> DataFrame:
    """Exact quantiles of a value per sliding range, one column per named level.

    The smallest value whose share of the range's rows reaches the level.  Rows are
    counted per pane and cell of a logarithmic scale, and panes are rolled up to
    ranges, so that only counts are shuffled.  They tell the cell in which each
    rank falls; only rows of such cells are looked at again, in finer cells while
    one holds more than ``max_values`` rows of a range, then by value.

    Rows without a time or a value (null, NaN) take no part; a range of such rows
    only is left out.  An infinite value has the outermost cell.
    """
    x = F.col(value).cast("double")
    pane = F.window(F.col(ts).cast("timestamp"), f"{slide} seconds")
    rows = durable(df.where(x.isNotNull() & ~F.isnan(x)).select(pane.alias("pane"), x.alias("x")).where("pane is not null"))
    counted = rows.groupBy("pane", _cell(F.col("x"), 0).alias("part")).agg(F.count("*").alias("c"))
    ranged = roll_up(counted, length, slide, ["c"], ["part"])

    whole = Window.partitionBy("window_start")
    wanted_levels = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(str(q)).cast("decimal(10,8)").alias("level")) for n, q in levels.items()]
    )
    total = F.sum("c").over(whole)
    asked = (
        ranged.withColumn("n", total)
        .select("*", F.explode(wanted_levels).alias("l"))
        .select("*", F.col("l.name").alias("name"), F.greatest(F.ceil(F.col("n") * F.col("l.level")), F.lit(1)).alias("rank"))
    )
    wanted = durable(_holding(asked, "part"))

    for depth in range(_SPLITS + 1):
        most = wanted.agg(F.max("c")).first()[0] or 0
        last = depth == _SPLITS or most <= max_values
        part = F.col("x") if last else _cell(F.col("x"), depth + 1)
        panes_of = wanted.select(
            F.explode(
                F.sequence("window_start", F.col("window_end") - F.expr(f"INTERVAL {slide} SECONDS"), F.expr(f"INTERVAL {slide} SECONDS"))
            ).alias("at"),
            F.col("part").alias("cell"),
            "window_start",
            "window_end",
            "name",
            "n",
            "rank",
        )
        inside = rows.select(F.col("pane.start").alias("at"), _cell(F.col("x"), depth).alias("cell"), part.alias("part"))
        again = (
            inside.join(panes_of.select("at", "cell").distinct(), ["at", "cell"], "left_semi")
            .groupBy("at", "cell", "part")
            .agg(F.count("*").alias("c"))
        )
        met = again.join(panes_of, ["at", "cell"]).groupBy("window_start", "window_end", "name", "n", "rank", "part").agg(F.sum("c").alias("c"))
        wanted = _holding(met, "part")
        if last:
            break
        wanted = durable(wanted)
    picked = [F.max(F.when(F.col("name") == n, F.col("part"))).alias(n) for n in levels]
    return wanted.groupBy("window_start", "window_end", "n").agg(*picked)


def _holding(counts: DataFrame, part: str) -> DataFrame:
    """Of each range and level the part in which the rank falls, and the rank inside it."""
    upto = F.sum("c").over(
        Window.partitionBy("window_start", "name").orderBy(part).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counts.withColumn("upto", upto)
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
        .select("window_start", "window_end", "name", "n", part, "c", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"))
    )


def source_freshness(df: DataFrame, as_of: str, stale_after: int, ts="ts") -> DataFrame:
    """Seconds between the newest event and a given time, and whether that is too long."""
    newest = F.max(F.col(ts).cast("timestamp"))
    return df.agg(newest.alias("last_event")).withColumn(
        "lag_seconds",
        (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("last_event")) / F.lit(1_000_000),
    ).withColumn("is_stale", F.coalesce(F.col("lag_seconds") > F.lit(stale_after), F.lit(True)))


def request_counts(df: DataFrame, slide: int, key: str, ts="ts") -> DataFrame:
    """Requests per pane and customer.

    Customer attributes are joined to these counts, not to the requests, so a
    customer with most of the requests is one row per pane.
    """
    return panes(df, slide, {"requests": F.count("*")}, [key], ts)


def _profiled(df: DataFrame, profiles: DataFrame, key: str, slide: int, ts: str) -> DataFrame:
    """Requests with their customer's attributes; a request of an unknown customer has none."""
    return request_counts(df, slide, key, ts).join(profiles, key, "left")


def feature_buckets(
    df: DataFrame, profiles: DataFrame, key: str, feature: str, bounds: Sequence[float], length=60, slide=60, ts="ts"
) -> DataFrame:
    """Rate per second of requests at or under each bound of a customer feature."""
    joined = _profiled(df, profiles.select(key, feature), key, slide, ts)
    counted = roll_up(joined, length, slide, _under_counts(feature, bounds, F.col("requests")))
    return _bucket_rows(counted, bounds).withColumn("per_second", F.col("n") / F.lit(length))


def feature_sum_rate(
    df: DataFrame, profiles: DataFrame, key: str, features: Sequence[str], length=60, slide=60, ts="ts"
) -> DataFrame:
    """Sum per second of customer features over the requests of a range."""
    joined = _profiled(df, profiles.select(key, *features), key, slide, ts)
    return roll_up(
        joined,
        length,
        slide,
        {c: F.sum(F.col("requests") * F.col(c)) / F.lit(length) for c in features},
    )


def gender_mix(df: DataFrame, profiles: DataFrame, key: str, gender="gender", length=3600, ts="ts") -> DataFrame:
    """Requests by gender per hour; unknown, also of an unknown customer, is a label of its own."""
    joined = _profiled(df, profiles.select(key, gender), key, length, ts).withColumn(
        gender, F.coalesce(gender, F.lit(fixed.GENDER_UNKNOWN))
    )
    return roll_up(joined, length, length, {"n": F.sum("requests")}, [gender])


def batch_means(df: DataFrame, profiles: DataFrame, key: str, feature: str, length=3600, ts="ts") -> DataFrame:
    """Mean of a customer feature over the requests of each interval."""
    joined = _profiled(df, profiles.select(key, feature), key, length, ts).where(F.col(feature).isNotNull())
    return roll_up(
        joined, length, length,
        {"mean_value": F.sum(F.col("requests") * F.col(feature)) / F.sum("requests")},
    )


def latest_batch_mean(df: DataFrame, profiles: DataFrame, key: str, feature: str, length=3600, ts="ts") -> DataFrame:
    """The newest interval's mean: the last value wins."""
    return batch_means(df, profiles, key, feature, length, ts).agg(
        F.max("window_start").alias("window_start"),
        F.max_by("mean_value", "window_start").alias("mean_value"),
    )
