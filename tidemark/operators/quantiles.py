"""Quantiles of numeric columns.

``exact_quantiles`` never sorts or shuffles the column.  A first pass counts rows
in cells of equal width on a signed logarithmic scale, which needs no knowledge
of the range: a map-side combined aggregate whose result is a few thousand rows.
Later passes look only inside the cells that hold the wanted ranks and cut them
evenly.  Cells remember the smallest and largest value they hold, so a hot value
is a finished cell however many rows repeat it.  Once the cells of interest hold
few enough rows, their values are counted one by one.  Nulls and NaN are skipped.
The result is the smallest value whose cumulative share reaches the level, as
``percentile_disc`` defines it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, literal_frame

CELLS = 4096
#: Most cell counts one pass may return.
CELL_ROWS = 250_000
#: Cells per doubling of the magnitude in the first pass.
CELLS_PER_OCTAVE = 128
#: Rows in the cells of interest below which their values are counted singly.
FEW_ROWS = 20_000


@dataclass(frozen=True)
class Span:
    """Rows of one column between two of its values; ``below`` rows lie under it."""

    column: int
    low: float
    high: float
    below: int
    rows: int


def _is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))


def column_facts(data: DataFrame, names: Sequence[str], extra: Mapping[str, Column] | None = None):
    """One pass: per column the counts of -inf, finite and +inf values, and the finite range."""
    aggs = []
    for name in names:
        x = F.col(name)
        aggs.append(
            F.struct(
                F.count_if(x == F.lit(-math.inf)).alias("low_end"),
                F.count_if(_is_finite(x)).alias("rows"),
                F.count_if((x == F.lit(math.inf)) & ~F.isnan(x)).alias("high_end"),
                F.min(F.when(_is_finite(x), x)).alias("low"),
                F.max(F.when(_is_finite(x), x)).alias("high"),
            ).alias(name)
        )
    aggs += [e.alias(f"_{n}") for n, e in (extra or {}).items()]
    return data.agg(*aggs).first()


def _even_cell(x: Column, low: Column, high: Column, cells: int) -> Column:
    # halves keep the differences finite for any pair of doubles
    width = F.greatest(high / 2 - low / 2, F.lit(5e-324))
    place = F.floor((x / 2 - low / 2) / width * cells)
    # the largest value has a cell of its own, so every pass gets further
    return F.when(x >= high, F.lit(cells)).otherwise(F.least(place, F.lit(cells - 1))).cast("int")


def _cell(x: Column, span: Span, cells: int) -> Column:
    return _even_cell(x, F.lit(span.low), F.lit(span.high), cells)


def _log_cell(x: Column) -> Column:
    """Cell on a signed logarithmic scale; never decreases as ``x`` grows."""
    size = F.least(F.log2(F.abs(x) + 1), F.lit(1025.0))
    return F.floor(F.signum(x) * size * CELLS_PER_OCTAVE).cast("int")


def _stacked(data: DataFrame, tags: Sequence[Column]) -> DataFrame:
    """One row per non-null tag."""
    one = tags[0] if len(tags) == 1 else F.explode(F.array(*tags))
    return data.select(one.alias("t")).where("t is not null").select("t.*")


def _tagged(data: DataFrame, names: Sequence[str], spans: Sequence[Span], cells: int) -> DataFrame:
    """Rows (span, cell, x) for every value that lies in one of the spans."""
    per_column = []
    for i, name in enumerate(names):
        x = F.col(name)
        chosen = None
        for number, span in enumerate(spans):
            if span.column != i:
                continue
            hit = (x >= span.low) & (x <= span.high) & ~F.isnan(x)
            tag = F.struct(
                F.lit(number).alias("span"), _cell(x, span, cells).alias("cell"), x.alias("x")
            )
            chosen = F.when(hit, tag) if chosen is None else chosen.when(hit, tag)
        if chosen is not None:
            per_column.append(chosen)
    return _stacked(data, per_column)


def long_values(df: DataFrame, columns: Mapping[int, Column]) -> DataFrame:
    """Rows (column, x) of the values of numbered double columns, without null and NaN."""
    tags = [F.struct(F.lit(i).alias("column"), x.alias("x")) for i, x in columns.items()]
    rows = df.select(tags[0].alias("t")).select("t.*") if len(tags) == 1 else df.select(F.inline(F.array(*tags)))
    return rows.where(F.col("x").isNotNull() & ~F.isnan("x"))


def placed_values(values: DataFrame, spans: Sequence[Span], cells: int) -> DataFrame:
    """Rows (span, cell, x) for every one of ``long_values`` that lies in one of the spans.

    A span lies in one logarithmic cell, by which values look it up, so a row
    costs the same for a thousand spans as for one.
    """
    held = ", ".join(f"({number}, {s.column}, double('{s.low!r}'), double('{s.high!r}'))" for number, s in enumerate(spans))
    bounds = values.sparkSession.sql(f"SELECT * FROM VALUES {held} AS t (span, column, low, high)")
    near = F.broadcast(bounds.withColumn("at", _log_cell(F.col("low"))))
    x, low, high = F.col("x"), F.col("low"), F.col("high")
    return (
        values.withColumn("at", _log_cell(x))
        .join(near, ["column", "at"])
        .where((x >= low) & (x <= high))
        .select("span", _even_cell(x, low, high, cells).alias("cell"), "x")
    )


def _counted(tagged: DataFrame) -> dict[int, list]:
    rows = (
        tagged.groupBy("span", "cell")
        .agg(F.count("*").alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        .collect()
    )
    ordered: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["span"], r["cell"])):
        ordered.setdefault(r["span"], []).append(r)
    return ordered


def _chained(column: int, below: int, rows: Sequence) -> list[Span]:
    found = []
    for r in rows:
        found.append(Span(column, r["low"], r["high"], below, r["rows"]))
        below += r["rows"]
    return found


def first_cells(data: DataFrame, names: Sequence[str]) -> list[list[Span]]:
    """Non-empty logarithmic cells of every column, in value order."""
    tags = [
        F.when(
            F.col(n).isNotNull() & ~F.isnan(n),
            F.struct(F.lit(i).alias("span"), _log_cell(F.col(n)).alias("cell"), F.col(n).alias("x")),
        )
        for i, n in enumerate(names)
    ]
    counted = _counted(_stacked(data, tags))
    return [_chained(i, 0, counted.get(i, [])) for i in range(len(names))]


def count_cells(
    data: DataFrame, names: Sequence[str], spans: Sequence[Span], cells: int
) -> dict[int, list[Span]]:
    """Cut every span evenly into cells; the non-empty ones, in value order."""
    cells = max(16, min(cells, CELL_ROWS // len(spans)))
    counted = _counted(_tagged(data, names, spans, cells))
    return {
        number: _chained(span.column, span.below, counted.get(number, []))
        for number, span in enumerate(spans)
    }


def _rank(level: float, rows: int) -> int:
    return max(1, math.ceil(Fraction(str(level)) * rows))


def _holding(spans: Sequence[Span], rank: int) -> Span:
    """The span that holds the row of this rank."""
    return next(s for s in spans if s.below + s.rows >= rank)


def values_at_ranks(
    data: DataFrame,
    names: Sequence[str],
    ranks_of: Callable[[dict[str, int]], Mapping[str, Iterable[int]]],
    few_rows: int = FEW_ROWS,
    cells: int = CELLS,
) -> dict[tuple[str, int], float]:
    """Order statistics of several double columns from shared passes.

    ``ranks_of`` gets the number of values of each column, known after the first
    pass, and names the ranks wanted (from 1); ranks beyond a column are left out.
    """
    first = dict(zip(names, first_cells(data, names), strict=True))
    totals = {n: found[-1].below + found[-1].rows if found else 0 for n, found in first.items()}
    place = {
        (n, rank): _holding(first[n], rank)
        for n, ranks in ranks_of(totals).items()
        for rank in ranks
        if 1 <= rank <= totals[n]
    }
    while spans := list(dict.fromkeys(s for s in place.values() if s.low < s.high)):
        if sum(s.rows for s in spans) <= few_rows:
            # at most ``few_rows`` distinct values are left
            values = _tagged(data, names, spans, 1).withColumn("cell", F.col("x"))
            counted = _counted(values)
            split = {n: _chained(s.column, s.below, counted[n]) for n, s in enumerate(spans)}
        else:
            split = count_cells(data, names, spans, cells)
        inner = {spans[number]: found for number, found in split.items()}
        place.update({at: _holding(inner[s], at[1]) for at, s in place.items() if s.low < s.high})
    return {at: s.low for at, s in place.items()}


def exact_quantiles(
    df: DataFrame,
    levels: Mapping[str, Sequence[float]],
    few_rows: int = FEW_ROWS,
    cells: int = CELLS,
) -> dict[str, list[float | None]]:
    """Quantiles of several columns at once, as driver-side numbers.

    A column without any value yields ``None`` for each level.
    """
    names = {c: f"x{i}" for i, c in enumerate(levels)}
    data = df.select(*[F.col(c).cast("double").alias(n) for c, n in names.items()])
    ranks: dict[str, list[int]] = {}

    def ranks_of(totals: dict[str, int]):
        ranks.update({n: [_rank(p, totals[n]) for p in levels[c]] for c, n in names.items()})
        return ranks

    found = values_at_ranks(data, list(names.values()), ranks_of, few_rows, cells)
    return {c: [found.get((n, rank)) for rank in ranks[n]] for c, n in names.items()}


def filled_quantiles(
    df: DataFrame, levels: Mapping[str, Sequence[float]], above: Mapping[str, float] | None = None
) -> tuple[dict[str, float | None], dict[str, list[float | None]]]:
    """Medians of columns, and quantiles that the columns have once nulls are filled by them.

    ``above`` limits the quantiles of a column to values over a number.  Both come
    from the same passes: filling adds copies of one known value, which moves a
    rank by at most their number, so the value at a rank of the filled column is
    the middle one of the median and two order statistics of the given values.
    """
    above = above or {}
    data, kinds = [], {}
    for i, c in enumerate(levels):
        x = F.col(c).cast("double")
        kept = x if c not in above else F.when(x > F.lit(above[c]), x)
        kinds[c] = whole, part, missing = f"x{i}", f"kept{i}", f"missing{i}"
        data += [x.alias(whole), kept.alias(part), F.when(x.isNull(), F.lit(0.0)).alias(missing)]
    asked: dict[str, list[tuple[int, int, int]]] = {}

    def ranks_of(totals: dict[str, int]):
        wanted = {}
        for c, (whole, part, missing) in kinds.items():
            copies = totals[missing]
            asked[c] = []
            for p in levels[c]:
                # the copies count or do not, which the median decides
                rank = _rank(p, totals[part] + copies)
                asked[c].append((_rank(p, totals[part]), rank, rank - copies))
            wanted[whole] = [_rank(0.5, totals[whole])]
            wanted[part] = [r for ranks in asked[c] for r in ranks]
        return wanted

    names = [n for kind in kinds.values() for n in kind]
    found = values_at_ranks(df.select(*data), names, ranks_of)
    medians = {c: next((v for (n, _), v in found.items() if n == kinds[c][0]), None) for c in levels}

    def value(c: str, alone: int, rank: int, lower: int) -> float | None:
        part, middle = kinds[c][1], medians[c]
        if middle is None or (c in above and not middle > above[c]):
            return found.get((part, alone))
        return sorted([found.get((part, lower), -math.inf), middle, found.get((part, rank), math.inf)])[1]

    return medians, {c: [value(c, *ranks) for ranks in asked[c]] for c in levels}


def quantile_table(df: DataFrame, levels: Mapping[str, Sequence[float]], **options) -> DataFrame:
    """Exact quantiles as rows (column_name, level, value)."""
    found = exact_quantiles(df, levels, **options)
    rows = [(c, float(p), v) for c, ps in levels.items() for p, v in zip(ps, found[c])]
    return literal_frame(df.sparkSession, {"column_name": "string", "level": "double", "value": "double"}, rows)


def _same_group(names: Sequence[str], other: str = "o") -> Column:
    """Equal groups, null being a group too."""
    on = F.lit(True)
    for name in names:
        on = on & F.col(f"r.{name}").eqNullSafe(F.col(f"{other}.{name}"))
    return on


def quantiles_by_group(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    levels: Mapping[str, float],
    interpolate: bool = False,
    few_rows: int = FEW_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """Exact quantiles of many groups, with their row count, range and mean.

    Returns ``by``, a column per named level, ``n``, ``min_value``, ``max_value``
    and ``mean``.  Only counts per (group, cell) are shuffled: cells of a
    logarithmic scale first, then even cuts of those cells that hold a wanted
    rank, whose rows are the only ones counted again.  A cell with one value is
    finished, and a cell of at most ``few_rows`` rows is counted by value, so a
    group of any size and a value of any frequency are spread over all tasks.

    Without ``interpolate`` a level gives the smallest value whose share reaches
    it, with it the mix of both neighbouring order statistics.  Null and NaN
    take no part; a group of such values only is left out.  Null is a group.
    """
    names = [f"g{i}" for i in range(len(by))]
    x = F.col(value).cast("double")
    rows = durable(
        df.select(*[F.col(b).alias(g) for b, g in zip(by, names)], x.alias("x")).where(x.isNotNull() & ~F.isnan(x))
    )
    measured = [F.count("*").alias("c"), F.min("x").alias("low"), F.max("x").alias("high")]
    counted = durable(rows.groupBy(*names, _log_cell(F.col("x")).alias("cell")).agg(*measured, F.sum("x").alias("total")))
    groups = counted.groupBy(*names).agg(
        F.sum("c").alias("n"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        (F.sum("total") / F.sum("c")).alias("mean"),
    )

    wanted = []
    for name, level in levels.items():
        exact = F.lit(str(level)).cast("decimal(10,8)")
        if interpolate:
            place = (F.col("n") - 1) * exact
            wanted += [(f"{name} low", F.floor(place) + 1), (f"{name} high", F.ceil(place) + 1)]
        else:
            wanted.append((name, F.greatest(F.ceil(F.col("n") * exact), F.lit(1))))
    asked = groups.select(
        *names, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), r.cast("long").alias("rank")) for n, r in wanted])).alias("a")
    ).select(*names, "a.name", "a.rank")

    def holding(counts: DataFrame, order: str, near: Sequence[str]) -> DataFrame:
        """Of every (group, name) the cell with its rank, and the rank inside it."""
        upto = F.sum("c").over(Window.partitionBy(*near).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        below = F.col("upto") - F.col("c")
        return (
            counts.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("rank")) & (below < F.col("rank")))
            .select(*names, "name", (F.col("rank") - below).alias("rank"), "c", "low", "high")
        )

    placed = counted.alias("r").join(asked.alias("o"), _same_group(names)).select(
        *[f"r.{g}" for g in names], "name", "rank", "cell", "c", "low", "high"
    )
    found = durable(holding(placed, "cell", [*names, "name"]))
    finished = []
    while True:
        finished.append(found.where("low = high").select(*names, "name", F.col("low").alias("x")))
        most = found.where("low < high").agg(F.max("c")).first()[0]
        if most is None:
            break
        # bounds of the open cells: a few per group, whatever the number of rows
        spans = found.where("low < high").alias("o")
        inside = (F.col("r.x") >= F.col("o.low")) & (F.col("r.x") <= F.col("o.high"))
        low, high, value_of = F.col("o.low"), F.col("o.high"), F.col("r.x")
        if most <= few_rows:
            part = value_of
        else:
            # halves keep differences finite; the largest value has a cell of its own
            width = F.greatest(high / 2 - low / 2, F.lit(5e-324))
            even = F.least(F.floor((value_of / 2 - low / 2) / width * cells), F.lit(cells - 1))
            part = F.when(value_of >= high, F.lit(cells)).otherwise(even).cast("double")
        again = (
            rows.alias("r")
            .join(spans, _same_group(names) & inside)
            .groupBy(*[F.col(f"r.{g}").alias(g) for g in names], "name", "rank", part.alias("cell"))
            .agg(F.count("*").alias("c"), F.min("r.x").alias("low"), F.max("r.x").alias("high"))
        )
        found = durable(holding(again, "cell", [*names, "name"]))

    values = finished[0]
    for more in finished[1:]:
        values = values.unionByName(more)
    at = {n: F.max(F.when(F.col("name") == n, F.col("x"))) for n, _ in wanted}
    ends = values.groupBy(*names).agg(*[e.alias(n) for n, e in at.items()])
    picked = []
    for name, level in levels.items():
        if interpolate:
            place = (F.col("n") - 1) * F.lit(str(level)).cast("decimal(10,8)")
            share = (place - F.floor(place)).cast("double")
            low, high = F.col(f"`{name} low`"), F.col(f"`{name} high`")
            # equal neighbours need no mixing, which keeps infinite values
            picked.append(F.when(low == high, low).otherwise(low + (high - low) * share).alias(name))
        else:
            picked.append(F.col(f"`{name}`"))
    return groups.alias("r").join(ends.alias("o"), _same_group(names)).select(
        *[F.col(f"r.{g}").alias(b) for b, g in zip(by, names)], *picked, "n", "min_value", "max_value", "mean"
    )


def approx_quantile_table(df: DataFrame, levels: Mapping[str, Sequence[float]]) -> DataFrame:
    """Sketch-based quantiles, rank error a tenth of the distance to the nearer end.

    An error as large as the level itself may return the minimum or maximum,
    which would turn tail clipping into a no-op.
    """
    rows = []
    for column, ps in levels.items():
        error = min([min(p, 1 - p) for p in ps if 0 < p < 1] or [0.1]) / 10
        values = df.approxQuantile(column, list(ps), error) or [None] * len(ps)
        rows += [(column, float(p), v) for p, v in zip(ps, values)]
    return literal_frame(df.sparkSession, {"column_name": "string", "level": "double", "value": "double"}, rows)
