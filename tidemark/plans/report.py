"""Long-format reports: rows (section, metric, label, value)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import pvalues
from ..operators import quality
from ..operators import quantiles as Q
from ..operators.quality import percent
from ..session import literal_frame

_COLUMNS = {"section": "string", "metric": "string", "label": "string", "value": "double"}


def long_rows(df: DataFrame, section: str, metrics: list[str], label: str | None = None) -> DataFrame:
    """Turn the metric columns of a small frame into report rows."""
    cells = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    mark = F.lit(None).cast("string") if label is None else F.col(label).cast("string")
    return df.select(F.lit(section).alias("section"), mark.alias("label"), F.inline(cells)).select(
        "section", "metric", "label", "value"
    )


def thresholds_frame(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    found = quality.empirical_thresholds(transactions, customers)
    return customers.sparkSession.range(1, numPartitions=1).select(
        *[F.lit(v).cast("double").alias(k) for k, v in found.items()]
    )


def _percent(part: int, whole: int) -> float:
    if not whole:
        return 0.0
    return float(Decimal(repr(100.0 * part / whole)).quantize(Decimal("0.01"), ROUND_HALF_UP))


class _Profile:
    """Quantiles of several columns and the distance of two samples, from shared passes.

    ``parts`` are tables with a double column ``x{i}`` for some of the entries of
    ``levels``, of which there is one per column, or for the two samples, which
    come after them.  Every pass counts rows in cells; the next one looks only
    into cells that hold a wanted rank, or in which the distance could be larger
    than the largest one found at the end of a cell.  There may be hundreds of
    these, so a value finds its own by a lookup and a pass reads only the columns
    that have any.
    """

    def __init__(self, parts: Sequence[DataFrame], levels: Sequence[Sequence[float]], labels: DataFrame):
        self.parts, self.levels = parts, levels
        self.a, self.b = len(levels), len(levels) + 1
        self.label_counts: dict[int, dict[tuple, int]] = {}
        first = self._first_pass(labels)
        self.ranks: dict[tuple[int, float], int] = {}
        self.place: dict[tuple[int, int], Q.Span] = {}
        for i, wanted in enumerate(levels):
            spans = Q._chained(i, 0, [r for _, r in sorted(first.get(i, {}).items())])
            total = spans[-1].below + spans[-1].rows if spans else 0
            for level in wanted if total else ():
                rank = self.ranks[i, level] = Q._rank(level, total)
                self.place[i, rank] = Q._holding(spans, rank)
        self.pairs = self._paired(first.get(self.a, {}), first.get(self.b, {}))
        self.sizes = sum(p[2] for p in self.pairs), sum(p[3] for p in self.pairs)
        while self._narrow():
            pass

    def _values(self, columns: Iterable[int]) -> DataFrame:
        """Rows (column, x) of the given columns, each table taken by itself."""
        chosen, parts = set(columns), []
        for part in self.parts:
            held = [i for i in sorted(chosen) if f"x{i}" in part.columns]
            if held:
                parts.append(Q.long_values(part, {i: F.col(f"x{i}") for i in held}))
        return reduce(DataFrame.unionByName, parts)

    def _first_pass(self, labels: DataFrame) -> dict[int, dict[int, Row]]:
        cells = self._values(range(len(self.levels) + 2)).select(
            F.col("column").alias("span"), Q._log_cell(F.col("x")).alias("cell"), "x"
        )
        counted = (
            cells.unionByName(labels, allowMissingColumns=True)
            .groupBy("span", "cell", "a", "b")
            .agg(F.count("*").alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()
        )
        found: dict[int, dict[int, Row]] = {}
        for r in counted:
            if r["span"] < 0:
                self.label_counts.setdefault(r["span"], {})[r["a"], r["b"]] = r["rows"]
            else:
                found.setdefault(r["span"], {})[r["cell"]] = r
        return found

    @staticmethod
    def _paired(a: dict[float, Row], b: dict[float, Row]) -> list[tuple[float, float, int, int]]:
        """Cells of both samples in order: lowest and highest value, rows of each sample."""
        out = []
        for cell in sorted(a.keys() | b.keys()):
            held = [s[cell] for s in (a, b) if cell in s]
            rows = [s[cell]["rows"] if cell in s else 0 for s in (a, b)]
            out.append((min(r["low"] for r in held), max(r["high"] for r in held), *rows))
        return out

    def distance(self) -> float | None:
        return self._distances()[0] if all(self.sizes) else None

    def _distances(self) -> tuple[float, list[int]]:
        """The largest distance at the end of a cell, and the cells inside which there may be a larger one."""
        n_a, n_b = self.sizes
        best, upto_a, upto_b, most = 0.0, 0, 0, []
        for i, (low, high, a, b) in enumerate(self.pairs):
            if low < high:
                most.append((max(abs((upto_a + a) / n_a - upto_b / n_b), abs(upto_a / n_a - (upto_b + b) / n_b)), i))
            upto_a, upto_b = upto_a + a, upto_b + b
            best = max(best, abs(upto_a / n_a - upto_b / n_b))
        return best, [i for bound, i in most if bound > best]

    def _narrow(self) -> bool:
        spans = list(dict.fromkeys(s for s in self.place.values() if s.low < s.high))
        opened = self._distances()[1] if all(self.sizes) else []
        n = len(spans)
        for i in opened:
            low, high, a, b = self.pairs[i]
            spans += [Q.Span(self.a, low, high, 0, a), Q.Span(self.b, low, high, 0, b)]
        if not spans:
            return False
        few = sum(s.rows for s in spans) <= Q.FEW_ROWS
        cells = 1 if few else max(16, min(Q.CELLS, Q.CELL_ROWS // len(spans)))
        tagged = Q.placed_values(self._values(s.column for s in spans), spans, cells)
        counted = Q._counted(tagged.withColumn("cell", F.col("x")) if few else tagged)
        inner = {s: Q._chained(s.column, s.below, counted[k]) for k, s in enumerate(spans[:n])}
        self.place.update({(i, r): Q._holding(inner[s], r) for (i, r), s in self.place.items() if s.low < s.high})
        by_cell = [{r["cell"]: r for r in counted.get(k, [])} for k in range(n, len(spans))]
        finer = {i: self._paired(*by_cell[2 * k : 2 * k + 2]) for k, i in enumerate(opened)}
        self.pairs = [p for i, pair in enumerate(self.pairs) for p in finer.get(i, [pair])]
        return True

    def quantile(self, i: int, level: float) -> float | None:
        return self.place[i, self.ranks[i, level]].low if (i, level) in self.ranks else None


def _chi_square(cells: dict[tuple, int]) -> tuple[float | None, int, int]:
    """Statistic, degrees of freedom and rows of counts by two labels; 2 x 2 with continuity correction."""
    rows, columns = {}, {}
    for (a, b), n in cells.items():
        rows[a], columns[b] = rows.get(a, 0) + n, columns.get(b, 0) + n
    total = sum(rows.values())
    dof = (len(rows) - 1) * (len(columns) - 1)
    if not total:
        return None, dof, 0
    less = 0.5 if len(rows) == len(columns) == 2 else 0.0
    terms = []
    for a, r in rows.items():
        for b, c in columns.items():
            expected = r / total * c
            terms.append(max(abs(cells.get((a, b), 0) - expected) - less, 0.0) ** 2 / expected)
    return math.fsum(terms), dof, total


def quality_report(
    customers: DataFrame,
    applications: DataFrame,
    transactions: DataFrame,
    customer_table: DataFrame,
    p_values: bool = True,
) -> DataFrame:
    """All data-quality findings of a run in nine sections, from a few passes over all tables.

    The first pass counts the columns of all tables in cells, and the labels of
    applications and customers; one or more further passes look into the cells
    that matter; the last combines all tables per customer, which tells orphans,
    negative balances and what lies outside the limits just found.  A report is
    some fifty numbers, and each pass returns counts only.

    ``p_values=False`` leaves out the tail probabilities, which are the only
    entries not computed from counts.
    """
    spark = customers.sparkSession
    count, quartiles = "total_transactions_count", (0.25, 0.75)
    levels = [quartiles, tuple(fixed.AGE_TERTILE_LEVELS), quartiles, (fixed.LOW_BALANCE_LEVEL,), (fixed.THIN_HISTORY_LEVEL,)]
    segment = F.col("customer_segment")
    columns = [
        (customers, [F.col("income"), F.col("age")]),
        (applications, [F.col("amount")]),
        (transactions, [F.when(F.col("balance") > 0, F.col("balance"))]),
        (
            customer_table,
            [F.col(count), *[F.when(segment == s, F.col("income")) for s in (fixed.BORROWER, fixed.PROSPECT)]],
        ),
    ]
    parts, place = [], 0
    for table, values in columns:
        parts.append(table.select(*[v.cast("double").alias(f"x{place + i}") for i, v in enumerate(values)]))
        place += len(values)

    def labelled(table: DataFrame, kind: int, a: Column, b: Column) -> DataFrame:
        return table.select(F.lit(kind).alias("span"), a.cast("string").alias("a"), b.cast("string").alias("b"))

    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("null"))

    labels = labelled(applications, -1, F.col("outcome"), F.lit(None)).unionByName(
        labelled(customer_table, -2, named("gender"), named("customer_segment"))
    )
    known = _Profile(parts, levels, labels)

    fences = []
    for i in (0, 2):
        q1, q3 = (known.quantile(i, p) for p in quartiles)
        width = None if q1 is None else fixed.FENCE_WIDTH * (q3 - q1)
        fences.append((None, None) if q1 is None else (q1 - width, q3 + width))
    thin = known.quantile(4, fixed.THIN_HISTORY_LEVEL)
    facts = _facts(customers, applications, transactions, customer_table.select(count), fences, thin, count)

    rows: list[tuple] = []

    def add(section: str, label: str | None = None, **metrics) -> None:
        rows.extend((section, m, label, None if v is None else float(v)) for m, v in metrics.items())

    for child in ("applications", "transactions"):
        orphans = facts[f"orphans_{child}"] or 0
        add("referential_integrity", child, orphan_keys=orphans, passed=orphans == 0)
    for name, (low, high) in zip(("income", "amount"), fences, strict=True):
        add(
            f"{name}_outliers", lower_bound=low, upper_bound=high, min_value=facts[f"{name}_min"], max_value=facts[f"{name}_max"],
            n_outliers=facts[f"{name}_outside"] or 0, pct_outliers=facts[f"{name}_pct"], n_sentinel_hits=facts[f"{name}_sentinel"] or 0,
        )
    add(
        "negative_balance",
        **{m: facts[m] for m in ("n_negative_rows", "pct_negative_rows", "n_keys_ever_negative", "pct_keys_ever_negative", "min_value", "avg_negative")},
    )
    add("transaction_history", level=fixed.THIN_HISTORY_LEVEL, threshold=thin, n_flagged=facts["n_flagged"] or 0, pct_flagged=facts["pct_flagged"])
    classes = known.label_counts.get(-1, {})
    for (outcome, _), n in classes.items():
        add("class_balance", outcome, n=n, pct=_percent(n, sum(classes.values())))
    young, middle = (known.quantile(1, p) for p in fixed.AGE_TERTILE_LEVELS)
    add(
        "empirical_thresholds", low_balance_threshold=known.quantile(3, fixed.LOW_BALANCE_LEVEL), age_tertile_33=young, age_tertile_66=middle
    )

    def with_p(p: float | None) -> dict:
        return {"p_value": p, "significant": None if p is None else p < fixed.SIGNIFICANCE} if p_values else {}

    d = known.distance()
    add(
        "income_distribution_shift", ks_statistic=d, n_a=known.sizes[0], n_b=known.sizes[1],
        **with_p(None if d is None else pvalues.ks_two_sample(d, *known.sizes)),
    )
    chi, dof, _ = _chi_square(known.label_counts.get(-2, {}))
    add(
        "gender_segment_independence", chi2_statistic=chi, degrees_of_freedom=dof, **with_p(None if chi is None else pvalues.chi_square(chi, dof))
    )
    return literal_frame(spark, _COLUMNS, rows)


def _facts(
    customers: DataFrame, applications: DataFrame, transactions: DataFrame, histories: DataFrame, fences, thin: float | None, count: str
) -> Row:
    """One row of counts over all tables: totals of the rows, and what the customers' marks tell.

    Totals need no key, so a customer is combined from one number per row only:
    the tables it occurs in, and whether a balance was negative.
    """
    below = F.col("balance") < 0

    def side(table: DataFrame, name: str, **values: Column) -> DataFrame:
        return table.select(F.lit(1).alias(f"in_{name}"), *[v.cast("double").alias(n) for n, v in values.items()])

    everything = reduce(
        lambda x, y: x.unionByName(y, allowMissingColumns=True),
        [
            side(customers, "customers", income=F.col("income")),
            side(applications, "applications", amount=F.col("amount")),
            side(transactions, "transactions", balance=F.col("balance")),
            side(histories, "histories", seen=F.col(count)),
        ],
    )
    sums = {f"n_{t}": F.count(f"in_{t}") for t in ("customers", "applications", "transactions", "histories")}
    for name, (low, high) in zip(("income", "amount"), fences, strict=True):
        x = F.col(name)
        outside = F.lit(False) if low is None else (x < F.lit(low)) | (x > F.lit(high))
        sums |= {f"{name}_outside": F.count_if(outside), f"{name}_sentinel": F.count_if(x.isin(*fixed.SENTINELS))}
    sums |= {
        "negative": F.count_if(below),
        "negative_total": F.sum(F.when(below, F.col("balance"))),
        "min_value": F.min(F.when(below, F.col("balance"))),
        "n_flagged": F.count_if(F.col("seen") <= F.lit(thin).cast("double")),
    }
    ends = {f"{n}_{f.__name__}": f(n) for n in ("income", "amount") for f in (F.min, F.max)}
    known, asked, moved, sank = 1, 2, 4, 8
    marks = [
        (customers, F.lit(known)),
        (applications, F.lit(asked)),
        (transactions, F.when(F.col("balance").cast("double") < 0, F.lit(moved | sank)).otherwise(F.lit(moved))),
    ]
    per_key = (
        reduce(DataFrame.unionByName, [table.select("id", mark.alias("mark")) for table, mark in marks])
        .groupBy("id")
        .agg(F.bit_or("mark").alias("marks"))
    )

    def has(mark: int) -> Column:
        return F.col("marks").bitwiseAND(F.lit(mark)) > 0

    # both kinds of rows meet in one row of counts, to which the other kind adds nothing
    parentless = F.col("id").isNull() | ~has(known)
    of_keys = {
        f"orphans_{t}": F.count_if(parentless & has(m)) for t, m in (("applications", asked), ("transactions", moved))
    } | {"n_keys_ever_negative": F.count_if(has(sank)), "keys_moved": F.count_if(has(moved))}
    totals = everything.unionByName(per_key, allowMissingColumns=True).agg(
        *[e.alias(n) for n, e in (sums | ends | of_keys).items()]
    )
    shares = {"income": ("outside", "customers"), "amount": ("outside", "applications")}
    return totals.select(
        "*",
        *[percent(F.col(f"{n}_{part}"), F.col(f"n_{whole}")).alias(f"{n}_pct") for n, (part, whole) in shares.items()],
        F.col("negative").alias("n_negative_rows"),
        percent(F.col("negative"), F.col("n_transactions")).alias("pct_negative_rows"),
        percent(F.col("n_keys_ever_negative"), F.col("keys_moved")).alias("pct_keys_ever_negative"),
        F.try_divide(F.col("negative_total"), F.col("negative")).alias("avg_negative"),
        percent(F.col("n_flagged"), F.col("n_histories")).alias("pct_flagged"),
    ).first()
