"""Column expressions: cleaning, encoding, guarded ratios, bands and flags.

All of them are built-in expressions, so they stay inside code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def case(branches: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """First branch whose condition is true, else ``otherwise``."""
    (condition, value), *rest = branches
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def normalize_category(
    raw: Column,
    spellings: Mapping[str, Sequence[str]] = fixed.GENDER_SPELLINGS,
    other: str = fixed.GENDER_UNKNOWN,
) -> Column:
    """Canonical label of a free-text category; null and unrecognised give ``other``."""
    token = F.upper(F.trim(raw))
    return case([(token.isin(*words), label) for label, words in spellings.items()], other)


def null_outside(value: Column, low: float = fixed.AGE_MIN, high: float = fixed.AGE_MAX) -> Column:
    """Null for values outside ``[low, high]``."""
    return F.when(value.between(low, high), value)


def missing_flag(value: Column) -> Column:
    return value.isNull().cast("int")


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` with a zero denominator read as one."""
    return numerator / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)


def rate_or_marker(hits: Column, trials: Column, marker: float = fixed.NO_HISTORY_RATE) -> Column:
    """Success share, or ``marker`` where nothing was tried yet."""
    return F.when(trials > 0, hits / trials).otherwise(F.lit(marker))


def recency_days(last: Column, as_of, never: int = fixed.NEVER_DAYS) -> Column:
    """Days from ``last`` to ``as_of``; ``never`` where there is no date."""
    return F.coalesce(F.datediff(F.lit(as_of).cast("date"), last), F.lit(never))


def segment_label(has_history: Column, yes: str = fixed.BORROWER, no: str = fixed.PROSPECT) -> Column:
    return F.when(has_history, F.lit(yes)).otherwise(F.lit(no))


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Value limited to ``[low, high]``; null passes through, an absent limit is no limit."""
    branches = []
    if low is not None:
        branches.append((value < low, F.lit(low)))
    if high is not None:
        branches.append((value > high, F.lit(high)))
    return case(branches, value) if branches else value


def encode_category(
    value: Column,
    codes: Mapping[str, int] = fixed.GENDER_CODES,
    other: int = fixed.GENDER_OTHER_CODE,
) -> Column:
    return case([(value == label, F.lit(code)) for label, code in codes.items()], F.lit(other))


def unknown_indicator(value: Column, known: Sequence[str] = tuple(fixed.GENDER_CODES)) -> Column:
    """1 where the value is not a known label; null stays null."""
    return (~value.isin(*known)).cast("int")


def banded(
    value: Column,
    bands: Sequence[tuple[float, str]] = fixed.AGE_BANDS,
    open_label: str = fixed.AGE_BAND_OPEN,
    missing_label: str | None = fixed.GENDER_UNKNOWN,
) -> Column:
    """Label of the first band whose inclusive upper bound holds the value."""
    missing = open_label if missing_label is None else missing_label
    return case(
        [(value.isNull(), missing)] + [(value <= upper, label) for upper, label in bands],
        open_label,
    )


def life_stage(
    age: Column,
    income: Column,
    age_cuts: Sequence[float],
    income_median: float,
    labels: Mapping[str, Mapping[str, str]] = fixed.LIFE_STAGE_LABELS,
    unknown: str = fixed.LIFE_STAGE_DEFAULT,
) -> Column:
    """Label of an age band and a side of the median income, from a table of labels.

    ``labels`` has one row per band in ascending order; ``age_cuts`` are the
    inclusive upper bounds of all but the last.  A band with one label for both
    sides does not ask for the income; otherwise what is not known gives
    ``unknown``.
    """
    *closed, last = labels
    band = banded(age, list(zip(age_cuts, closed, strict=True)), last, missing_label="")
    side = F.when(income > income_median, "above").when(income <= income_median, "other")
    branches = []
    for name, sides in labels.items():
        if len(set(sides.values())) == 1:
            branches.append((band == name, next(iter(sides.values()))))
        else:
            branches += [((band == name) & (side == s), label) for s, label in sides.items()]
    return case(branches, unknown)


def life_stage_names(labels: Mapping[str, Mapping[str, str]] = fixed.LIFE_STAGE_LABELS) -> list[str]:
    return list(dict.fromkeys(label for sides in labels.values() for label in sides.values()))


def flag_name(prefix: str, label: str) -> str:
    return f"{prefix}{label}".lower()


def one_hot(label: Column, labels: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per label, named ``prefix`` + label in lower case."""
    return {flag_name(prefix, name): (label == name).cast("int") for name in labels}


_COMPARISONS = {
    "=": lambda a, b: a == b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def first_rule(
    rules: Sequence[tuple[str, Sequence[tuple[str, str, object]]]],
    otherwise: str,
    parameters: Mapping[str, object],
) -> Column:
    """Label of the first rule of which all conditions hold.

    A condition is (column, comparison, limit); a limit that is a name stands for
    a parameter.  A comparison with null does not hold.
    """

    def holds(conditions) -> Column:
        out = F.lit(True)
        for column, sign, limit in conditions:
            value = parameters[limit] if isinstance(limit, str) else limit
            out = out & _COMPARISONS[sign](F.col(column), F.lit(value))
        return out

    return case([(holds(conditions), label) for label, conditions in rules], otherwise)


def hash_number(key: Column, seed: int) -> Column:
    """A 52-bit number that depends only on key and seed, for repeatable splits and orders."""
    digits = F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)))), 1, 13)
    return F.conv(digits, 16, 10).cast("double")


def in_share(key: Column, seed: int, share: float) -> Column:
    """Whether a key is in the ``share`` of keys with the smallest hashes."""
    return hash_number(key, seed) < F.lit(share * 2.0**52)


def day_number(day: Column) -> Column:
    """Days since 1970-01-01; rows without a date sort before every dated row."""
    return F.coalesce(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(-10_000_000))


def month_of(day: Column) -> Column:
    """First day of the month: a cheap grouping key."""
    return F.trunc(day, "month")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
