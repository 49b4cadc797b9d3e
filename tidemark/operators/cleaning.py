"""Row-preserving cleaning of customer, application and transaction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as fixed
from .quantiles import exact_quantiles, filled_quantiles


def impute_median(df: DataFrame, columns: Sequence[str], flags: Mapping[str, str] | None = None) -> DataFrame:
    """Replace nulls by the column's exact median; flags are taken before that.

    ``flags`` maps a column to the name of its 0/1 missing flag.  A column with
    no value at all stays null.
    """
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    return fill(df, {c: medians[c][0] for c in columns}, flags)


def fill(df: DataFrame, values: Mapping[str, float | None], flags: Mapping[str, str] | None = None) -> DataFrame:
    """Replace nulls by known values; flags are taken before that."""
    marked = df.withColumns({flag: C.missing_flag(F.col(c)) for c, flag in (flags or {}).items()})
    return marked.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def winsorize(
    df: DataFrame, columns: Sequence[str], low: float = fixed.TAIL_LEVELS[0], high: float = fixed.TAIL_LEVELS[1]
) -> DataFrame:
    """Clip the columns in place at their own exact quantiles; nulls stay null."""
    bounds = exact_quantiles(df, {c: [low, high] for c in columns})
    return df.withColumns({c: C.clip(F.col(c), *bounds[c]) for c in columns})


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to date; text that is no date becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in columns})


def clean_customers(df: DataFrame, gender="gender", age="age", income="income") -> DataFrame:
    """Canonical gender, implausible ages removed, age and income filled by median.

    Large incomes are kept: capping is a separate, explicit step.
    """
    return impute_median(valid_customers(df, gender, age), [age, income]).withColumn(age, F.col(age).cast("int"))


def valid_customers(df: DataFrame, gender="gender", age="age") -> DataFrame:
    """Canonical gender, implausible ages removed, nothing filled."""
    return df.withColumns({gender: C.normalize_category(F.col(gender)), age: C.null_outside(F.col(age))})


def clean_applications(df: DataFrame, date="dt", amount="amount") -> DataFrame:
    """Typed date and amount; applications without an outcome are pending and stay."""
    return df.withColumns({date: F.col(date).try_cast("date"), amount: F.col(amount).try_cast("double")})


def clean_transactions(
    df: DataFrame, date="dt", amount="amount", balance="balance", flag="balance_missing"
) -> DataFrame:
    """Typed date and amount, missing balances flagged and then filled by median.

    Negative balances are kept: whether they are overdrafts is for the report.
    """
    return impute_median(typed_transactions(df, date, amount), [balance], {balance: flag})


def typed_transactions(df: DataFrame, date="dt", amount="amount") -> DataFrame:
    return df.withColumns({date: F.col(date).try_cast("date"), amount: F.col(amount).try_cast("double")})


def clean_with_thresholds(
    customers: DataFrame, transactions: DataFrame, balance="balance", age="age", income="income", flag="balance_missing"
) -> tuple[DataFrame, DataFrame, dict[str, float | None]]:
    """Cleaned customers and transactions, and the thresholds that the cleaned columns have.

    The same as cleaning both tables and then asking for the low-balance limit
    and the age tertiles, with one set of passes over each table: medians and
    thresholds come from the same counts.
    """
    people, moves = valid_customers(customers, age=age), typed_transactions(transactions)
    of_people, ages = filled_quantiles(people, {age: fixed.AGE_TERTILE_LEVELS, income: ()})
    of_moves, balances = filled_quantiles(moves, {balance: [fixed.LOW_BALANCE_LEVEL]}, {balance: 0.0})
    # whole years, as the cleaned column holds them
    young, middle = (None if v is None else float(int(v)) for v in ages[age])
    return (
        fill(people, of_people).withColumn(age, F.col(age).cast("int")),
        fill(moves, of_moves, {balance: flag}),
        {"low_balance_threshold": balances[balance][0], "age_tertile_33": young, "age_tertile_66": middle},
    )
