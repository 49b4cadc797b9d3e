"""Account activity: flows, balances and drawdown per customer.

Everything rests on one row per customer and day.  That grain is reached by a
map-side combined aggregate, so a customer holding a third of all transactions
is spread over its days before anything is keyed by customer, and later groups
are bounded by the calendar (31 days per month, the days of the history per
customer) and not by the number of transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_number, month_of, year_month
from .asof import ASOF_MEASURES, customer_days


def daily_balance_range(df: DataFrame, key="id", date="dt", balance="balance") -> DataFrame:
    """Highest and lowest known balance per customer and day."""
    return (
        df.where(F.col(balance).isNotNull() & F.col(date).isNotNull())
        .groupBy(key, date)
        .agg(F.max(balance).alias("high"), F.min(balance).alias("low"))
        .withColumn("month", month_of(F.col(date)))
    )


def _with_peak(daily: DataFrame, key: str, date: str) -> DataFrame:
    """Add the month's highest balance and the earliest day it was held.

    Undated days and days without a balance sort last, so they are a peak only
    in a month that has nothing else.
    """
    dated_high = F.when(F.col(date).isNotNull(), F.col("high"))
    ranked = Window.partitionBy(key, "month").orderBy(F.desc_nulls_last(dated_high), F.asc(date))
    return daily.withColumns(
        {
            "peak_balance": F.first(dated_high).over(ranked),
            "peak_date": F.first(F.when(dated_high.isNotNull(), F.col(date))).over(ranked),
        }
    )


def monthly_peak(df: DataFrame, key="id", date="dt", balance="balance") -> DataFrame:
    """Highest balance per customer and month, with the earliest date it was held.

    Rows are first combined per day, which keeps the large aggregate one by hash.
    """
    daily = (
        df.where(F.col(balance).isNotNull() & F.col(date).isNotNull())
        .groupBy(key, day_number(F.col(date)).alias("day"))
        .agg(F.max(balance).alias("balance"))
    )
    month = month_of(F.date_from_unix_date(F.col("day").cast("int")))
    best = F.max(F.struct(F.col("balance"), (-F.col("day")).alias("minus_day")))
    return (
        daily.groupBy(key, month.alias("month"))
        .agg(best.alias("peak"))
        .select(
            key,
            year_month(F.col("month")).alias("year_month"),
            F.date_from_unix_date((-F.col("peak.minus_day")).cast("int")).alias("peak_date"),
            F.col("peak.balance").alias("peak_balance"),
        )
    )


def monthly_drawdown(df: DataFrame, key="id", date="dt", balance="balance") -> DataFrame:
    """Fall per day from the month's peak balance to the lowest balance after it.

    One row per customer and month; months whose low falls on the peak day are
    left out.  Ties go to the earliest day.  Rows with a null balance take no
    part, so imputed balances should be nulled by the caller if they must not
    count (see ``observed_balance``).
    """
    lowest = F.min(F.struct(F.col("low").alias("balance"), F.col(date).alias("at")))
    return (
        _with_peak(daily_balance_range(df, key, date, balance), key, date)
        .where(F.col(date) >= F.col("peak_date"))
        .groupBy(key, "month")
        .agg(
            F.first("peak_date").alias("peak_date"),
            F.first("peak_balance").alias("peak_balance"),
            lowest.alias("trough"),
        )
        .select(
            key,
            year_month(F.col("month")).alias("year_month"),
            "peak_date",
            "peak_balance",
            F.col("trough.at").alias("trough_date"),
            F.col("trough.balance").alias("trough_balance"),
            F.datediff(F.col("trough.at"), F.col("peak_date")).alias("days_between"),
        )
        .where(F.col("days_between") > 0)
        .withColumn(
            "drawdown_per_day",
            (F.col("peak_balance") - F.col("trough_balance")) / F.col("days_between"),
        )
    )


def observed_balance(balance="balance", flag="balance_missing") -> Column:
    """The balance, or null where it was filled in by imputation."""
    return F.when(F.col(flag) == 0, F.col(balance))


def drawdown_per_customer(df: DataFrame, key="id", date="dt", balance="balance") -> DataFrame:
    """Mean monthly drawdown of each customer that has one."""
    return (
        monthly_drawdown(df, key, date, balance)
        .groupBy(key)
        .agg(F.avg("drawdown_per_day").alias("drawdown_per_day"))
    )


def drawdown_trend(df: DataFrame, key="id", date="dt", balance="balance") -> DataFrame:
    """Mean drawdown of all customers per month, in month order."""
    return (
        monthly_drawdown(df, key, date, balance)
        .groupBy("year_month")
        .agg(F.avg("drawdown_per_day").alias("avg_drawdown_per_day"))
        .orderBy("year_month")
    )


def balance_profile(df: DataFrame, key="id", balance="balance") -> DataFrame:
    """Mean, sample deviation and row count of the balance per customer."""
    return df.groupBy(key).agg(
        F.avg(balance).alias("avg_balance"),
        F.stddev_samp(balance).alias("balance_std"),
        F.count("*").alias("total_transactions_count"),
    )


def monthly_net_flow(df: DataFrame, key="id", date="dt", amount="amount") -> DataFrame:
    """Mean over the months with rows of each customer's net amount per month."""
    return (
        df.groupBy(key, month_of(F.col(date)).alias("month"))
        .agg(F.sum(amount).alias("net"))
        .groupBy(key)
        .agg(F.avg("net").alias("net_cash_flow"))
    )


def low_balance_count(df: DataFrame, threshold: float, key="id", balance="balance") -> DataFrame:
    """Rows strictly below the threshold per customer."""
    return df.groupBy(key).agg(F.count_if(F.col(balance) < F.lit(threshold)).alias("low_balance_frequency"))


def activity_profile(
    df: DataFrame,
    low_balance_threshold: float,
    key="id",
    date="dt",
    amount="amount",
    balance="balance",
    peak_balance: Column | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """All per-customer activity measures from one scan.

    Two shuffles: one to (customer, day), one to customer, where one sort serves
    all windows (``customer_days``).  The deviation is merged from daily counts,
    means and squared deviations, measured around the first day's mean so that
    no large squares are subtracted.  ``peak_balance`` is the balance drawdown
    looks at (default: ``balance``).  ``days`` is the result of ``customer_days``
    for the same arguments, where a caller has it; applications make no difference.
    """
    if days is None:
        days = customer_days(
            df, low_balance_threshold, None, key, date, date, amount, balance, peak_balance
        )
    return days.where(F.col("whole").isNotNull()).select(
        F.col("owner").alias(key), *[f"whole.{n}" for n in ASOF_MEASURES]
    )


def serving_profile(df: DataFrame, key="id", date="dt", amount="amount", balance="balance") -> DataFrame:
    """Counts and totals by direction, balance statistics, rows per active month.

    The distinct month makes Spark combine per (customer, month) first, so one
    customer's rows are spread over its months before they meet.
    """
    flow = F.col(amount)
    return (
        df.groupBy(key)
        .agg(
            F.count("*").alias("txn_count"),
            F.count_if(flow > 0).alias("inflow_count"),
            F.count_if(flow < 0).alias("outflow_count"),
            F.coalesce(F.sum(F.when(flow > 0, flow)), F.lit(0.0)).alias("total_inflow"),
            F.coalesce(F.sum(F.when(flow < 0, -flow)), F.lit(0.0)).alias("total_outflow"),
            F.avg(balance).alias("avg_balance"),
            F.min(balance).alias("min_balance"),
            F.stddev_samp(balance).alias("std_balance"),
            F.count_distinct(month_of(F.col(date))).alias("months"),
        )
        .withColumn("txn_per_month", F.try_divide(F.col("txn_count"), F.col("months")))
        .withColumn("net_cashflow", F.col("total_inflow") - F.col("total_outflow"))
        .drop("months")
    )
