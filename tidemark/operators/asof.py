"""Activity measures as they stood before each application, and of the whole history.

Nothing dated on or after an application's day enters its measures.  The states
that are carried along a customer's days can be merged: moments as count, mean
and squared deviation, a month's drawdown as the highest balance so far and the
lowest one after it.  All of it rests on one row per customer and day, and the
windows walk days, so a customer with a third of all transactions costs as many
rows as the calendar has days.  Every window walks them in the same order, so
the days are placed and sorted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_number

ASOF_MEASURES = (
    "avg_balance",
    "balance_std",
    "total_transactions_count",
    "net_cash_flow",
    "low_balance_frequency",
    "drawdown_per_day",
)


#: Day and month of transactions without a date: after all others.
UNDATED = 2**31 - 1


def daily_states(
    transactions: DataFrame,
    low_balance_threshold: float,
    key: str,
    date: str,
    amount: str,
    balance: str,
    held: Column,
    applications: DataFrame | None = None,
    asked_date: str | None = None,
) -> DataFrame:
    """What a customer's day adds: counts, sums, moments and the range of balances that drawdown looks at.

    Days on which the customer applied are marked ``asked``, also where nothing was moved.
    """
    rows = transactions.select(
        F.col(key).alias("owner"),
        F.coalesce(F.when(F.col(date).isNotNull(), day_number(F.col(date))), F.lit(UNDATED)).alias("day"),
        F.col(amount).alias("amount"),
        F.col(balance).alias("balance"),
        held.alias("held"),
        F.lit(False).alias("asked"),
    )
    if applications is not None:
        asked = applications.where(F.col(key).isNotNull() & F.col(asked_date).isNotNull()).select(
            F.col(key).alias("owner"), day_number(F.col(asked_date)).alias("day"), F.lit(True).alias("asked")
        )
        rows = rows.unionByName(asked, allowMissingColumns=True)
    at = F.date_from_unix_date(F.col("day"))
    return (
        rows.groupBy("owner", "day")
        .agg(
            F.count_if(~F.col("asked")).alias("rows"),
            F.sum("amount").alias("net"),
            F.count("balance").alias("known"),
            F.avg("balance").alias("mean"),
            F.var_pop("balance").alias("spread"),
            F.count_if(F.col("balance") < F.lit(low_balance_threshold)).alias("low_rows"),
            F.max("held").alias("high"),
            F.min("held").alias("low"),
            F.max("asked").alias("asked"),
        )
        .withColumn("month", F.when(F.col("day") < UNDATED, F.year(at) * 12 + F.month(at)).otherwise(UNDATED))
    )


def customer_days(
    transactions: DataFrame,
    low_balance_threshold: float,
    applications: DataFrame | None = None,
    key="id",
    date="dt",
    tx_date="dt",
    amount="amount",
    balance="balance",
    peak_balance: Column | None = None,
) -> DataFrame:
    """The measures on the days on which customers applied, and of whole histories, from one walk.

    Returns ``owner``, ``day`` and two structs of :data:`ASOF_MEASURES`: ``found``
    holds them as of the day's start, on days with applications; ``whole`` holds
    those of all the customer's transactions, on the customer's last row.
    """
    held = F.col(balance) if peak_balance is None else peak_balance
    daily = daily_states(
        transactions, low_balance_threshold, key, tx_date, amount, balance, held, applications, date
    ).repartition("owner")
    walk = Window.partitionBy("owner").orderBy("month", "day")
    so_far = walk.rowsBetween(Window.unboundedPreceding, 0)
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    day, month, rows, net = F.col("day"), F.col("month"), F.col("rows"), F.col("net")
    dated = day < UNDATED

    # the highest balance of the latest month that has one, at its earliest day
    peak = F.struct(month.alias("month"), F.col("high").alias("balance"), (-day).alias("minus_day"))
    placed = daily.withColumns(
        {
            "peak": F.max(F.when(F.col("high").isNotNull() & dated, peak)).over(so_far),
            # squares are taken around the first day's mean, so that no large ones are subtracted
            "centre": F.first("mean", ignorenulls=True).over(so_far),
            "month_before": F.max(F.when(rows > 0, month)).over(before),
            "paid_before": F.max(F.when(net.isNotNull(), month)).over(before),
            "next_month": F.lead("month").over(walk),
        }
    )
    # a new peak starts over: its day is the latest, so what was low before it no longer counts
    trough = F.struct(F.col("peak.minus_day").alias("minus_day"), F.col("low").alias("balance"), day.alias("day"))
    away = F.col("mean") - F.col("centre")
    own = {
        "rows": rows,
        "low_rows": F.col("low_rows"),
        "net": net,
        "months": F.when((rows > 0) & ~month.eqNullSafe(F.col("month_before")), 1),
        "paid_months": F.when(net.isNotNull() & ~month.eqNullSafe(F.col("paid_before")), 1),
        "known": F.col("known"),
        "first_moment": F.col("known") * away,
        "second_moment": F.col("known") * (F.col("spread") + away * away),
    }
    placed = placed.select(
        "owner", "day", "month", "asked", "peak", "centre", "next_month",
        F.min(F.when(F.col("low").isNotNull() & dated, trough)).over(so_far).alias("trough"),
        *[e.alias(f"own_{n}") for n, e in own.items()],
        *[F.sum(e).over(before).alias(f"past_{n}") for n, e in own.items()],
    )
    sums = [f"{side}_{n}" for n in own for side in ("own", "past")]
    days = F.col("trough.day") + F.col("peak.minus_day")
    fall = F.when(
        (F.col("peak.month") == month) & (days > 0), (F.col("peak.balance") - F.col("trough.balance")) / days
    )
    ended = F.when(F.col("next_month").isNull() | (F.col("next_month") != month), F.col("fall"))
    seen = placed.withColumn("fall", fall).select(
        "owner", "day", "asked", "centre", *sums,
        F.col("next_month").isNull().alias("last"),
        F.sum(ended).over(before).alias("falls"),
        F.count(ended).over(before).alias("fallen"),
        F.when(F.lag("month").over(walk) == month, F.lag("fall").over(walk)).alias("fall_before"),
        "fall",
    )

    def measures(sums: dict[str, Column], months: str, last_fall: Column) -> Column:
        known, first = F.nullif(sums["known"], F.lit(0)), sums["first_moment"]
        squares = F.greatest(sums["second_moment"] - first * first / known, F.lit(0.0))
        fallen = F.col("fallen") + last_fall.isNotNull().cast("int")
        found = {
            "avg_balance": F.col("centre") + first / known,
            "balance_std": F.when(known > 1, F.sqrt(squares / (known - 1))),
            "total_transactions_count": F.coalesce(sums["rows"], F.lit(0)),
            "net_cash_flow": sums["net"] / sums[months],
            "low_balance_frequency": F.coalesce(sums["low_rows"], F.lit(0)),
            "drawdown_per_day": F.when(
                fallen > 0, (F.coalesce("falls", F.lit(0.0)) + F.coalesce(last_fall, F.lit(0.0))) / fallen
            ),
        }
        return F.struct(*[e.alias(n) for n, e in found.items()])

    def both(name: str) -> Column:
        # the sum of what is known of the two
        past, here = F.col(f"past_{name}"), F.col(f"own_{name}")
        return F.coalesce(past + here, past, here)

    past = {n: F.col(f"past_{n}") for n in own}
    whole = {n: both(n) for n in own}
    return (
        seen.where(F.col("asked") | F.col("last"))
        .select(
            "owner",
            "day",
            F.when(F.col("asked"), measures(past, "months", F.col("fall_before"))).alias("found"),
            F.when(F.col("last") & (whole["rows"] > 0), measures(whole, "paid_months", F.col("fall"))).alias("whole"),
        )
    )


def asof_activity_profile(
    applications: DataFrame,
    transactions: DataFrame,
    low_balance_threshold: float,
    key="id",
    date="dt",
    tx_date="dt",
    amount="amount",
    balance="balance",
    peak_balance: Column | None = None,
    days: DataFrame | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """Each application with the customer's activity on the days before it.

    Adds :data:`ASOF_MEASURES`, defined as in ``activity_profile`` over the
    transactions dated strictly earlier.  The month of the application counts as
    far as it has come.  An application without a date or a customer knows
    nothing, nor does it see undated transactions: counts are 0, the others null.
    ``days`` is the result of :func:`customer_days` for the same arguments, where
    a caller has it.  ``day_column`` is dropped; it holds the day's number, by
    which and the customer the caller has placed the applications already.
    """
    if days is None:
        days = customer_days(
            transactions, low_balance_threshold, applications, key, date, tx_date, amount, balance, peak_balance
        )
    found = days.where(F.col("found").isNotNull()).select("owner", "day", "found")
    kept = [c for c in applications.columns if c not in (*ASOF_MEASURES, day_column)]
    day = F.col(day_column) if day_column else F.when(F.col(date).isNotNull(), day_number(F.col(date)))
    rows = applications.select(F.struct(*kept).alias("row"), F.col(key).alias("owner"), day.alias("day"))
    counts = ("total_transactions_count", "low_balance_frequency")
    return rows.join(found, ["owner", "day"], "left").select(
        "row.*", *[(F.coalesce(f"found.{n}", F.lit(0)) if n in counts else F.col(f"found.{n}")).alias(n) for n in ASOF_MEASURES]
    )
