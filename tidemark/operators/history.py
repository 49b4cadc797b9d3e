"""Application history: per-customer totals, and what was known at each application.

Point-in-time histories are running aggregates.  A running window over one
customer's rows would put a customer with a third of all applications into one
task, so rows are first combined per (customer, day), and the window walks days.
Only a day on which one customer has more than ``BLOCK`` applications is cut
further, at quantiles of the tie-break number, so a customer has at most as many
blocks as days and as rows per ``BLOCK``, however sparse the numbers are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.columns import day_number, rate_or_marker
from ..session import durable

BLOCK = 1_000_000
#: Column with the number of an application's day.
DAY = "_day"


def accepted_flag(outcome="outcome", accepted=fixed.ACCEPTED):
    """1 accepted, 0 declined, null while pending."""
    return (F.col(outcome) == accepted).cast("int")


def application_profile(
    df: DataFrame, key="id", date="dt", amount="amount", outcome="outcome", accepted=fixed.ACCEPTED
) -> DataFrame:
    """Applications, acceptances, largest amount (any outcome and accepted), last date."""
    taken = F.col(outcome) == accepted
    return df.groupBy(key).agg(
        F.count("*").alias("total_applications"),
        F.count_if(taken).alias("successful_applications"),
        F.max(amount).alias("max_amount"),
        F.max(F.when(taken, F.col(amount))).alias("max_accepted_amount"),
        F.max(date).alias("last_application_date"),
    )


def application_history(
    df: DataFrame,
    key="id",
    date="dt",
    tiebreak="app_id",
    amount="amount",
    outcome="outcome",
    accepted=fixed.ACCEPTED,
    strict: bool = False,
    attributes: DataFrame | None = None,
    block_rows: int = BLOCK,
    keep_day: bool = False,
) -> DataFrame:
    """Each application with the counts and amounts of the same customer's earlier ones.

    ``strict=False`` orders by date and then by the unique integer ``tiebreak``,
    so an application sees those of the same day with a smaller number; those
    without a date come first.  ``strict=True`` sees earlier days only: an
    application without a date is before none and after none, so what is not
    known to be earlier never enters a history.  Pending applications count as
    applications, not as acceptances.  An application without a customer has no
    history.

    ``attributes`` holds one row per key.  Its columns reach the applications
    together with the offsets: they are joined to the few blocks of a customer,
    which are keyed by customer already, and not to the application rows.  ``keep_day`` adds
    the number of the day, :data:`DAY`, by which and the customer a strict history
    places its rows, so that a next join by them moves nothing.
    """
    hit = F.coalesce(accepted_flag(outcome, accepted), F.lit(0))
    rows = df.withColumns(
        {"_day": day_number(F.col(date)), "_hit": hit, "_won": F.when(hit == 1, F.col(amount))}
    )
    whole = rows.withColumn("_block", F.lit(0))
    if strict:
        rows = whole
        # undated rows have no place in a strict history, and see none, but do have attributes
        dated = F.col("_day") > day_number(F.lit(None).cast("date"))
        blocks = history_blocks(rows, key).withColumns({c: F.when(dated, F.col(c)) for c in ("n", "hits", "won")})
    else:
        # one combination tells both the totals of a day and whether a day must be cut
        blocks = durable(history_blocks(whole, key))
        heavy = (blocks.agg(F.max("n")).first()[0] or 0) > block_rows
        rows = cut_days(rows, key, tiebreak, block_rows, blocks) if heavy else whole
        blocks = history_blocks(rows, key) if heavy else blocks
    offsets = earlier_totals(blocks, key, strict)
    carried = []
    if attributes is not None:
        carried = [c for c in attributes.columns if c != key]
        offsets = offsets.join(attributes, key, "left")
    placed = rows.drop("_block").join(offsets.drop("_block"), [key, "_day"], "left") if strict else rows.join(
        offsets, [key, "_day", "_block"], "left"
    )
    n = F.coalesce("_before_n", F.lit(0))
    hits = F.coalesce("_before_hits", F.lit(0))
    won = F.col("_before_won")
    if not strict:
        inside = (
            Window.partitionBy(key, "_day", "_block")
            .orderBy(tiebreak)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        owned = F.when(F.col(key).isNotNull(), 1)
        n = n + F.count(owned).over(inside)
        hits = hits + F.coalesce(F.sum(owned * F.col("_hit")).over(inside), F.lit(0))
        won = F.greatest(won, F.max(owned * F.col("_won")).over(inside))
    history = placed.select(
        *df.columns,
        *([DAY] if keep_day else []),
        n.alias("prior_applications"),
        hits.alias("prior_successes"),
        F.coalesce(won, F.lit(0.0)).alias("prior_max_amount"),
        *carried,
    )
    return history.withColumns(
        {
            "prior_success_rate": rate_or_marker(F.col("prior_successes"), F.col("prior_applications")),
            "target": accepted_flag(outcome, accepted),
        }
    )


def cut_days(rows: DataFrame, key: str, tiebreak: str, block_rows: int, days: DataFrame | None = None) -> DataFrame:
    """Add ``_block``: 0, or for a customer's day of more than ``block_rows`` rows a range of numbers.

    ``days`` holds the rows ``n`` per customer and day, if they are known.  The
    cuts are approximate quantiles of the numbers; only balance depends on them.
    """
    if days is None:
        days = rows.groupBy(key, "_day").agg(F.count("*").alias("n"))
    heavy = durable(days.where(F.col("n") > block_rows).select(key, "_day", F.col("n").alias("_n")))
    most = heavy.agg(F.max("_n")).first()[0]
    if most is None:
        return rows.withColumn("_block", F.lit(0))
    pieces = -(-most // block_rows)
    levels = [i / pieces for i in range(1, pieces)]
    cuts = durable(
        rows.join(heavy, [key, "_day"])
        .groupBy(key, "_day")
        .agg(
            F.percentile_approx(tiebreak, levels, max(10_000, 10 * pieces)).alias("_cuts"),
            F.ceil(F.max("_n") / block_rows).alias("_own"),
        )
    )
    below = F.size(F.filter("_cuts", lambda c: c < F.col(tiebreak)))
    block = F.floor(below * F.col("_own") / pieces).cast("int")
    return rows.join(cuts, [key, "_day"], "left").withColumn(
        "_block", F.when(F.col("_cuts").isNull(), 0).otherwise(block)
    ).drop("_cuts", "_own")


def history_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Totals per customer, day and block, combined before they move."""
    return rows.groupBy(key, "_day", "_block").agg(
        F.count("*").alias("n"), F.sum("_hit").alias("hits"), F.max("_won").alias("won")
    )


def earlier_totals(blocks: DataFrame, key: str, strict: bool) -> DataFrame:
    """What a customer's earlier blocks (or days, if ``strict``) hold."""
    place = Window.partitionBy(key)
    if strict:
        earlier = place.orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    else:
        earlier = place.orderBy("_day", "_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        key,
        "_day",
        "_block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before_n"),
        F.coalesce(F.sum("hits").over(earlier), F.lit(0)).alias("_before_hits"),
        F.max("won").over(earlier).alias("_before_won"),
    )


def asof_balance_features(
    applications: DataFrame,
    transactions: DataFrame,
    key="id",
    date="dt",
    tx_date="dt",
    amount="amount",
    balance="balance",
) -> DataFrame:
    """Each application with the customer's transactions dated strictly before it.

    Transactions are combined per customer and day and laid on one timeline with
    the days on which the customer applied.  The running window walks days, not
    rows, and its result is joined back by customer and day.
    """
    dated = transactions.where(F.col(tx_date).isNotNull())
    daily = dated.groupBy(key, day_number(F.col(tx_date)).alias("_day")).agg(
        F.count("*").alias("n"),
        F.sum(amount).alias("net"),
        F.count(balance).alias("known"),
        F.sum(balance).alias("held"),
        F.min(balance).alias("low"),
    )
    asked = applications.select(key, day_number(F.col(date)).alias("_day")).distinct()
    timeline = daily.withColumn("asked", F.lit(False)).unionByName(
        asked.withColumn("asked", F.lit(True)), allowMissingColumns=True
    )
    before = Window.partitionBy(key).orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    known = F.sum("known").over(before)
    seen = (
        timeline.select(
            key,
            "_day",
            "asked",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("asof_transactions"),
            F.coalesce(F.sum("net").over(before), F.lit(0.0)).alias("asof_net_flow"),
            (F.sum("held").over(before) / F.nullif(known, F.lit(0))).alias("asof_avg_balance"),
            F.min("low").over(before).alias("asof_min_balance"),
        )
        .where("asked")
        .drop("asked")
    )
    asking = applications.withColumn("_day", day_number(F.col(date)))
    return asking.join(seen, [key, "_day"], "left").drop("_day")
