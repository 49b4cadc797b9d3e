"""The view that scoring requests are answered from: one row of features per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as fixed
from ..operators import activity

COUNTS = ("txn_count", "inflow_count", "outflow_count", "total_loans", "num_declined")
AMOUNTS = (
    "total_inflow",
    "total_outflow",
    "net_cashflow",
    "avg_balance",
    "min_balance",
    "std_balance",
    "txn_per_month",
    "max_loan_amount",
    "mean_loan_amount",
)


def loan_profile(
    applications: DataFrame, key="id", amount="amount", outcome="outcome", declined=fixed.DECLINED
) -> DataFrame:
    """Applications, declined ones, largest and mean amount per customer; one combined shuffle."""
    return applications.groupBy(key).agg(
        F.count("*").alias("total_loans"),
        F.count_if(F.col(outcome) == declined).alias("num_declined"),
        F.max(amount).alias("max_loan_amount"),
        F.avg(amount).alias("mean_loan_amount"),
    )


def serving_view(customers: DataFrame, applications: DataFrame, transactions: DataFrame, key="id") -> DataFrame:
    """Every customer with what a scoring request needs, complete even without any history.

    Counts and amounts of customers without transactions or applications are
    zero.  An age outside the valid range is null, gender is normalised, and the
    balance is set against a month's income (against one where income is zero).
    Both histories are combined per customer before they are joined, so the
    joins see at most one row of each side per customer; rows without a customer
    meet nobody.
    """
    people = customers.withColumns(
        {"gender": C.normalize_category(F.col("gender")), "age": C.null_outside(F.col("age"))}
    )
    joined = people.join(activity.serving_profile(transactions, key), key, "left").join(
        loan_profile(applications, key), key, "left"
    )
    filled = joined.fillna(0, list(COUNTS)).fillna(0.0, list(AMOUNTS))
    return filled.withColumn(
        "balance_to_income_ratio", C.guarded_ratio(F.col("avg_balance"), F.col("income") / 12)
    )
