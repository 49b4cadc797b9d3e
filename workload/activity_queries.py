"""Balances, flows, drawdown, histories and the two feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import activity, charts, cleaning, history, quality, sampling, sketches
from tidemark.operators.quantiles import approx_quantile_table, exact_quantiles, quantile_table
from tidemark.plans import customer as plans

from .registry import query, r, rounded
from .views import AS_OF, raw_applications, raw_customers, raw_transactions, staged_transactions, table, using


@query(
    "balance_profile",
    using(
        "raw_transactions",
        f"SELECT id, {r('avg(balance)')} AS avg_balance, {r('stddev_samp(balance)')} AS balance_std, "
        "count(*) AS total_transactions_count FROM raw_transactions GROUP BY id",
    ),
)
def balance_profile(spark, folder):
    return rounded(activity.balance_profile(raw_transactions(spark, folder)), ["avg_balance", "balance_std"])


@query(
    "application_profile",
    using(
        "applied",
        "SELECT id, n AS total_applications, won AS successful_applications, max_amount, "
        "max_won AS max_accepted_amount, last_dt AS last_application_date FROM applied",
    ),
)
def application_profile(spark, folder):
    return history.application_profile(raw_applications(spark, folder))


@query(
    "monthly_net_flow",
    using(
        "raw_transactions",
        f"""SELECT id, {r('avg(net)')} AS net_cash_flow
            FROM (SELECT id, strftime(dt, '%Y-%m') AS ym, sum(amount) AS net FROM raw_transactions GROUP BY 1, 2)
            GROUP BY id""",
    ),
)
def monthly_net_flow(spark, folder):
    return rounded(activity.monthly_net_flow(raw_transactions(spark, folder)), ["net_cash_flow"])


@query(
    "low_balance_count",
    using(
        "thresholds",
        "SELECT id, count(*) FILTER (balance < (SELECT low_balance FROM thresholds)) AS low_balance_frequency "
        "FROM transactions GROUP BY id",
    ),
)
def low_balance_count(spark, folder):
    moves = cleaning.clean_transactions(staged_transactions(spark, folder))
    positive = moves.select(F.when(F.col("balance") > 0, F.col("balance")).alias("x"))
    threshold = exact_quantiles(positive, {"x": [0.1]})["x"][0]
    return activity.low_balance_count(moves, threshold)


@query("monthly_peak", using("peaks", "SELECT * FROM peaks"))
def monthly_peak(spark, folder):
    return activity.monthly_peak(raw_transactions(spark, folder))


@query(
    "monthly_drawdown",
    using(
        "falls",
        "SELECT id, year_month, peak_date, peak_balance, trough_date, trough_balance, "
        f"CAST(days_between AS INTEGER) AS days_between, {r('drawdown_per_day')} AS drawdown_per_day FROM falls",
    ),
)
def monthly_drawdown(spark, folder):
    return rounded(activity.monthly_drawdown(raw_transactions(spark, folder)), ["drawdown_per_day"])


@query(
    "drawdown_per_customer",
    using("falls", f"SELECT id, {r('avg(drawdown_per_day)')} AS drawdown_per_day FROM falls GROUP BY id"),
)
def drawdown_per_customer(spark, folder):
    return rounded(activity.drawdown_per_customer(raw_transactions(spark, folder)), ["drawdown_per_day"])


@query(
    "drawdown_trend",
    using(
        "falls",
        f"SELECT year_month, {r('avg(drawdown_per_day)')} AS avg_drawdown_per_day FROM falls "
        "GROUP BY year_month ORDER BY year_month",
    ),
)
def drawdown_trend(spark, folder):
    return rounded(activity.drawdown_trend(raw_transactions(spark, folder)), ["avg_drawdown_per_day"])


@query(
    "top_n",
    using(
        "falls",
        f"""SELECT *, row_number() OVER (ORDER BY drawdown_per_day DESC, id) AS rank
            FROM (SELECT id, {r('avg(drawdown_per_day)')} AS drawdown_per_day FROM falls GROUP BY id)
            ORDER BY drawdown_per_day DESC, id LIMIT 15""",
    ),
)
def top_n(spark, folder):
    return charts.top_n(drawdown_per_customer(spark, folder), "drawdown_per_day", "id")


_HISTORY = (
    "id, app_id, dt, amount, outcome, prior_applications, CAST(prior_successes AS BIGINT) AS prior_successes, "
    "prior_max_amount, "
    + r("CASE WHEN prior_applications > 0 THEN prior_successes / prior_applications ELSE -1.0 END")
    + " AS prior_success_rate, target"
)


@query("application_history", using("histories", f"SELECT {_HISTORY} FROM histories"))
def application_history(spark, folder):
    return rounded(history.application_history(raw_applications(spark, folder)), ["prior_success_rate"])


@query("application_history_strict", using("strict_histories", f"SELECT {_HISTORY} FROM strict_histories"))
def application_history_strict(spark, folder):
    found = history.application_history(raw_applications(spark, folder), strict=True)
    return rounded(found, ["prior_success_rate"])


@query(
    "asof_balance_features",
    using(
        "raw_applications raw_transactions",
        f"""SELECT a.app_id, count(t.id) AS asof_transactions,
                   {r('coalesce(sum(t.amount), 0.0)', 3)} AS asof_net_flow,
                   {r('avg(t.balance)')} AS asof_avg_balance, min(t.balance) AS asof_min_balance
            FROM raw_applications a LEFT JOIN raw_transactions t ON t.id = a.id AND t.dt < a.dt
            GROUP BY a.app_id""",
    ),
)
def asof_balance_features(spark, folder):
    found = history.asof_balance_features(raw_applications(spark, folder), raw_transactions(spark, folder))
    columns = ["app_id", "asof_transactions", "asof_net_flow", "asof_avg_balance", "asof_min_balance"]
    return rounded(found.select(*columns), {"asof_net_flow": 3, "asof_avg_balance": 6})


_KPI_DIGITS = {
    "avg_balance": 6,
    "balance_std": 6,
    "net_cash_flow": 6,
    "drawdown_per_day": 6,
    "balance_to_income_ratio": 6,
    "balance_volatility_index": 6,
    "acceptance_rate": 6,
    "credit_capacity_to_income": 6,
}
KPI_SQL = (
    "SELECT t.* REPLACE ("
    + ", ".join(f"{r(c, d)} AS {c}" for c, d in _KPI_DIGITS.items())
    + ", CAST(application_recency_days AS INTEGER) AS application_recency_days"
    + ") FROM (SELECT * EXCLUDE (stage, income_median) FROM customer_table) t"
)


def prepared_tables(spark, folder):
    """Cleaned customers, applications and transactions, thresholds, customer table."""
    people, moves, thresholds = cleaning.clean_with_thresholds(raw_customers(spark, folder), staged_transactions(spark, folder))
    asked = cleaning.clean_applications(raw_applications(spark, folder))
    features = plans.customer_features(people, asked, moves, thresholds, AS_OF)
    return people, asked, moves, features


@query("customer_kpis", using("customer_table", KPI_SQL))
def customer_kpis(spark, folder):
    return rounded(prepared_tables(spark, folder)[3], _KPI_DIGITS)


@query("action_quadrant", using("customer_table", "SELECT id, customer_segment, action_quadrant FROM customer_table"))
def action_quadrant(spark, folder):
    return prepared_tables(spark, folder)[3].select("id", "customer_segment", "action_quadrant")


_STATIC = [
    "gender", "age", "income", "avg_balance", "balance_std", "total_transactions_count", "net_cash_flow",
    "balance_to_income_ratio", "balance_volatility_index", "low_balance_frequency", "drawdown_per_day",
    "flag_seg_young_lowincome", "flag_seg_midage_highincome", "flag_seg_senior_stable",
    "flag_seg_young_highincome", "flag_seg_midage_lowincome",
]


@query(
    "application_features",
    using(
        "customer_table strict_histories",
        f"SELECT {_HISTORY.replace('id, app_id, dt, amount,', 'h.id, app_id, dt, amount AS requested_amount,')}, "
        + ", ".join(r(f"c.{c}", _KPI_DIGITS[c]) + f" AS {c}" if c in _KPI_DIGITS else f"c.{c}" for c in _STATIC)
        + " FROM strict_histories h LEFT JOIN customer_table c ON c.id = h.id",
    ),
)
def application_features(spark, folder):
    _, asked, _, features = prepared_tables(spark, folder)
    digits = {c: d for c, d in _KPI_DIGITS.items() if c in _STATIC} | {"prior_success_rate": 6}
    return rounded(plans.application_features(asked, features), digits)


_ASOF = [
    "total_transactions_count", "avg_balance", "balance_std", "net_cash_flow", "low_balance_frequency",
    "drawdown_per_day", "balance_to_income_ratio", "balance_volatility_index",
]


def _rounded_columns(columns, source):
    return ", ".join(r(f"{source}.{c}", _KPI_DIGITS[c]) + f" AS {c}" if c in _KPI_DIGITS else f"{source}.{c}" for c in columns)


@query("asof_customer_kpis", using("asof_kpis", f"SELECT app_id, {_rounded_columns(_ASOF, 'k')} FROM asof_kpis k"))
def asof_customer_kpis(spark, folder):
    people, moves, thresholds = cleaning.clean_with_thresholds(raw_customers(spark, folder), staged_transactions(spark, folder))
    low = thresholds["low_balance_threshold"]
    found = plans.asof_customer_kpis(raw_applications(spark, folder), people, moves, low)
    return rounded(found.select("app_id", *_ASOF), {c: d for c, d in _KPI_DIGITS.items() if c in _ASOF})


@query(
    "application_features_asof",
    using(
        "customer_table strict_histories asof_kpis",
        f"SELECT {_HISTORY.replace('id, app_id, dt, amount,', 'h.id, h.app_id, dt, amount AS requested_amount,')}, "
        + ", ".join([_rounded_columns([c], "k" if c in _ASOF else "c") for c in _STATIC])
        + " FROM strict_histories h LEFT JOIN customer_table c ON c.id = h.id LEFT JOIN asof_kpis k ON k.app_id = h.app_id",
    ),
)
def application_features_asof(spark, folder):
    people, moves, thresholds = cleaning.clean_with_thresholds(raw_customers(spark, folder), staged_transactions(spark, folder))
    asked = cleaning.clean_applications(raw_applications(spark, folder))
    low = quality.empirical_thresholds(moves, people)["low_balance_threshold"]
    days = plans.known_days(asked, moves, low)
    features = plans.customer_features(people, asked, moves, thresholds, AS_OF, days=days)
    digits = {c: d for c, d in _KPI_DIGITS.items() if c in _STATIC} | {"prior_success_rate": 6}
    return rounded(plans.application_features(asked, features, transactions=moves, low_balance_threshold=low, days=days), digits)


_LEVELS = {"l_extendedprice": [0.01, 0.1, 0.5, 0.9, 0.99], "l_quantity": [0.25, 0.5, 0.75]}


def _quantile_sql(levels):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS level, "
        f"CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM lineitem"
        for c, ps in levels.items()
        for p in ps
    )


@query("quantiles_exact", _quantile_sql({"l_extendedprice": _LEVELS["l_extendedprice"]}))
def quantiles_exact(spark, folder):
    return quantile_table(table(spark, folder, "lineitem"), {"l_extendedprice": _LEVELS["l_extendedprice"]})


@query("quantiles_multi", _quantile_sql(_LEVELS))
def quantiles_multi(spark, folder):
    return quantile_table(table(spark, folder, "lineitem"), _LEVELS)


@query("quantiles_approx")
def quantiles_approx(spark, folder):
    return approx_quantile_table(table(spark, folder, "lineitem"), _LEVELS)


_SKETCH_BOUND = repr(round(sketches.rank_bound(), 9))


@query(
    "sketched_quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS level, count({c}) AS n, CAST({_SKETCH_BOUND} AS DOUBLE) AS bound, "
        "true AS within_bound FROM lineitem"
        for c, ps in _LEVELS.items()
        for p in ps
    ),
)
def sketched_quantiles(spark, folder):
    """Quantiles from one sketch a day, merged, and whether their ranks keep to the promised error."""
    lines = table(spark, folder, "lineitem")
    daily = sketches.sketch_table(lines, list(_LEVELS), [F.to_date("l_shipdate").alias("day")])
    found = sketches.rank_errors(lines, sketches.sketched_quantiles(daily, _LEVELS))
    return found.select(
        "column_name", "level", "n", F.round(F.lit(sketches.rank_bound()), 9).alias("bound"),
        (F.col("rank_error") <= sketches.rank_bound()).alias("within_bound"),
    )


_SAMPLE_HASH = "CAST('0x' || substr(md5(l_orderkey || ':' || l_linenumber || ':42'), 1, 13) AS BIGINT)"


@query(
    "hash_sample",
    f"""SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber
        FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus
                                           ORDER BY {_SAMPLE_HASH}, l_orderkey || ':' || l_linenumber) AS rank FROM lineitem)
        WHERE rank <= 500""",
)
def hash_sample(spark, folder):
    """500 line items of every flag and status, the same ones in every run."""
    lines = table(spark, folder, "lineitem")
    key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    found = sampling.hash_sample(lines, 500, key, ["l_returnflag", "l_linestatus"])
    return found.select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber")
