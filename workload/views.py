"""The given tables seen as customers, applications, transactions and requests.

The expressions run unchanged in Spark SQL and in the oracle's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import durable

AS_OF = "2002-01-01"
REQUESTS_AS_OF = "2024-02-01 00:00:00"

CUSTOMER_COLUMNS = [
    "cast(c_custkey as varchar(20)) as id",
    "case c_mktsegment when 'AUTOMOBILE' then 'FEMALE' when 'BUILDING' then '  male ' "
    "when 'FURNITURE' then 'f' when 'HOUSEHOLD' then 'M' else null end as gender",
    "cast(case when c_custkey % 97 = 0 then 999 when c_custkey % 53 = 0 then null "
    "else 18 + c_custkey % 60 end as double) as age",
    "case when c_acctbal < 0 then null else c_acctbal end as income",
]
# Every order is an application.  Those of every seventh customer are the next
# customer's, so that some customers never applied.
APPLICATION_COLUMNS = [
    "cast(case when o_custkey % 7 = 0 then o_custkey + 1 else o_custkey end as varchar(20)) as id",
    "o_orderkey as app_id",
    "cast(o_orderdate as date) as dt",
    "o_totalprice as amount",
    "case o_orderstatus when 'F' then 'TakeUp' when 'O' then 'Declined' else null end as outcome",
]
TRANSACTION_COLUMNS = [
    "cast(o_custkey as varchar(20)) as id",
    "l_orderkey",
    "l_linenumber",
    "cast(l_shipdate as date) as dt",
    "case when l_returnflag = 'R' then l_extendedprice else -l_extendedprice * l_discount end as amount",
    "case when l_quantity = 50 then null else l_extendedprice - 3000 end as balance",
]
REQUEST_COLUMNS = [
    "cast(ts as timestamp) as ts",
    "case when event_type = 'error' then 'error' else 'ok' end as status",
    "value / (1 + value) as score",
    "value / 100 as latency_s",
    "user_id",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*CUSTOMER_COLUMNS)


def raw_applications(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*APPLICATION_COLUMNS)


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    owners = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem")
    return lines.join(owners, lines.l_orderkey == owners.o_orderkey).selectExpr(*TRANSACTION_COLUMNS)


def staged_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions as a table of their own.

    Cleaning and thresholds read single columns of them several times; joining
    line items to orders for each of those reads would cost a shuffle each.
    """
    return durable(raw_transactions(spark, folder))


def raw_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*REQUEST_COLUMNS)


def _select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


# The same views, and the cleaned tables, as SQL.
CTES = {
    "raw_customers": _select(CUSTOMER_COLUMNS, "customer"),
    "raw_applications": _select(APPLICATION_COLUMNS, "orders"),
    "raw_transactions": _select(
        TRANSACTION_COLUMNS, "lineitem JOIN orders ON l_orderkey = o_orderkey"
    ),
    "raw_requests": _select(REQUEST_COLUMNS, "events"),
    "valid_customers": """
        SELECT id,
               CASE WHEN upper(trim(gender)) IN ('FEMALE', 'F') THEN 'Female'
                    WHEN upper(trim(gender)) IN ('MALE', 'M') THEN 'Male' ELSE 'Unknown' END AS gender,
               CASE WHEN age >= 0 AND age <= 120 THEN age END AS age, income
        FROM raw_customers""",
    "customers": """
        SELECT id, gender,
               CAST(trunc(coalesce(age, (SELECT quantile_disc(age, 0.5) FROM valid_customers))) AS INTEGER) AS age,
               coalesce(income, (SELECT quantile_disc(income, 0.5) FROM valid_customers)) AS income
        FROM valid_customers""",
    "transactions": """
        SELECT id, dt, amount, CAST(balance IS NULL AS INTEGER) AS balance_missing,
               balance AS observed,
               coalesce(balance, (SELECT quantile_disc(balance, 0.5) FROM raw_transactions)) AS balance
        FROM raw_transactions""",
    "thresholds": """
        SELECT (SELECT quantile_disc(balance, 0.1) FROM transactions WHERE balance > 0) AS low_balance,
               (SELECT quantile_disc(age, 0.33) FROM customers) AS q33,
               (SELECT quantile_disc(age, 0.66) FROM customers) AS q66,
               (SELECT quantile_disc(income, 0.5) FROM customers) AS income_median""",
    "peaks": """
        SELECT id, strftime(dt, '%Y-%m') AS year_month, dt AS peak_date, balance AS peak_balance
        FROM raw_transactions WHERE balance IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id, strftime(dt, '%Y-%m') ORDER BY balance DESC, dt) = 1""",
    "falls": """
        SELECT id, year_month, peak_date, peak_balance, dt AS trough_date, balance AS trough_balance,
               date_diff('day', peak_date, dt) AS days_between,
               (peak_balance - balance) / date_diff('day', peak_date, dt) AS drawdown_per_day
        FROM (SELECT p.*, t.dt, t.balance,
                     row_number() OVER (PARTITION BY p.id, p.year_month ORDER BY t.balance, t.dt) AS rn
              FROM peaks p JOIN raw_transactions t
                ON t.id = p.id AND strftime(t.dt, '%Y-%m') = p.year_month
               AND t.dt >= p.peak_date AND t.balance IS NOT NULL)
        WHERE rn = 1 AND dt > peak_date""",
    "applied": """
        SELECT id, count(*) AS n, count(*) FILTER (outcome = 'TakeUp') AS won, max(amount) AS max_amount,
               max(amount) FILTER (outcome = 'TakeUp') AS max_won, max(dt) AS last_dt
        FROM raw_applications GROUP BY id""",
    "kpi_base": f"""
        SELECT c.id, c.gender, c.age, c.income,
               coalesce(b.avg_balance, 0.0) AS avg_balance, coalesce(b.balance_std, 0.0) AS balance_std,
               coalesce(b.n, 0) AS total_transactions_count,
               coalesce(a.n, 0) AS total_applications, coalesce(a.won, 0) AS successful_applications,
               a.last_dt AS last_application_date,
               coalesce(f.net, 0.0) AS net_cash_flow,
               coalesce(b.low_n, 0) AS low_balance_frequency,
               coalesce(d.fall, 0.0) AS drawdown_per_day,
               coalesce(a.max_amount, 0.0) AS max_proven_capacity,
               coalesce(a.max_won, 0.0) AS max_accepted_capacity,
               CASE WHEN a.id IS NULL THEN 'Deposit-Only Prospect' ELSE 'Existing Borrower' END AS customer_segment,
               coalesce(b.avg_balance, 0.0) / CASE WHEN c.income = 0 THEN 1.0 ELSE c.income END AS balance_to_income_ratio,
               coalesce(b.balance_std, 0.0) / CASE WHEN coalesce(b.avg_balance, 0.0) = 0 THEN 1.0
                    ELSE b.avg_balance END AS balance_volatility_index,
               CASE WHEN a.n > 0 THEN a.won / a.n ELSE -1.0 END AS acceptance_rate,
               coalesce(date_diff('day', a.last_dt, DATE '{AS_OF}'), 9999) AS application_recency_days,
               coalesce(a.max_amount, 0.0) / CASE WHEN c.income = 0 THEN 1.0 ELSE c.income END AS credit_capacity_to_income
        FROM customers c
        LEFT JOIN (SELECT id, avg(balance) AS avg_balance, stddev_samp(balance) AS balance_std, count(*) AS n,
                          count(*) FILTER (balance < (SELECT low_balance FROM thresholds)) AS low_n
                   FROM transactions GROUP BY id) b ON b.id = c.id
        LEFT JOIN applied a ON a.id = c.id
        LEFT JOIN (SELECT id, avg(net) AS net
                   FROM (SELECT id, strftime(dt, '%Y-%m') AS ym, sum(amount) AS net FROM transactions GROUP BY 1, 2)
                   GROUP BY id) f ON f.id = c.id
        LEFT JOIN (SELECT id, avg(drawdown_per_day) AS fall FROM falls GROUP BY id) d ON d.id = c.id""",
    "kpi_clipped": """
        SELECT k.* REPLACE (
                 CASE WHEN net_cash_flow < lo THEN lo WHEN net_cash_flow > hi THEN hi ELSE net_cash_flow END
                 AS net_cash_flow)
        FROM kpi_base k, (SELECT quantile_disc(net_cash_flow, 0.01) AS lo,
                                 quantile_disc(net_cash_flow, 0.99) AS hi FROM kpi_base)""",
    "customer_table": """
        SELECT k.*,
               CAST(stage = 'Young_LowIncome' AS INTEGER) AS flag_seg_young_lowincome,
               CAST(stage = 'MidAge_HighIncome' AS INTEGER) AS flag_seg_midage_highincome,
               CAST(stage = 'Senior_Stable' AS INTEGER) AS flag_seg_senior_stable,
               CAST(stage = 'Young_HighIncome' AS INTEGER) AS flag_seg_young_highincome,
               CAST(stage = 'MidAge_LowIncome' AS INTEGER) AS flag_seg_midage_lowincome,
               CASE WHEN total_applications = 0 AND income >= income_median THEN 'Segment_C_Untapped_Potential'
                    WHEN balance_volatility_index > 1.2 OR low_balance_frequency > 5
                      OR (total_applications > 0 AND acceptance_rate < 0.70) THEN 'Segment_B_High_Risk'
                    WHEN income >= income_median AND balance_volatility_index <= 1.2 AND net_cash_flow > 0
                     AND (total_applications = 0 OR acceptance_rate >= 0.90) THEN 'Segment_A_Ideal_Target'
                    ELSE 'Segment_D_Seasonal_Borrower' END AS action_quadrant
        FROM (SELECT kpi_clipped.*, income_median,
                     CASE WHEN age <= q33 AND income <= income_median THEN 'Young_LowIncome'
                          WHEN age > q33 AND age <= q66 AND income > income_median THEN 'MidAge_HighIncome'
                          WHEN age > q66 THEN 'Senior_Stable'
                          WHEN age <= q33 AND income > income_median THEN 'Young_HighIncome'
                          ELSE 'MidAge_LowIncome' END AS stage
              FROM kpi_clipped, thresholds) k""",
    "histories": """
        SELECT *, count(*) OVER w AS prior_applications,
               coalesce(sum(CAST(outcome = 'TakeUp' AS INTEGER)) OVER w, 0) AS prior_successes,
               coalesce(max(CASE WHEN outcome = 'TakeUp' THEN amount END) OVER w, 0.0) AS prior_max_amount,
               CAST(outcome = 'TakeUp' AS INTEGER) AS target
        FROM raw_applications
        WINDOW w AS (PARTITION BY id ORDER BY dt, app_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "strict_histories": """
        SELECT *, count(*) OVER w AS prior_applications,
               coalesce(sum(CAST(outcome = 'TakeUp' AS INTEGER)) OVER w, 0) AS prior_successes,
               coalesce(max(CASE WHEN outcome = 'TakeUp' THEN amount END) OVER w, 0.0) AS prior_max_amount,
               CAST(outcome = 'TakeUp' AS INTEGER) AS target
        FROM raw_applications
        WINDOW w AS (PARTITION BY id ORDER BY date_diff('day', DATE '1970-01-01', dt)
                     RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "seen": """
        SELECT a.app_id, strftime(t.dt, '%Y-%m') AS ym, t.dt, t.amount, t.balance, t.observed
        FROM raw_applications a JOIN transactions t ON t.id = a.id AND t.dt < a.dt""",
    "asof_falls": """
        SELECT app_id, avg((peak - observed) / date_diff('day', peak_dt, dt)) AS fall
        FROM (SELECT s.app_id, p.dt AS peak_dt, p.observed AS peak, s.dt, s.observed,
                     row_number() OVER (PARTITION BY s.app_id, s.ym ORDER BY s.observed, s.dt) AS rn
              FROM seen s JOIN (SELECT * FROM seen WHERE observed IS NOT NULL
                                QUALIFY row_number() OVER (PARTITION BY app_id, ym ORDER BY observed DESC, dt) = 1) p
                ON p.app_id = s.app_id AND p.ym = s.ym AND s.dt >= p.dt AND s.observed IS NOT NULL)
        WHERE rn = 1 AND dt > peak_dt GROUP BY app_id""",
    "asof_kpis": """
        SELECT a.id, a.app_id, coalesce(b.avg_balance, 0.0) AS avg_balance, coalesce(b.balance_std, 0.0) AS balance_std,
               coalesce(b.n, 0) AS total_transactions_count, coalesce(f.net, 0.0) AS net_cash_flow,
               coalesce(b.low_n, 0) AS low_balance_frequency, coalesce(d.fall, 0.0) AS drawdown_per_day,
               coalesce(b.avg_balance, 0.0) / CASE WHEN c.income = 0 THEN 1.0 ELSE c.income END AS balance_to_income_ratio,
               coalesce(b.balance_std, 0.0) / CASE WHEN coalesce(b.avg_balance, 0.0) = 0 THEN 1.0
                    ELSE b.avg_balance END AS balance_volatility_index
        FROM raw_applications a
        LEFT JOIN customers c ON c.id = a.id
        LEFT JOIN (SELECT app_id, avg(balance) AS avg_balance, stddev_samp(balance) AS balance_std, count(*) AS n,
                          count(*) FILTER (balance < (SELECT low_balance FROM thresholds)) AS low_n
                   FROM seen GROUP BY app_id) b ON b.app_id = a.app_id
        LEFT JOIN (SELECT app_id, avg(net) AS net
                   FROM (SELECT app_id, ym, sum(amount) AS net FROM seen GROUP BY 1, 2) GROUP BY 1) f ON f.app_id = a.app_id
        LEFT JOIN asof_falls d ON d.app_id = a.app_id""",
}

_NEEDS = {
    "valid_customers": ["raw_customers"],
    "customers": ["valid_customers"],
    "transactions": ["raw_transactions"],
    "thresholds": ["transactions", "customers"],
    "peaks": ["raw_transactions"],
    "falls": ["peaks"],
    "applied": ["raw_applications"],
    "kpi_base": ["customers", "thresholds", "falls", "applied"],
    "kpi_clipped": ["kpi_base"],
    "customer_table": ["kpi_clipped"],
    "histories": ["raw_applications"],
    "strict_histories": ["raw_applications"],
    "seen": ["raw_applications", "transactions"],
    "asof_falls": ["seen"],
    "asof_kpis": ["asof_falls", "customers", "thresholds"],
}


def using(names: str, body: str) -> str:
    """Prefix a statement with the views it names, and those they rest on."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in chosen:
            chosen.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in chosen) + "\n" + body.strip()
