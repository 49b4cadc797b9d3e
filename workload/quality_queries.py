"""Data quality, distribution tests, drift and feature screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.operators import cleaning, drift, history, quality, selection
from tidemark.plans import customer as plans
from tidemark.plans import report
from tidemark.session import scratch_path
from tidemark.sources import tables

from .activity_queries import prepared_tables
from .registry import query, r, rounded
from .views import raw_applications, raw_customers, raw_requests, raw_transactions, staged_transactions, table, using


@query(
    "referential_integrity",
    using(
        "raw_customers raw_applications raw_transactions",
        """SELECT child, count(DISTINCT id) AS orphan_keys, count(DISTINCT id) = 0 AS passed
           FROM (SELECT 'all' AS child, NULL AS id WHERE false
                 UNION ALL SELECT 'applications', id FROM raw_applications
                 UNION ALL SELECT 'transactions', id FROM raw_transactions) c
           WHERE id NOT IN (SELECT id FROM raw_customers WHERE income IS NOT NULL)
           GROUP BY child""",
    ),
)
def referential_integrity(spark, folder):
    """Customers without an income stand for the parents that are missing."""
    known = raw_customers(spark, folder).where("income is not null")
    children = {
        "applications": raw_applications(spark, folder),
        "transactions": raw_transactions(spark, folder),
    }
    return quality.referential_integrity(known, children)


def _outlier_sql(column: str, source: str) -> str:
    return f"""
        SELECT '{column}' AS column_name, {r('any_value(lo)')} AS lower_bound, {r('any_value(hi)')} AS upper_bound,
               min({column}) AS min_value, max({column}) AS max_value,
               count(*) FILTER ({column} < lo OR {column} > hi) AS n_outliers,
               round(100.0 * count(*) FILTER ({column} < lo OR {column} > hi) / count(*), 2) AS pct_outliers,
               count(*) FILTER ({column} IN (9999, 99999, 999999, -1)) AS n_sentinel_hits
        FROM {source}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
                        FROM (SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3
                              FROM {source}))"""


@query(
    "iqr_outliers",
    _outlier_sql("l_extendedprice", "lineitem") + " UNION ALL " + _outlier_sql("l_discount", "lineitem"),
)
def iqr_outliers(spark, folder):
    found = quality.iqr_outliers(table(spark, folder, "lineitem"), ["l_extendedprice", "l_discount"])
    return rounded(found, ["lower_bound", "upper_bound"])


_NEGATIVE_SQL = f"""
    SELECT count(*) FILTER (balance < 0) AS n_negative_rows,
           round(100.0 * count(*) FILTER (balance < 0) / count(*), 2) AS pct_negative_rows,
           count(DISTINCT id) FILTER (balance < 0) AS n_keys_ever_negative,
           round(100.0 * count(DISTINCT id) FILTER (balance < 0) / count(DISTINCT id), 2) AS pct_keys_ever_negative,
           min(balance) FILTER (balance < 0) AS min_value,
           {r('avg(balance) FILTER (balance < 0)')} AS avg_negative
    FROM raw_transactions"""


@query("negative_values", using("raw_transactions", _NEGATIVE_SQL))
def negative_values(spark, folder):
    return rounded(quality.negative_values(raw_transactions(spark, folder)), ["avg_negative"])


@query(
    "thin_history",
    using(
        "raw_transactions",
        """, counts AS (SELECT id, count(*) AS n FROM raw_transactions GROUP BY id)
        SELECT CAST(0.05 AS DOUBLE) AS level, CAST(any_value(q) AS DOUBLE) AS threshold,
               count(*) FILTER (n <= q) AS n_flagged,
               round(100.0 * count(*) FILTER (n <= q) / count(*), 2) AS pct_flagged
        FROM counts, (SELECT quantile_disc(n, 0.05) AS q FROM counts)""",
    ),
)
def thin_history(spark, folder):
    counts = raw_transactions(spark, folder).groupBy("id").agg(F.count("*").alias("n"))
    return quality.thin_history(counts, "n")


@query(
    "thin_history_flag",
    using(
        "raw_transactions",
        """, counts AS (SELECT id, count(*) AS n FROM raw_transactions GROUP BY id)
        SELECT id, n, CAST(n <= (SELECT quantile_disc(n, 0.05) FROM counts) AS INTEGER) AS flag_insufficient_history
        FROM counts""",
    ),
)
def thin_history_flag(spark, folder):
    counts = raw_transactions(spark, folder).groupBy("id").agg(F.count("*").alias("n"))
    threshold = quality.thin_history(counts, "n").first()["threshold"]
    return quality.thin_history_flag(counts, "n", threshold)


@query(
    "report_sink",
    using(
        "raw_applications",
        """, shares AS (SELECT 'class_balance' AS section, outcome AS label, CAST(count(*) AS DOUBLE) AS value
                        FROM raw_applications GROUP BY outcome)
        SELECT *, DATE '2024-01-01' AS run_date FROM shares
        UNION ALL SELECT section, label, 2 * value, DATE '2024-01-02' FROM shares""",
    ),
)
def report_sink(spark, folder):
    """Two dates are written, the second one twice: a repeated run replaces its own date only."""
    counts = quality.category_counts(raw_applications(spark, folder), "outcome").select(
        F.lit("class_balance").alias("section"), F.col("outcome").alias("label"), F.col("n").cast("double").alias("value")
    )
    path = scratch_path(spark, "reports")
    tables.write_report(counts, path, "2024-01-01")
    for factor in (3, 2):
        tables.write_report(counts.withColumn("value", F.col("value") * factor), path, "2024-01-02")
    return spark.read.parquet(path)


@query(
    "empirical_thresholds",
    using(
        "thresholds",
        "SELECT low_balance AS low_balance_threshold, CAST(q33 AS DOUBLE) AS age_tertile_33, "
        "CAST(q66 AS DOUBLE) AS age_tertile_66 FROM thresholds",
    ),
)
def empirical_thresholds(spark, folder):
    people = cleaning.clean_customers(raw_customers(spark, folder))
    moves = cleaning.clean_transactions(staged_transactions(spark, folder))
    return report.thresholds_frame(moves, people)


@query(
    "class_balance",
    using(
        "raw_applications",
        "SELECT outcome, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct "
        "FROM raw_applications GROUP BY outcome",
    ),
)
def class_balance(spark, folder):
    return quality.class_balance(raw_applications(spark, folder), "outcome")


@query("category_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def category_counts(spark, folder):
    return quality.category_counts(table(spark, folder, "lineitem"), "l_returnflag")


@query(
    "crosstab_long",
    using(
        "raw_applications raw_customers",
        """SELECT coalesce(c.gender, 'null') AS gender, coalesce(a.outcome, 'null') AS outcome, count(*) AS n
           FROM raw_applications a JOIN raw_customers c ON c.id = a.id GROUP BY 1, 2""",
    ),
)
def crosstab_long(spark, folder):
    people = raw_customers(spark, folder).select("id", "gender")
    return quality.crosstab_long(raw_applications(spark, folder).join(people, "id"), "gender", "outcome")


def _chi_sql(a: str, b: str, source: str) -> str:
    return f""", cells AS (
            SELECT x.a, y.b, count(z.a) AS o
            FROM (SELECT DISTINCT {a} AS a FROM {source}) x CROSS JOIN (SELECT DISTINCT {b} AS b FROM {source}) y
            LEFT JOIN (SELECT {a} AS a, {b} AS b FROM {source}) z ON z.a = x.a AND z.b = y.b GROUP BY 1, 2),
        expected AS (
            SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e,
                   (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM cells) AS dof FROM cells)
        SELECT {r('sum(power(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e)')}
                 AS chi2_statistic,
               CAST(any_value(dof) AS BIGINT) AS degrees_of_freedom, CAST(sum(o) AS BIGINT) AS n_rows
        FROM expected"""


@query(
    "chi_square",
    using(
        "customers applied",
        """, people AS (SELECT gender, CASE WHEN a.id IS NULL THEN 'no' ELSE 'yes' END AS segment
                        FROM customers c LEFT JOIN applied a ON a.id = c.id)"""
        + _chi_sql("gender", "segment", "people"),
    ),
)
def chi_square(spark, folder):
    people = cleaning.clean_customers(raw_customers(spark, folder))
    asked = history.application_profile(raw_applications(spark, folder)).select("id", "total_applications")
    named = people.join(asked, "id", "left").withColumn(
        "segment", F.when(F.col("total_applications") > 0, "yes").otherwise("no")
    )
    return rounded(drift.chi_square(named, "gender", "segment"), ["chi2_statistic"])


@query(
    "chi_square_corrected",
    "WITH lines AS (SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS fate "
    "FROM lineitem)" + _chi_sql("l_linestatus", "fate", "lines"),
)
def chi_square_corrected(spark, folder):
    """A 2 x 2 table, which gets the continuity correction."""
    lines = table(spark, folder, "lineitem").select(
        "l_linestatus", F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept").alias("fate")
    )
    return rounded(drift.chi_square(lines, "l_linestatus", "fate"), ["chi2_statistic"])


@query(
    "chi_square_test",
    "SELECT 'chi_square_independence' AS test, 'gender' AS column_a, 'senior' AS column_b, chi2_statistic, "
    "degrees_of_freedom, round(exp(-chi2_statistic / 2), 5) AS p_value, exp(-chi2_statistic / 2) < 0.05 AS significant "
    "FROM ("
    + using("customers", ", people AS (SELECT gender, age > 60 AS senior FROM customers)" + _chi_sql("gender", "senior", "people"))
    + ")",
)
def chi_square_test(spark, folder):
    """Three by two categories: with two degrees of freedom the p-value is a plain exponential."""
    people = cleaning.clean_customers(raw_customers(spark, folder))
    found = drift.chi_square_test(people.withColumn("senior", F.col("age") > 60), "gender", "senior")
    return rounded(found, ["chi2_statistic"]).withColumn("p_value", F.round("p_value", 5))


def _segmented_incomes(spark, folder):
    asked = raw_applications(spark, folder).select("id").distinct().withColumn("applied", F.lit("yes"))
    return raw_customers(spark, folder).join(asked, "id", "left").withColumn(
        "applied", F.coalesce("applied", F.lit("no"))
    )


_KS_CTES = """, v AS (SELECT income, a.id IS NOT NULL AS has FROM raw_customers c LEFT JOIN applied a ON a.id = c.id
                    WHERE income IS NOT NULL),
        n AS (SELECT count(*) FILTER (has) AS na, count(*) FILTER (NOT has) AS nb FROM v),
        d AS (SELECT income, sum(count(*) FILTER (has)) OVER (ORDER BY income) AS ca,
                     sum(count(*) FILTER (NOT has)) OVER (ORDER BY income) AS cb FROM v GROUP BY income)"""


@query(
    "ks_two_sample",
    using(
        "raw_customers applied",
        _KS_CTES
        + f"""
        SELECT {r('max(abs(ca / na - cb / nb))', 9)} AS ks_statistic, any_value(na) AS n_a, any_value(nb) AS n_b
        FROM d, n""",
    ),
)
def ks_two_sample(spark, folder):
    found = drift.ks_two_sample(_segmented_incomes(spark, folder), "income", "applied", "yes", "no")
    return rounded(found, {"ks_statistic": 9})


@query(
    "ks_test",
    using(
        "raw_customers applied",
        _KS_CTES
        + """, s AS (SELECT max(abs(ca / na - cb / nb)) AS stat, any_value(na) AS na, any_value(nb) AS nb FROM d, n),
        x AS (SELECT *, stat * sqrt(na * nb / (na + nb)) AS x FROM s),
        p AS (SELECT any_value(stat) AS stat, any_value(na) AS na, any_value(nb) AS nb,
                     CASE WHEN any_value(x) < 0.2 THEN 1.0
                          ELSE least(1.0, greatest(0.0, sum(2 * CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * x * x))))
                     END AS p
              FROM x, (SELECT unnest(range(1, 101)) AS k))
        SELECT 'two_sample_ks' AS test, 'income' AS value_column, 'applied' AS group_column, 'yes' AS group_a,
               'no' AS group_b, na AS n_a, nb AS n_b, round(stat, 9) AS ks_statistic, round(p, 9) AS p_value,
               p < 0.05 AS significant, CAST(NULL AS VARCHAR) AS error, 'asymptotic' AS p_method FROM p""",
    ),
)
def ks_test(spark, folder):
    found = drift.ks_test(_segmented_incomes(spark, folder), "income", "applied", "yes", "no")
    return found.withColumns({c: F.round(c, 9) for c in ("ks_statistic", "p_value")})


def _psi_term(b: str, nb: str, c: str, nc: str) -> str:
    base = f"(CASE WHEN {b} > 0 THEN {b} / {nb} ELSE 0.0001 END)"
    cur = f"(CASE WHEN {c} > 0 THEN {c} / {nc} ELSE 0.0001 END)"
    return f"({cur} - {base}) * ln({cur} / {base})"


def _edge_sql(column: str, source: str) -> str:
    levels = ", ".join(str(i / 10) for i in range(11))
    return (
        f"SELECT list_sort(list_distinct(quantile_disc({column}, [{levels}]))) AS e FROM {source}"
    )


_STABILITY = "CASE WHEN psi < 0.10 THEN 'stable' WHEN psi <= 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END"


@query(
    "psi",
    using(
        "raw_applications",
        f""", edges AS ({_edge_sql('amount', "raw_applications WHERE dt < DATE '1999-01-01'")}),
        binned AS (SELECT dt < DATE '1999-01-01' AS base,
                          least(len(list_filter(e[2:], lambda x: x <= amount)), len(e) - 2) AS bin
                   FROM raw_applications, edges),
        counts AS (SELECT bin, count(*) FILTER (base) AS b, count(*) FILTER (NOT base) AS c FROM binned GROUP BY bin),
        terms AS (SELECT {_psi_term('b', 'sum(b) OVER ()', 'c', 'sum(c) OVER ()')} AS term FROM counts)
        SELECT 'amount' AS column_name, {r('psi', 9)} AS psi, {_STABILITY} AS stability,
               (SELECT CAST(len(e) - 1 AS INTEGER) FROM edges) AS num_bins, false AS is_degenerate,
               CAST(NULL AS VARCHAR) AS error
        FROM (SELECT sum(term) AS psi FROM terms)""",
    ),
)
def psi(spark, folder):
    asked = raw_applications(spark, folder)
    early = F.col("dt") < F.lit("1999-01-01").cast("date")
    return rounded(drift.psi(asked.where(early), asked.where(~early), "amount"), {"psi": 9})


_PSI_WINDOW_SUM = " + ".join(
    _psi_term(
        f"(SELECT count(*) FILTER (bin = {i}) FROM base_bins)",
        "(SELECT count(*) FROM base_bins)",
        f"count(*) FILTER (bin = {i})",
        "count(*)",
    )
    for i in range(10)
)


@query(
    "psi_by_window",
    using(
        "raw_requests",
        f""", edges AS ({_edge_sql('score', "raw_requests WHERE ts < TIMESTAMP '2024-01-08'")}),
        bins AS (SELECT ts, least(len(list_filter(e[2:], lambda x: x <= score)), len(e) - 2) AS bin FROM raw_requests, edges),
        base_bins AS (SELECT bin FROM bins WHERE ts < TIMESTAMP '2024-01-08'),
        days AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS n_rows, {_PSI_WINDOW_SUM} AS psi
                 FROM bins WHERE ts >= TIMESTAMP '2024-01-08' GROUP BY 1)
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, n_rows, {r('psi', 9)} AS psi, {_STABILITY} AS stability
        FROM days""",
    ),
)
def psi_by_window(spark, folder):
    """Daily drift of the score against its first week."""
    requests = raw_requests(spark, folder)
    first_week = F.col("ts") < F.lit("2024-01-08").cast("timestamp")
    day = F.window("ts", "1 day").alias("w")
    found = drift.psi_against(requests.where(first_week), requests.where(~first_week), "score", [day])
    return rounded(
        found.select(F.col("w.start").alias("window_start"), "n_rows", "psi", "stability"), {"psi": 9}
    )


_SCREENED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "column_variances",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'var_samp({c})', 4)} AS variance FROM lineitem" for c in _SCREENED
    ),
)
def column_variances(spark, folder):
    return rounded(selection.column_variances(table(spark, folder, "lineitem"), _SCREENED), {"variance": 4})


@query(
    "low_variance",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'var_samp({c})', 4)} AS variance, var_samp({c}) <= 0.01 AS dropped FROM lineitem"
        for c in _SCREENED
    ),
)
def low_variance(spark, folder):
    return rounded(selection.low_variance(table(spark, folder, "lineitem"), _SCREENED), {"variance": 4})


@query(
    "correlation_long",
    using(
        "customer_table",
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
            + r(f"corr({a}, {b})")
            + " AS correlation FROM customer_table"
            for a in plans.CORRELATED_KPIS
            for b in plans.CORRELATED_KPIS
            if a != b
        )
        + " UNION ALL "
        + " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{a}' AS feature_b, {r('CAST(1.0 AS DOUBLE)')} AS correlation"
            for a in plans.CORRELATED_KPIS
        ),
    ),
)
def correlation_long(spark, folder):
    features = prepared_tables(spark, folder)[3]
    return rounded(quality.correlation_long(features, plans.CORRELATED_KPIS), ["correlation"])


@query(
    "vif",
    f"""WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_discount) AS b,
                          corr(l_extendedprice, l_discount) AS d FROM lineitem),
        v AS (SELECT *, 1 + 2 * a * b * d - a * a - b * b - d * d AS det FROM c),
        f AS (SELECT 'l_quantity' AS feature, (1 - d * d) / det AS vif FROM v
              UNION ALL SELECT 'l_extendedprice', (1 - b * b) / det FROM v
              UNION ALL SELECT 'l_discount', (1 - a * a) / det FROM v)
        SELECT feature, {r('vif')} AS vif, vif > 10 AS flagged, false AS is_singular FROM f""",
)
def vif(spark, folder):
    found = selection.vif(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(found, ["vif"])


# The inverse of the correlations by sweeps on every place; a sweep of the inverse takes a feature out again.
_SWEPT = """[[CASE WHEN i = place AND j = place THEN 1 / m[place][place] WHEN i = place THEN m[place][j] / m[place][place]
                  WHEN j = place THEN -m[i][place] / m[place][place] ELSE m[i][j] - m[i][place] * m[place][j] / m[place][place] END
             FOR j IN range(1, 6)] FOR i IN range(1, 6)]"""
_PRUNED = ["l_quantity", "l_discount", "price", "net_price", "gross_price"]
_VIF_PRUNE_SQL = f"""
    WITH RECURSIVE lines AS (
        SELECT l_quantity, l_discount, l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS net_price,
               l_extendedprice * (1 + l_tax) AS gross_price FROM lineitem),
    correlations AS (SELECT [{", ".join("[" + ", ".join("1.0::DOUBLE" if a == b else f"corr({a}, {b})" for b in _PRUNED) + "]" for a in _PRUNED)}] AS m
                     FROM lines),
    swept AS (
        SELECT 1 AS place, m FROM correlations
        UNION ALL
        SELECT place + 1, {_SWEPT} FROM swept WHERE place <= 5),
    inverse AS (SELECT m FROM swept WHERE place = 6),
    pruned AS (
        SELECT m, [1, 2, 3, 4, 5] AS kept, CAST([] AS BIGINT[]) AS fallen FROM inverse
        UNION ALL
        SELECT {_SWEPT}, list_filter(kept, lambda i: i <> place), list_append(fallen, place)
        FROM (SELECT *, list_extract(list_filter(kept, lambda i: m[i][i] = worst), 1) AS place
              FROM (SELECT *, list_max([m[i][i] FOR i IN kept]) AS worst FROM pruned WHERE len(kept) > 1))
        WHERE worst > 10),
    done AS (SELECT * FROM pruned ORDER BY len(fallen) DESC LIMIT 1)
    SELECT unnest({_PRUNED!r}) AS feature, unnest([list_contains(kept, i) FOR i IN range(1, 6)]) AS kept,
           unnest([CASE WHEN list_contains(fallen, i) THEN CAST(list_position(fallen, i) AS INTEGER) END FOR i IN range(1, 6)])
           AS dropped_in_step FROM done"""


@query("vif_prune", _VIF_PRUNE_SQL)
def vif_prune(spark, folder):
    """Price with and without tax and discount are near copies; the worst go first."""
    price = F.col("l_extendedprice")
    lines = table(spark, folder, "lineitem").select(
        "l_quantity",
        "l_discount",
        price.alias("price"),
        (price * (1 - F.col("l_discount"))).alias("net_price"),
        (price * (1 + F.col("l_tax"))).alias("gross_price"),
    )
    return selection.vif_prune_table(lines, lines.columns)


def _anova_sql(feature: str) -> str:
    return f"""
        SELECT '{feature}' AS feature,
               (sum(n * power(m - g, 2))) / (sum((n - 1) * v) / (sum(n) - 2)) AS f
        FROM (SELECT target, count({feature}) AS n, avg({feature}) AS m, var_samp({feature}) AS v,
                     any_value((SELECT avg({feature}) FROM labelled)) AS g
              FROM labelled GROUP BY target)"""


@query(
    "anova_f",
    using(
        "raw_applications raw_customers",
        ", labelled AS (SELECT CAST(outcome = 'TakeUp' AS INTEGER) AS target, amount, income, age "
        "FROM raw_applications a LEFT JOIN raw_customers c ON c.id = a.id WHERE outcome IS NOT NULL), scores AS ("
        + " UNION ALL ".join(_anova_sql(c) for c in ("amount", "income", "age"))
        + f""") SELECT feature, {r('f')} AS f_score,
               {r('(f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ())')} AS scaled_score FROM scores""",
    ),
)
def anova_f(spark, folder):
    rows = raw_applications(spark, folder).join(raw_customers(spark, folder), "id", "left").select(
        history.accepted_flag().alias("target"), "amount", "income", "age"
    )
    found = selection.anova_f(rows, ["amount", "income", "age"], "target")
    return rounded(found.drop("p_value"), ["f_score", "scaled_score"])


def _long(section: str, metrics: dict[str, str], source: str, label: str = "NULL") -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{m}' AS metric, CAST({label} AS VARCHAR) AS label, "
        f"CAST({e} AS DOUBLE) AS value FROM {source}"
        for m, e in metrics.items()
    )


_OUTLIER_METRICS = {
    m: m
    for m in (
        "lower_bound", "upper_bound", "min_value", "max_value", "n_outliers", "pct_outliers", "n_sentinel_hits",
    )
}
_REPORT_SQL = (
    """, orphans AS (SELECT 'applications' AS child, 0 AS orphan_keys, true AS passed
                     WHERE NOT EXISTS (SELECT 1 FROM raw_applications a WHERE a.id NOT IN (SELECT id FROM customers))
                     UNION ALL SELECT 'transactions', 0, true
                     WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE t.id NOT IN (SELECT id FROM customers))),
    income_out AS ("""
    + _outlier_sql("income", "customers")
    + "), amount_out AS ("
    + _outlier_sql("amount", "raw_applications")
    + "), negatives AS ("
    + _NEGATIVE_SQL.replace("raw_transactions", "transactions")
    + """), thin AS (SELECT 0.05 AS level, any_value(q) AS threshold,
            count(*) FILTER (total_transactions_count <= q) AS n_flagged,
            round(100.0 * count(*) FILTER (total_transactions_count <= q) / count(*), 2) AS pct_flagged
        FROM customer_table, (SELECT quantile_disc(total_transactions_count, 0.05) AS q FROM customer_table)),
    classes AS (SELECT outcome, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct
                FROM raw_applications GROUP BY outcome),
    sizes AS (SELECT count(*) FILTER (total_applications > 0) AS na, count(*) FILTER (total_applications = 0) AS nb
              FROM customer_table),
    steps AS (SELECT income, sum(count(*) FILTER (total_applications > 0)) OVER (ORDER BY income) AS ca,
                     sum(count(*) FILTER (total_applications = 0)) OVER (ORDER BY income) AS cb
              FROM customer_table GROUP BY income),
    ks AS (SELECT max(abs(ca / na - cb / nb)) AS ks_statistic, any_value(na) AS n_a, any_value(nb) AS n_b
           FROM steps, sizes)"""
    + _chi_sql("gender", "customer_segment", "customer_table").replace(
        "SELECT round(sum", ", chi AS (SELECT round(sum"
    )
    + ") SELECT section, metric, label, "
    + r("value")
    + " AS value FROM ("
    + " UNION ALL ".join(
        [
            _long(
                "referential_integrity",
                {"orphan_keys": "orphan_keys", "passed": "CAST(passed AS INTEGER)"},
                "orphans",
                "child",
            ),
            _long("income_outliers", _OUTLIER_METRICS, "income_out"),
            _long("amount_outliers", _OUTLIER_METRICS, "amount_out"),
            _long(
                "negative_balance",
                {
                    m: m
                    for m in (
                        "n_negative_rows", "pct_negative_rows", "n_keys_ever_negative",
                        "pct_keys_ever_negative", "min_value", "avg_negative",
                    )
                },
                "negatives",
            ),
            _long(
                "transaction_history",
                {m: m for m in ("level", "threshold", "n_flagged", "pct_flagged")},
                "thin",
            ),
            _long("class_balance", {"n": "n", "pct": "pct"}, "classes", "outcome"),
            _long(
                "empirical_thresholds",
                {"low_balance_threshold": "low_balance", "age_tertile_33": "q33", "age_tertile_66": "q66"},
                "thresholds",
            ),
            _long("income_distribution_shift", {m: m for m in ("ks_statistic", "n_a", "n_b")}, "ks"),
            _long(
                "gender_segment_independence",
                {m: m for m in ("chi2_statistic", "degrees_of_freedom")},
                "chi",
            ),
        ]
    )
    + ")"
)


@query("quality_report", using("customer_table", _REPORT_SQL))
def quality_report(spark, folder):
    people, asked, moves, features = prepared_tables(spark, folder)
    return rounded(report.quality_report(people, asked, moves, features, p_values=False), ["value"])
