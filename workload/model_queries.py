"""Split, evaluation, fairness, the classifier and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import charts, evaluation, history, modeling, selection
from tidemark.plans import training
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import runtime

from .registry import query, r, rounded
from .views import AS_OF, raw_applications, raw_customers, staged_transactions, table, using


@query(
    "stratified_split",
    using(
        "raw_applications",
        """SELECT app_id, CAST(outcome = 'TakeUp' AS INTEGER) AS target,
                  substr(md5(CAST(app_id AS VARCHAR) || ':42'), 1, 13) <= '3333333333333' AS is_test
           FROM raw_applications WHERE outcome IS NOT NULL""",
    ),
)
def stratified_split(spark, folder):
    rows = raw_applications(spark, folder).select("app_id", history.accepted_flag().alias("target"))
    return modeling.stratified_split(rows, "target", "app_id")


@query(
    "stratified_split_exact",
    using(
        "raw_applications",
        """SELECT app_id, CAST(outcome = 'TakeUp' AS INTEGER) AS target,
                  row_number() OVER (PARTITION BY outcome
                                     ORDER BY substr(md5(CAST(app_id AS VARCHAR) || ':42'), 1, 13))
                  <= ceil(count(*) OVER (PARTITION BY outcome) * 0.2) AS is_test
           FROM raw_applications WHERE outcome IS NOT NULL""",
    ),
)
def stratified_split_exact(spark, folder):
    rows = raw_applications(spark, folder).select("app_id", history.accepted_flag().alias("target"))
    return modeling.stratified_split_exact(rows, "target", "app_id")


# A fixed rule stands for a model where SQL has to give the same scores.
_RULE_SQL = """, scored AS (
        SELECT a.app_id, CAST(a.outcome = 'TakeUp' AS INTEGER) AS target, floor(a.amount / 1000) / 500 AS score,
               CAST(a.amount > 150000 AS INTEGER) AS prediction, c.gender, c.age
        FROM raw_applications a LEFT JOIN valid_customers c ON c.id = a.id)"""


def _rule_scored(spark, folder):
    people = raw_customers(spark, folder).select(
        "id", C.normalize_category(F.col("gender")).alias("gender"), C.null_outside(F.col("age")).alias("age")
    )
    return (
        raw_applications(spark, folder)
        .join(people, "id", "left")
        .select(
            "app_id",
            history.accepted_flag().alias("target"),
            (F.floor(F.col("amount") / 1000) / 500).alias("score"),
            (F.col("amount") > 150000).cast("int").alias("prediction"),
            "gender",
            "age",
        )
    )


@query(
    "auc",
    using(
        "raw_applications valid_customers",
        _RULE_SQL
        + f""", d AS (SELECT score, count(*) FILTER (target = 1) AS p, count(*) FILTER (target = 0) AS n
                      FROM scored GROUP BY score),
        w AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS lower FROM d)
        SELECT {r('sum(p * (lower + n / 2)) / (sum(p) * sum(n))', 9)} AS auc,
               CAST(sum(p) AS BIGINT) AS n_positive, CAST(sum(n) AS BIGINT) AS n_negative FROM w""",
    ),
)
def auc(spark, folder):
    return rounded(evaluation.auc(_rule_scored(spark, folder), "target", "score"), {"auc": 9})


@query(
    "roc_points",
    using(
        "raw_applications valid_customers",
        _RULE_SQL
        + f""", d AS (SELECT score, count(*) FILTER (target = 1) AS p, count(*) FILTER (target = 0) AS n
                      FROM scored GROUP BY score)
        SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 + {r('CAST(0 AS DOUBLE)')} AS fpr, 0.0 + {r('CAST(0 AS DOUBLE)')} AS tpr
        UNION ALL
        SELECT score, {r('sum(n) OVER (ORDER BY score DESC) / sum(n) OVER ()')},
               {r('sum(p) OVER (ORDER BY score DESC) / sum(p) OVER ()')} FROM d""",
    ),
)
def roc_points(spark, folder):
    return rounded(evaluation.roc_points(_rule_scored(spark, folder), "target", "score"), ["fpr", "tpr"])


@query(
    "confusion_matrix",
    using(
        "raw_applications valid_customers",
        _RULE_SQL
        + """ SELECT cell, actual, predicted, count(s.app_id) AS n, meaning
        FROM (VALUES ('true_negative', 0, 0, 'Correctly Blocked'), ('false_positive', 0, 1, 'Wasted Promo'),
                     ('false_negative', 1, 0, 'Missed Target'), ('true_positive', 1, 1, 'Correct Conversion'))
             v(cell, actual, predicted, meaning)
        LEFT JOIN scored s ON s.target = actual AND s.prediction = predicted GROUP BY ALL""",
    ),
)
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_rule_scored(spark, folder), "target", "prediction")


@query(
    "group_rates",
    using(
        "raw_applications valid_customers",
        _RULE_SQL
        + f" SELECT gender AS group_value, {r('avg(prediction)')} AS positive_rate, count(*) AS n_rows "
        "FROM scored GROUP BY gender",
    ),
)
def group_rates(spark, folder):
    return rounded(evaluation.group_rates(_rule_scored(spark, folder), "gender", "prediction"), ["positive_rate"])


_IMPACT_SQL = _RULE_SQL + ", rates AS (SELECT gender, avg(prediction) AS rate FROM scored GROUP BY gender)"


@query(
    "disparate_impact",
    using(
        "raw_applications valid_customers",
        _IMPACT_SQL
        + f""" SELECT {r('min(rate) / max(rate)')} AS disparate_impact_ratio, count(*) AS n_groups,
                      min(rate) / max(rate) < 0.8 AS four_fifths_flag FROM rates""",
    ),
)
def disparate_impact(spark, folder):
    rates = evaluation.group_rates(_rule_scored(spark, folder), "gender", "prediction")
    return rounded(evaluation.disparate_impact(rates), ["disparate_impact_ratio"])


@query(
    "fairness_report",
    using(
        "raw_applications valid_customers",
        _IMPACT_SQL
        + f"""
        SELECT 'positive_rate_by_gender' AS metric, gender AS label, {r('rate')} AS value FROM rates
        UNION ALL
        SELECT 'positive_rate_by_age_band', band, {r('avg(prediction)')}
        FROM (SELECT prediction, CASE WHEN age IS NULL THEN 'Unknown' WHEN age <= 25 THEN '<=25'
                     WHEN age <= 35 THEN '26-35' WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65'
                     ELSE '65+' END AS band FROM scored) GROUP BY band
        UNION ALL SELECT 'disparate_impact_ratio', 'gender', {r('min(rate) / max(rate)')} FROM rates
        UNION ALL SELECT 'four_fifths_flag', 'gender',
                         {r('CAST(CAST(min(rate) / max(rate) < 0.8 AS INTEGER) AS DOUBLE)')} FROM rates""",
    ),
)
def fairness_report(spark, folder):
    return rounded(evaluation.fairness_report(_rule_scored(spark, folder), "prediction"), ["value"])


def _bins_sql(source: str, value: str, group: str | None = None) -> str:
    keys, part = (f"{group}, ", f" AND c.{group} = e.{group}") if group else ("", "")
    by = f" GROUP BY {group}" if group else ""
    return f"""
        edges AS (SELECT {keys}min({value}) AS lo, max({value}) AS hi FROM {source}{by}),
        placed AS (SELECT s.*, CAST(least(floor((s.{value} - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin
                   FROM {source} s JOIN edges e ON {f's.{group} = e.{group}' if group else 'true'}),
        counted AS (SELECT {keys}bin, count(*) AS n FROM placed GROUP BY ALL)
        SELECT {f'e.{group}, ' if group else ''}CAST(b.range AS INTEGER) AS bin,
               {r('lo + b.range * ((hi - lo) / 30)', 3)} AS bin_low,
               {r('lo + (b.range + 1) * ((hi - lo) / 30)', 3)} AS bin_high, coalesce(c.n, 0) AS n
        FROM edges e CROSS JOIN range(30) b LEFT JOIN counted c ON c.bin = b.range{part}"""


@query("histogram", "WITH prices AS (SELECT l_extendedprice FROM lineitem), " + _bins_sql("prices", "l_extendedprice"))
def histogram(spark, folder):
    found = charts.histogram(table(spark, folder, "lineitem"), "l_extendedprice")
    return rounded(found, {"bin_low": 3, "bin_high": 3})


@query(
    "grouped_histogram",
    using(
        "raw_applications",
        ", decided AS (SELECT outcome, amount FROM raw_applications WHERE outcome IS NOT NULL), "
        + _bins_sql("decided", "amount", "outcome"),
    ),
)
def grouped_histogram(spark, folder):
    found = charts.grouped_histogram(raw_applications(spark, folder), "amount", "outcome", ["TakeUp", "Declined"])
    return rounded(found, {"bin_low": 3, "bin_high": 3})


@query(
    "box_stats",
    f"""SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS min_value,
               {r('quantile_cont(l_extendedprice, 0.25)')} AS q1, {r('quantile_cont(l_extendedprice, 0.5)')} AS median,
               {r('quantile_cont(l_extendedprice, 0.75)')} AS q3, max(l_extendedprice) AS max_value,
               {r('avg(l_extendedprice)')} AS mean FROM lineitem GROUP BY l_returnflag""",
)
def box_stats(spark, folder):
    found = charts.box_stats(table(spark, folder, "lineitem"), "l_extendedprice", "l_returnflag")
    return rounded(found, ["q1", "median", "q3", "mean"])


SETTINGS = training.Settings(as_of=AS_OF)


def _trained(spark, folder):
    prepared = training.prepare(
        raw_customers(spark, folder), raw_applications(spark, folder), staged_transactions(spark, folder), SETTINGS
    )
    features = training.select_features(prepared, SETTINGS)
    return prepared, features, training.fit(prepared, features, SETTINGS)


@query("train_classifier")
def train_classifier(spark, folder):
    """Scores of the held-out applications."""
    prepared, features, model = _trained(spark, folder)
    return training.scored_test(prepared, model, features).select("app_id", "target", "prediction", "score")


# The same model by Newton's method: three terms, so each step solves a system of three equations.
_NEWTON_SQL = f"""
    , labelled AS (SELECT CAST(outcome = 'TakeUp' AS INTEGER) AS y, CAST(amount AS DOUBLE) AS x1, CAST(month(dt) AS DOUBLE) AS x2
                   FROM raw_applications WHERE outcome IS NOT NULL AND amount IS NOT NULL AND dt IS NOT NULL),
    classes AS (SELECT y, count(*) AS n FROM labelled GROUP BY y),
    facts AS (SELECT avg(x1) AS m1, stddev_samp(x1) AS s1, avg(x2) AS m2, stddev_samp(x2) AS s2 FROM labelled),
    z AS (SELECT l.y, (SELECT sum(n) / count(*) FROM classes) / c.n AS w, (x1 - m1) / s1 AS a, (x2 - m2) / s2 AS b
          FROM labelled l JOIN classes c ON c.y = l.y, facts),
    d AS (SELECT sum(w) AS t, 0.1 * (sum(w * a * a) - sum(w * a) * sum(w * a) / sum(w)) / (sum(w) - sum(w * w) / sum(w)) AS ra,
                 0.1 * (sum(w * b * b) - sum(w * b) * sum(w * b) / sum(w)) / (sum(w) - sum(w * w) / sum(w)) AS rb FROM z),
    newton AS (
        SELECT 0 AS step, CAST(0 AS DOUBLE) AS c0, CAST(0 AS DOUBLE) AS c1, CAST(0 AS DOUBLE) AS c2,
               CAST(1 AS DOUBLE) AS g0, CAST(1 AS DOUBLE) AS g1, CAST(1 AS DOUBLE) AS g2
        UNION ALL
        SELECT step + 1,
               c0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
               c1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
               c2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det,
               g0, g1, g2
        FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
              FROM (SELECT step, c0, c1, c2, sum(w * (p - y)) / any_value(t) AS g0,
                           sum(w * (p - y) * a) / any_value(t) + any_value(ra) * c1 AS g1,
                           sum(w * (p - y) * b) / any_value(t) + any_value(rb) * c2 AS g2,
                           sum(w * p * (1 - p)) / any_value(t) AS h00, sum(w * p * (1 - p) * a) / any_value(t) AS h01,
                           sum(w * p * (1 - p) * b) / any_value(t) AS h02,
                           sum(w * p * (1 - p) * a * a) / any_value(t) + any_value(ra) AS h11,
                           sum(w * p * (1 - p) * a * b) / any_value(t) AS h12,
                           sum(w * p * (1 - p) * b * b) / any_value(t) + any_value(rb) AS h22
                    FROM (SELECT s.*, z.*, d.*, 1 / (1 + exp(-(c0 + c1 * a + c2 * b))) AS p
                          FROM newton s, z, d WHERE step < 12)
                    GROUP BY step, c0, c1, c2))),
    last AS (SELECT * FROM newton WHERE step = 12)
    SELECT '(intercept)' AS term, {r('c0')} AS coefficient, {r('g0')} AS gradient, {r('abs(g0)')} AS violation FROM last
    UNION ALL SELECT 'amount', {r('c1')}, {r('g1')}, {r('abs(g1)')} FROM last
    UNION ALL SELECT 'month', {r('c2')}, {r('g2')}, {r('abs(g2)')} FROM last"""


@query("model_certificate", using("raw_applications", _NEWTON_SQL).replace("WITH ", "WITH RECURSIVE ", 1))
def model_certificate(spark, folder):
    """A fit on all decided applications: coefficients, and the slope of the penalised loss, which is zero there."""
    rows = raw_applications(spark, folder).select(
        history.accepted_flag().alias("target"),
        F.col("amount").cast("double").alias("amount"),
        F.month("dt").cast("double").alias("month"),
    )
    rows = selection.complete_cases(rows.where("target is not null"), ["amount", "month"])
    weighted = modeling.class_weights(rows, "target")
    model = modeling.classifier(["amount", "month"], "target", max_iter=500, tol=1e-14).fit(weighted)
    return rounded(modeling.certificate(model, weighted, "target"), ["coefficient", "gradient", "violation"])


@query("feature_ablation")
def feature_ablation(spark, folder):
    prepared, features, model = _trained(spark, folder)
    test = selection.complete_cases(prepared.test, features)
    return modeling.feature_ablation(prepared.train, test, features, training.LABEL, full_model=model)


@query("top_coefficients")
def top_coefficients(spark, folder):
    return modeling.coefficient_table(spark, _trained(spark, folder)[2])


@query("training_metrics")
def training_metrics(spark, folder):
    prepared, features, model = _trained(spark, folder)
    return training.training_metrics(prepared, model, features, SETTINGS)


@query("score_prospects")
def score_prospects(spark, folder):
    prepared, _, model = _trained(spark, folder)
    return modeling.score_prospects(model, prepared.customer_table)


@query(
    "prospect_population",
    using(
        "customer_table",
        "SELECT id, customer_segment, action_quadrant, 0 AS prior_applications, 0 AS prior_successes, "
        "CAST(0 AS DOUBLE) AS prior_max_amount, CAST(-1 AS DOUBLE) AS prior_success_rate, "
        "CAST(0 AS DOUBLE) AS requested_amount FROM customer_table WHERE total_applications = 0",
    ),
)
def prospect_population(spark, folder):
    from .activity_queries import prepared_tables

    never = prepared_tables(spark, folder)[3].where("total_applications = 0")
    return modeling.no_history_features(never).select(
        "id", "customer_segment", "action_quadrant", "prior_applications", "prior_successes",
        "prior_max_amount", "prior_success_rate", "requested_amount",
    )


@query("model_roundtrip")
def model_roundtrip(spark, folder):
    """Scores of a model that was written and loaded beside those of the original."""
    prepared, features, model = _trained(spark, folder)
    path = scratch_path(spark, "model")
    tables.save_model(model, path)
    test = selection.complete_cases(prepared.test, features)
    both = modeling.with_scores(tables.load_model(path), test, "score_loaded").drop("prediction")
    return modeling.with_scores(model, both, "score").select("app_id", "score", "score_loaded")


@query("stream_score")
def stream_score(spark, folder):
    """Score customers that arrive as files of a stream."""
    prepared, _, model = _trained(spark, folder)
    arriving = modeling.no_history_features(modeling.encode_gender(prepared.customer_table))
    inbox = scratch_path(spark, "inbox")
    tables.write_table(arriving, inbox)
    stream = runtime.file_stream(spark, inbox, spark.read.parquet(inbox).schema)
    return runtime.drain_to_table(runtime.score_stream(model, stream), scratch_path(spark, "scores"))
