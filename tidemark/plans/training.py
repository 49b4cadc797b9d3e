"""The whole flow: clean, measure, report, select, fit, evaluate, score and write."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import activity, charts, cleaning, evaluation, modeling, selection
from ..session import durable, literal_frame
from ..sources import tables
from .customer import application_features, customer_features, feature_columns, known_days
from .report import long_rows, quality_report

LABEL = "target"


@dataclass(frozen=True)
class Settings:
    as_of: str
    test_share: float = fixed.TEST_SHARE
    seed: int = fixed.SEED
    min_variance: float = fixed.MIN_VARIANCE
    max_vif: float = fixed.MAX_VIF
    reg_param: float = fixed.REG_PARAM
    elastic_net: float = fixed.ELASTIC_NET
    strict_history: bool = True
    #: Activity measures of the training rows as they stood before each application.
    point_in_time: bool = True
    cap_kpis: bool = True


@dataclass
class Prepared:
    customers: DataFrame
    applications: DataFrame
    transactions: DataFrame
    thresholds: dict[str, float]
    customer_table: DataFrame
    train: DataFrame
    test: DataFrame
    candidates: list[str] = field(default_factory=list)


def prepare(customers: DataFrame, applications: DataFrame, transactions: DataFrame, settings: Settings) -> Prepared:
    """Clean tables, customer and application features, split."""
    people, moves, thresholds = cleaning.clean_with_thresholds(customers, transactions)
    asked = cleaning.clean_applications(applications)
    low, days, known = thresholds["low_balance_threshold"], None, {}
    if settings.point_in_time:
        days = known_days(asked, moves, low)
        known = {"transactions": moves, "low_balance_threshold": low, "days": days}
    table = customer_features(people, asked, moves, thresholds, settings.as_of, cap_kpis=settings.cap_kpis, days=days)
    rows = modeling.encode_gender(application_features(asked, table, settings.strict_history, **known))
    # marked as they are written: every screen, fit and score reads one of the sides again
    marked = durable(modeling.stratified_split(rows, LABEL, "app_id", settings.test_share, settings.seed))
    train, test = modeling.split_sides(marked)
    return Prepared(people, asked, moves, thresholds, table, train, test, feature_columns(table))


def select_features(prepared: Prepared, settings: Settings) -> list[str]:
    """Variance and collinearity screens, on the training rows only."""
    kept, _ = selection.keep_varying(prepared.train, prepared.candidates, settings.min_variance)
    kept, _ = selection.vif_prune(prepared.train, kept, settings.max_vif)
    return kept


def fit(prepared: Prepared, features: list[str], settings: Settings) -> PipelineModel:
    return modeling.fit_classifier(
        prepared.train, features, LABEL, reg_param=settings.reg_param, elastic_net=settings.elastic_net
    )


def fit_certificate(prepared: Prepared, model: PipelineModel, features: list[str]) -> DataFrame:
    """The slope of the penalised loss at the model's coefficients, on the rows it was fitted on."""
    needed = selection.complete_cases(prepared.train.select(*features, LABEL), features)
    return modeling.certificate(model, modeling.class_weights(needed, LABEL), LABEL)


def scored_test(prepared: Prepared, model: PipelineModel, features: list[str]) -> DataFrame:
    return modeling.with_scores(model, selection.complete_cases(prepared.test, features))


def training_metrics(
    prepared: Prepared, model: PipelineModel, features: list[str], settings: Settings
) -> DataFrame:
    """Metrics of a fit as report rows: AUC, sizes, features, confusion, fairness, ablation."""
    spark = prepared.train.sparkSession
    # scored once for the area, the confusion counts and the fairness report
    scored = durable(scored_test(prepared, model, features).select(LABEL, "score", "prediction", "gender", "age"))
    kept = F.count_if(selection.is_complete(features))
    n_train, n_train_complete = prepared.train.agg(F.count("*"), kept).first()
    n_test, n_test_complete = prepared.test.agg(F.count("*"), kept).first()
    counts = {
        "n_train": n_train,
        "n_test": n_test,
        "n_train_complete": n_train_complete,
        "n_test_complete": n_test_complete,
        "n_unlabelled": prepared.applications.where("outcome is null").count(),
    }
    size_rows = literal_frame(
        spark,
        {"section": "string", "metric": "string", "label": "string", "value": "double"},
        [("rows", k, None, float(v)) for k, v in counts.items()]
        + [("features", "position", c, float(i)) for i, c in enumerate(features)],
    )
    fairness = evaluation.fairness_report(scored, "prediction").select(
        F.lit("fairness").alias("section"), "metric", "label", "value"
    )
    ablation = modeling.feature_ablation(
        prepared.train, selection.complete_cases(prepared.test, features), features, LABEL, full_model=model,
        reg_param=settings.reg_param, elastic_net=settings.elastic_net,
    )
    parts = [
        long_rows(evaluation.auc(scored, LABEL, "score"), "test", ["auc"]),
        size_rows,
        long_rows(evaluation.confusion_matrix(scored, LABEL, "prediction"), "confusion", ["n"], "cell"),
        fairness,
        long_rows(ablation, "gender_ablation", ["auc_with", "auc_without", "auc_difference"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def screening_tables(prepared: Prepared, features: list[str], settings: Settings) -> dict[str, DataFrame]:
    """What the screens found on the training rows, and why a candidate was left out."""
    train, spark = prepared.train, prepared.train.sparkSession
    varying, flat = selection.keep_varying(train, prepared.candidates, settings.min_variance)
    reasons = [(c, "low variance") for c in flat]
    reasons += [(c, "collinear") for c in varying if c not in features]
    return {
        "variance": selection.low_variance(train, prepared.candidates, settings.min_variance),
        "vif": selection.vif(train, varying, settings.max_vif),
        "anova": selection.anova_f(selection.complete_cases(train, features), features, LABEL),
        "dropped_features": literal_frame(spark, {"feature": "string", "reason": "string"}, reasons),
    }


def activity_tables(prepared: Prepared) -> dict[str, DataFrame]:
    """The monthly drawdown trend and the customers with the steepest falls."""
    observed = prepared.transactions.withColumn("balance", activity.observed_balance())
    return {
        "drawdown_trend": activity.drawdown_trend(observed),
        "top_drawdowns": charts.top_n(prepared.customer_table, "drawdown_per_day", "id"),
    }


def run(
    customers: DataFrame,
    applications: DataFrame,
    transactions: DataFrame,
    out: str,
    run_date: str,
    settings: Settings,
) -> PipelineModel:
    """Run the flow and write its tables, model and prospect scores under ``out``.

    Reports, screens, coefficients, ROC and trend are kept by ``run_date``; model
    and prospect scores are replaced.
    """
    prepared = prepare(customers, applications, transactions, settings)
    findings = quality_report(
        prepared.customers, prepared.applications, prepared.transactions, prepared.customer_table
    )
    features = select_features(prepared, settings)
    model = fit(prepared, features, settings)
    written = {
        "quality_report": findings,
        "training_metrics": training_metrics(prepared, model, features, settings),
        **screening_tables(prepared, features, settings),
        **activity_tables(prepared),
        "coefficients": modeling.coefficient_table(prepared.train.sparkSession, model),
        "certificate": fit_certificate(prepared, model, features),
        "roc": evaluation.roc_points(scored_test(prepared, model, features), LABEL, "score"),
    }
    for name, frame in written.items():
        tables.write_report(frame, f"{out}/{name}", run_date)
    tables.save_model(model, f"{out}/model")
    tables.write_table(
        modeling.score_prospects(model, prepared.customer_table), f"{out}/prospect_scores"
    )
    return model
