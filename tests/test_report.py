from __future__ import annotations

import random
from datetime import date

import pytest

from tidemark.functions import fixed_values as fixed
from tidemark.functions import pvalues
from tidemark.operators import drift, quality
from tidemark.operators import quantiles as Q
from tidemark.plans import report
from tidemark.session import durable


@pytest.fixture
def tables(frame):
    def make(n=300, seed=1):
        rng = random.Random(seed)
        key = lambda: rng.choice([str(rng.randint(0, n + 20)), str(rng.randint(0, n + 20)), None])
        amount = lambda: rng.choice([None, float("nan"), -1.0, 9999.0, 0.0, rng.lognormvariate(5, 3), float(rng.randint(-40, 40))])
        people = [(str(i), rng.choice([None, float(rng.randint(18, 80))]), amount()) for i in range(n)] + ([(None, 30.0, 5.0)] if n else [])
        asked = [(key(), date(2024, 1, 1), amount(), rng.choice(["TakeUp", "Declined", None])) for _ in range(2 * n)]
        moves = [(key(), amount()) for _ in range(5 * n)]
        wide = [
            (p[0], p[2], rng.randint(0, 20), rng.choice(["Male", "Female", None]), rng.choice([fixed.BORROWER, fixed.PROSPECT]))
            for p in people
        ]
        return (
            frame(people, "id string, age double, income double"),
            frame(asked, "id string, dt date, amount double, outcome string"),
            frame(moves, "id string, balance double"),
            frame(wide, "id string, income double, total_transactions_count long, gender string, customer_segment string"),
        )

    return make


def by_sections(customers, applications, transactions, customer_table):
    """The findings one after the other, each by the operator of its own."""
    metrics = ["lower_bound", "upper_bound", "min_value", "max_value", "n_outliers", "pct_outliers", "n_sentinel_hits"]
    negative = ["n_negative_rows", "pct_negative_rows", "n_keys_ever_negative", "pct_keys_ever_negative", "min_value", "avg_negative"]
    both = {"applications": applications, "transactions": transactions}
    parts = [
        report.long_rows(quality.referential_integrity(customers, both), "referential_integrity", ["orphan_keys", "passed"], "child"),
        report.long_rows(quality.iqr_outliers(customers, ["income"]), "income_outliers", metrics),
        report.long_rows(quality.iqr_outliers(applications, ["amount"]), "amount_outliers", metrics),
        report.long_rows(quality.negative_values(transactions), "negative_balance", negative),
        report.long_rows(
            quality.thin_history(customer_table, "total_transactions_count"), "transaction_history", ["level", "threshold", "n_flagged", "pct_flagged"]
        ),
        report.long_rows(quality.class_balance(applications, "outcome"), "class_balance", ["n", "pct"], "outcome"),
        report.long_rows(
            report.thresholds_frame(transactions, customers), "empirical_thresholds", ["low_balance_threshold", "age_tertile_33", "age_tertile_66"]
        ),
        report.long_rows(
            drift.ks_test(customer_table, "income", "customer_segment", fixed.BORROWER, fixed.PROSPECT),
            "income_distribution_shift", ["ks_statistic", "n_a", "n_b", "p_value", "significant"],
        ),
        report.long_rows(
            drift.chi_square_test(customer_table, "gender", "customer_segment"),
            "gender_segment_independence", ["chi2_statistic", "degrees_of_freedom", "p_value", "significant"],
        ),
    ]
    return {tuple(r)[:3]: r["value"] for p in parts for r in p.collect()}


def found(*tables):
    rows = report.quality_report(*tables).collect()
    assert len({tuple(r)[:3] for r in rows}) == len(rows)
    return {tuple(r)[:3]: r["value"] for r in rows}


@pytest.mark.parametrize("few_rows", [20_000, 30])
def test_report_equals_its_sections(tables, few_rows, monkeypatch):
    monkeypatch.setattr(Q, "FEW_ROWS", few_rows)
    made = tables()
    expected = by_sections(*made)
    got = found(*made)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == (value if value is None else pytest.approx(value, rel=1e-9, nan_ok=True)), key


def test_report_of_empty_tables(tables):
    got = found(*[t.limit(0) for t in tables()])
    assert got["income_distribution_shift", "ks_statistic", None] is None
    assert got["referential_integrity", "passed", "applications"] == 1.0


def test_report_takes_few_jobs(spark, tables):
    made = [durable(t) for t in tables(2000)]
    for name, limit, run in (
        ("report", 10, lambda: report.quality_report(*made).collect()),
        ("chi", 6, lambda: drift.chi_square(made[3], "gender", "customer_segment").collect()),
    ):
        spark.sparkContext.setJobGroup(name, name)
        run()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)) <= limit
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_class_balance_and_chi_square_of_nothing(frame):
    assert quality.class_balance(frame([], "y string"), "y").count() == 0
    assert drift.chi_square(frame([], "a string, b string"), "a", "b").first()["chi2_statistic"] is None


def test_p_values_follow_the_statistics(tables):
    got = found(*tables(seed=4))
    d, n_a, n_b = (got["income_distribution_shift", m, None] for m in ("ks_statistic", "n_a", "n_b"))
    assert got["income_distribution_shift", "p_value", None] == pytest.approx(pvalues.ks_two_sample(d, int(n_a), int(n_b)))


def test_many_open_cells_cost_a_row_one_lookup(frame, tables, monkeypatch):
    """Two samples that are nearly alike: the distance may be largest in hundreds of cells."""
    monkeypatch.setattr(Q, "FEW_ROWS", 30)
    counted, plans, opened = Q._counted, [], []

    def watched(tagged):
        plans.append(tagged._jdf.queryExecution().optimizedPlan().toString())
        found = counted(tagged)
        opened.append(len(found))
        return found

    monkeypatch.setattr(Q, "_counted", watched)
    customers, applications, transactions, _ = tables(50)
    rng = random.Random(3)
    incomes = sorted(rng.uniform(1.0, 10_000.0) for _ in range(3000))
    sides = [(x, (fixed.BORROWER, fixed.PROSPECT)[i % 2]) for i, x in enumerate(incomes)]
    wide = frame(
        [(str(i), x, 3, "Male", s) for i, (x, s) in enumerate(sides)],
        "id string, income double, total_transactions_count long, gender string, customer_segment string",
    )
    got = found(customers, applications, transactions, wide)
    assert got["income_distribution_shift", "ks_statistic", None] == pytest.approx(1 / 1500)
    assert max(opened) > 300
    assert max(p.count("CASE WHEN") for p in plans) < 20


def test_values_find_their_spans(frame):
    rng = random.Random(5)
    values = sorted({*(rng.lognormvariate(0, 4) * rng.choice([-1, 1]) for _ in range(400)), 0.0, -1e-300, 1e308, float("inf"), float("-inf")})
    data = frame([*[(x, -x) for x in values], (None, None), (float("nan"), None)], "a double, b double")
    cells = Q.first_cells(data, ["a", "b"])
    spans = [s for column in cells for s in column[::2]]
    rows = Q.placed_values(Q.long_values(data, {0: data["a"], 1: data["b"]}), spans, 16).collect()
    expected = {
        (k, x) for k, s in enumerate(spans) for v in values for x in ((v, -v)[s.column],) if s.low <= x <= s.high
    }
    assert sorted((r["span"], r["x"]) for r in rows) == sorted(expected)
    assert {r["cell"] for r in rows} <= set(range(17))


def test_facts_of_keys(frame):
    people = frame([("a", 20.0, 1.0), ("a", 20.0, 1.0), ("b", 30.0, None), (None, 40.0, 2.0)], "id string, age double, income double")
    asked = frame([("a", None, 5.0, None), ("x", None, 6.0, "TakeUp"), ("x", None, 7.0, None), (None, None, 8.0, None)], "id string, dt date, amount double, outcome string")
    moves = frame([("a", -1.0), ("a", -3.0), ("y", -2.0), ("b", None), (None, 4.0)], "id string, balance double")
    wide = frame([], "id string, income double, total_transactions_count long, gender string, customer_segment string")
    got = found(people, asked, moves, wide)
    assert [got["referential_integrity", "orphan_keys", t] for t in ("applications", "transactions")] == [2.0, 2.0]
    assert got["negative_balance", "n_keys_ever_negative", None] == 2.0
    assert got["negative_balance", "pct_keys_ever_negative", None] == 50.0
    assert got["negative_balance", "avg_negative", None] == -2.0
    assert got["negative_balance", "min_value", None] == -3.0
