import random
import statistics
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity

SCHEMA = "id string, dt date, amount double, balance double"


def made_up(seed=4, rows=3000, hot=0.4):
    """One customer holds more than a third of all rows."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        who = "hot" if rng.random() < hot else f"c{rng.randrange(25)}"
        day = None if rng.random() < 0.01 else date(2024, 1, 1) + timedelta(days=rng.randrange(120))
        balance = None if rng.random() < 0.05 else float(rng.randrange(-50, 300))
        out.append((who, day, round(rng.uniform(-100, 100), 2), balance))
    return out


def brute_drawdown(rows):
    months = defaultdict(list)
    for who, day, _, balance in rows:
        if day is not None and balance is not None:
            months[who, day.strftime("%Y-%m")].append((day, balance))
    found = {}
    for key, entries in months.items():
        peak_balance = max(b for _, b in entries)
        peak_day = min(d for d, b in entries if b == peak_balance)
        after = [(b, d) for d, b in entries if d >= peak_day]
        low, low_day = min(after)
        if (low_day - peak_day).days > 0:
            found[key] = (peak_day, peak_balance, low_day, low, (peak_balance - low) / (low_day - peak_day).days)
    return found


def test_drawdown_against_brute_force(frame):
    rows = made_up()
    got = {
        (r["id"], r["year_month"]): (
            r["peak_date"], r["peak_balance"], r["trough_date"], r["trough_balance"], r["drawdown_per_day"]
        )
        for r in activity.monthly_drawdown(frame(rows, SCHEMA).repartition(6)).collect()
    }
    assert got == brute_drawdown(rows)


def test_drawdown_edges(frame):
    d = lambda n: date(2024, 3, n)
    rows = [
        ("tie", d(1), 0.0, 9.0), ("tie", d(5), 0.0, 9.0), ("tie", d(11), 0.0, 4.0), ("tie", d(20), 0.0, 4.0),
        ("last", d(1), 0.0, 1.0), ("last", d(31), 0.0, 8.0),
        ("single", d(3), 0.0, 5.0),
        ("sameday", d(3), 0.0, 5.0), ("sameday", d(3), 0.0, 1.0),
        ("nulls", None, 0.0, 100.0), ("nulls", d(2), 0.0, None), ("nulls", d(4), 0.0, 6.0), ("nulls", d(6), 0.0, 2.0),
    ]
    got = {r["id"]: (r["peak_date"], r["trough_date"], r["drawdown_per_day"]) for r in activity.monthly_drawdown(frame(rows, SCHEMA)).collect()}
    assert got == {"tie": (d(1), d(11), 0.5), "nulls": (d(4), d(6), 2.0)}


def test_peak_ties_go_to_the_first_day(frame):
    rows = [("a", date(2024, 1, 9), 0.0, 5.0), ("a", date(2024, 1, 2), 0.0, 5.0), ("a", date(2024, 1, 1), 0.0, 4.0)]
    (r,) = activity.monthly_peak(frame(rows, SCHEMA)).collect()
    assert (r["peak_date"], r["peak_balance"], r["year_month"]) == (date(2024, 1, 2), 5.0, "2024-01")


def test_one_pass_profile_equals_the_single_operators(frame):
    df = frame(made_up(), SCHEMA).repartition(5)
    wide = {r["id"]: r for r in activity.activity_profile(df, 20.0).collect()}
    for r in activity.balance_profile(df).collect():
        got = wide[r["id"]]
        assert got["total_transactions_count"] == r["total_transactions_count"]
        assert got["avg_balance"] == pytest.approx(r["avg_balance"])
        assert got["balance_std"] == pytest.approx(r["balance_std"])
    for operator, column in [
        (activity.monthly_net_flow(df), "net_cash_flow"),
        (activity.low_balance_count(df, 20.0), "low_balance_frequency"),
        (activity.drawdown_per_customer(df), "drawdown_per_day"),
    ]:
        for r in operator.collect():
            assert wide[r["id"]][column] == pytest.approx(r[column])


def test_profile_of_few_rows(frame):
    rows = [("one", date(2024, 1, 1), 1.0, 7.0), ("none", date(2024, 1, 1), 1.0, None)]
    got = {r["id"]: r for r in activity.activity_profile(frame(rows, SCHEMA), 8.0).collect()}
    assert got["one"]["balance_std"] is None and got["one"]["avg_balance"] == 7.0
    assert got["one"]["low_balance_frequency"] == 1
    assert got["none"]["avg_balance"] is None and got["none"]["low_balance_frequency"] == 0


def test_deviation_far_from_zero(frame):
    rows = [("a", date(2024, 1, 1 + i % 9), 0.0, 1e9 + i) for i in range(50)]
    (r,) = activity.activity_profile(frame(rows, SCHEMA), 0.0).collect()
    assert r["balance_std"] == pytest.approx(statistics.stdev(range(50)), rel=1e-9)


def test_trend_is_the_mean_per_month(frame):
    rows = made_up(9)
    per_month = defaultdict(list)
    for (_, month), found in brute_drawdown(rows).items():
        per_month[month].append(found[-1])
    got = [(r[0], r[1]) for r in activity.drawdown_trend(frame(rows, SCHEMA)).collect()]
    assert [m for m, _ in got] == sorted(per_month)
    for month, value in got:
        assert value == pytest.approx(statistics.mean(per_month[month]))


def test_serving_profile(frame):
    rows = [
        ("a", date(2024, 1, 1), 10.0, 1.0), ("a", date(2024, 1, 9), -4.0, 3.0), ("a", date(2024, 3, 1), 0.0, 5.0),
    ]
    (r,) = activity.serving_profile(frame(rows, SCHEMA)).collect()
    assert (r["txn_count"], r["inflow_count"], r["outflow_count"]) == (3, 1, 1)
    assert (r["total_inflow"], r["total_outflow"], r["net_cashflow"]) == (10.0, 4.0, 6.0)
    assert (r["avg_balance"], r["min_balance"], r["std_balance"], r["txn_per_month"]) == (3.0, 1.0, 2.0, 1.5)


def test_customer_work_is_placed_by_customer_once(frame):
    """Two shuffles: to (customer, day) and to customer."""
    df = activity.activity_profile(frame(made_up(), SCHEMA), 20.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [") == 1
    drawdown = activity.monthly_drawdown(frame(made_up(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert drawdown.count("Exchange hashpartitioning") == 2 and "Join" not in drawdown
    assert drawdown.count("Sort [") == 1


def test_imputed_balances_can_be_left_out(frame):
    df = frame([("a", 5.0, 0), ("a", 9.0, 1)], "id string, balance double, balance_missing int")
    assert [r[0] for r in df.coalesce(1).select(activity.observed_balance()).collect()] == [5.0, None]
