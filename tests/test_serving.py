from __future__ import annotations

import datetime as dt

import pytest

from tidemark.plans import serving

DAY = dt.date(2024, 1, 31)


def test_customers_without_history_are_complete(frame):
    customers = frame([("1", " female", 40, 2400.0), ("2", None, 130, 0.0), ("3", "Male", 30, 1200.0)], "id string, gender string, age int, income double")
    asked = frame(
        [("1", 100.0, "Declined"), ("1", 300.0, "TakeUp"), ("3", None, None), (None, 9.0, "Declined")],
        "id string, amount double, outcome string",
    )
    moves = frame(
        [("1", DAY, 50.0, 400.0), ("1", DAY, -20.0, 200.0), ("1", DAY + dt.timedelta(1), 0.0, None), (None, DAY, 5.0, 1.0)],
        "id string, dt date, amount double, balance double",
    )
    rows = {r["id"]: r.asDict() for r in serving.serving_view(customers, asked, moves).collect()}
    assert set(rows) == {"1", "2", "3"}
    one = rows["1"]
    assert [one[c] for c in serving.COUNTS] == [3, 1, 1, 2, 1]
    assert [one[c] for c in ("total_inflow", "total_outflow", "net_cashflow", "avg_balance", "min_balance")] == [50.0, 20.0, 30.0, 300.0, 200.0]
    assert (one["txn_per_month"], one["max_loan_amount"], one["mean_loan_amount"]) == (1.5, 300.0, 200.0)
    assert one["balance_to_income_ratio"] == pytest.approx(1.5)
    assert (rows["2"]["age"], rows["2"]["balance_to_income_ratio"]) == (None, 0.0)
    assert all(rows["2"][c] == 0 for c in (*serving.COUNTS, *serving.AMOUNTS))
    assert (rows["3"]["total_loans"], rows["3"]["num_declined"], rows["3"]["max_loan_amount"]) == (1, 0, 0.0)


def test_empty_tables(frame):
    customers = frame([("1", "Male", 40, 2400.0)], "id string, gender string, age int, income double")
    asked = frame([], "id string, amount double, outcome string")
    moves = frame([], "id string, dt date, amount double, balance double")
    assert serving.serving_view(customers, asked, moves).first()["txn_count"] == 0
    assert serving.serving_view(customers.limit(0), asked, moves).count() == 0
