from __future__ import annotations

import random
import statistics
from datetime import date, timedelta

import pytest

from tidemark.operators.asof import ASOF_MEASURES, asof_activity_profile, customer_days
from tidemark.operators.history import DAY, application_history
from tidemark.plans import customer as plans

MOVES = "id string, dt date, amount double, balance double"
ASKED = "id string, app_id long, dt date, row string, day int, rows string, avg_balance string"


def brute(moves, who, when, low):
    """The measures from their definitions, over the rows before a day."""
    mine = [m for m in moves if who is not None and m[0] == who and m[1] is not None and when is not None and m[1] < when]
    held = [m[3] for m in mine if m[3] is not None]
    months = {}
    for m in mine:
        months.setdefault((m[1].year, m[1].month), []).append(m)
    falls = []
    for rows in months.values():
        known = [(m[3], m[1]) for m in rows if m[3] is not None]
        if known:
            top = max(b for b, _ in known)
            peak = min(d for b, d in known if b == top)
            least, at = min((b, d) for b, d in known if d >= peak)
            if at > peak:
                falls.append((top - least) / (at - peak).days)
    return (
        statistics.fmean(held) if held else None,
        statistics.stdev(held) if len(held) > 1 else None,
        len(mine),
        statistics.fmean([sum(m[2] for m in rows) for rows in months.values()]) if months else None,
        sum(b < low for b in held),
        statistics.fmean(falls) if falls else None,
    )


def sample(seed, n_moves=400, n_asked=80):
    rng = random.Random(seed)
    day = lambda: date(2024, 1, 1) + timedelta(rng.randint(0, 130))
    moves = [
        (rng.choice(["a", "a", "b", "c", None]), rng.choice([day(), day(), day(), None]), float(rng.randint(-50, 50)),
         rng.choice([None, float(rng.randint(0, 9)), 1e9 + rng.randint(0, 3)]))
        for _ in range(n_moves)
    ]
    asked = [(rng.choice(["a", "b", "c", "d", None]), i, rng.choice([day(), day(), day(), None]), "r", 1, "n", "x") for i in range(n_asked)]
    return moves, asked


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_definition(frame, seed):
    moves, asked = sample(seed)
    asked += [(*asked[0][:1], 100, *asked[0][2:]), asked[1]]
    done = asof_activity_profile(frame(asked, ASKED), frame(moves, MOVES), 5.0).collect()
    assert len(done) == len(asked)
    for r in done:
        expected = brute(moves, r.id, r.dt, 5.0)
        for name, value in zip(ASOF_MEASURES, expected, strict=True):
            found = r[name]
            assert found == value or (found is not None and value is not None and found == pytest.approx(value, rel=1e-6, abs=1e-3)), name
        assert (r.row, r.day, r.rows) == ("r", 1, "n")


def test_a_later_transaction_changes_no_earlier_row(frame):
    moves, asked = sample(9)
    cut = date(2024, 3, 10)
    more = [(i, cut + timedelta(k), 1e6, b) for i in "abcd" for k in range(0, 40, 7) for b in (-1e6, 1e8, None)]
    more += [("a", None, 5.0, 5.0)]

    def known(rows):
        people = frame([(i, 10.0) for i in "abc"], "id string, income double")
        from pyspark.sql import functions as F

        held = frame(rows, MOVES).withColumn("balance_missing", F.col("balance").isNull().cast("int"))
        out = plans.asof_customer_kpis(frame([a[:3] for a in asked], "id string, app_id long, dt date"), people, held, 5.0)
        return sorted((tuple(r) for r in out.where(F.col("dt").isNull() | (F.col("dt") <= F.lit(cut))).collect()), key=str)

    assert known(moves) == known(moves + more)


def test_empty_tables(frame):
    asked = frame([("a", 1, date(2024, 1, 5), "r", 1, "n", "x")], ASKED)
    r = asof_activity_profile(asked, frame([], MOVES), 5.0).first()
    assert [r[n] for n in ASOF_MEASURES] == [None, None, 0, None, 0, None]
    assert asof_activity_profile(frame([], ASKED), frame([("a", date(2024, 1, 1), 1.0, 1.0)], MOVES), 5.0).count() == 0


def test_features_need_a_threshold(frame):
    table = frame([], "id string")
    with pytest.raises(ValueError, match="threshold"):
        plans.application_features(frame([], ASKED), table, transactions=frame([], MOVES))


def operators_of(df, name):
    """How often an operator occurs in the plan that would run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum(line.strip(" +-:").startswith(name) for line in text.splitlines())


def test_days_are_placed_and_sorted_once(frame):
    moves, asked = sample(4)
    days = customer_days(frame(moves, MOVES), 5.0, frame(asked, ASKED))
    # to (customer, day), then to customer, where every window takes the same order
    assert operators_of(days, "Exchange") == 2
    assert operators_of(days, "Sort ") == 1


@pytest.mark.parametrize("seed", [5, 6])
def test_one_walk_serves_applications_and_customers(frame, seed):
    from tidemark.operators.activity import activity_profile

    moves, asked = sample(seed)
    moves += [("undated", None, 3.0, 4.0), ("unpaid", date(2024, 1, 2), None, 4.0), ("unpaid", date(2024, 2, 2), 6.0, 1.0)]
    asked.append(("never moved", 500, date(2024, 3, 1), "r", 1, "n", "x"))
    held, rows = frame(moves, MOVES), frame(asked, ASKED)
    days = customer_days(held, 5.0, rows).localCheckpoint()
    nothing = frame([], MOVES)
    assert sorted(map(str, asof_activity_profile(rows, nothing, 0.0, days=days).collect())) == sorted(
        map(str, asof_activity_profile(rows, held, 5.0).collect())
    )
    found = {r["id"]: r for r in activity_profile(nothing, 0.0, days=days).collect()}
    assert set(found) == {m[0] for m in moves}
    for who, r in found.items():
        mine = [m for m in moves if m[0] == who]
        balances = [m[3] for m in mine if m[3] is not None]
        months = {}
        for m in mine:
            months.setdefault(m[1] and (m[1].year, m[1].month), []).append(m[2])
        nets = [sum(a for a in got if a is not None) for got in months.values() if any(a is not None for a in got)]
        falls = brute([(*m[:2], m[2] or 0.0, m[3]) for m in moves], who, date(2030, 1, 1), 5.0)[5]
        assert (r.total_transactions_count, r.low_balance_frequency) == (len(mine), sum(b < 5.0 for b in balances))
        assert r.avg_balance == pytest.approx(statistics.fmean(balances))
        assert r.net_cash_flow == pytest.approx(statistics.fmean(nets))
        if len(balances) > 1:
            assert r.balance_std == pytest.approx(statistics.stdev(balances))
        if who is not None:
            assert r.drawdown_per_day == (None if falls is None else pytest.approx(falls))


def test_application_rows_are_placed_once(frame):
    asked = frame([("a", 1, date(2024, 1, 5), 5.0, "TakeUp"), ("a", 2, None, 6.0, None)], "id string, app_id long, dt date, amount double, outcome string")
    held = frame([("a", date(2024, 1, 1), 1.0, 1.0, 0)], MOVES + ", balance_missing int")
    days = customer_days(held, 5.0, asked).localCheckpoint()
    history = application_history(asked, strict=True, keep_day=True)
    found = asof_activity_profile(history, held, 5.0, days=days, day_column=DAY)
    assert operators_of(found, "Exchange") == operators_of(history, "Exchange") + 1
    assert sorted(r.total_transactions_count for r in found.collect()) == [0, 1]
