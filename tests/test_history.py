import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history

SCHEMA = "id string, app_id long, dt date, amount double, outcome string"


def made_up(rows=800):
    rng = random.Random(8)
    out = []
    for number in range(rows):
        who = "hot" if rng.random() < 0.4 else f"c{rng.randrange(30)}"
        day = None if rng.random() < 0.02 else date(2024, 1, 1) + timedelta(days=rng.randrange(40))
        out.append((who, number * 3, day, float(rng.randrange(1000)), rng.choice(["TakeUp", "Declined", None])))
    return out


def brute(rows, strict):
    order = lambda r: (r[2] or date.min, r[1])
    found = {}
    for r in rows:
        if strict:
            before = [o for o in rows if o[0] == r[0] and o[2] and r[2] and o[2] < r[2]]
        else:
            before = [o for o in rows if o[0] == r[0] and order(o) < order(r)]
        won = [o[3] for o in before if o[4] == "TakeUp"]
        found[r[1]] = (len(before), len(won), max(won, default=0.0), len(won) / len(before) if before else -1.0)
    return found


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("block_rows", [17, 1_000_000])
def test_against_brute_force(frame, strict, block_rows):
    rows = made_up()
    df = history.application_history(frame(rows, SCHEMA).repartition(7), strict=strict, block_rows=block_rows)
    got = {
        r["app_id"]: (r["prior_applications"], r["prior_successes"], r["prior_max_amount"], r["prior_success_rate"])
        for r in df.collect()
    }
    assert got == brute(rows, strict)


def test_no_row_is_lost_and_target_keeps_pending(frame):
    rows = made_up(100)
    got = history.application_history(frame(rows, SCHEMA)).collect()
    assert len(got) == 100
    for r in got:
        assert r["target"] == {"TakeUp": 1, "Declined": 0, None: None}[r["outcome"]]


def test_same_day_pair(frame):
    day = date(2024, 5, 1)
    df = frame([("a", 1, day, 5.0, "TakeUp"), ("a", 2, day, 6.0, "TakeUp")], SCHEMA)
    assert {r["app_id"]: r["prior_applications"] for r in history.application_history(df).collect()} == {1: 0, 2: 1}
    strict = history.application_history(df, strict=True).collect()
    assert {r["app_id"]: r["prior_applications"] for r in strict} == {1: 0, 2: 0}


def test_attributes_ride_along(frame):
    rows = made_up(200)
    people = frame([("hot", 7), ("c1", 8)], "id string, score int")
    got = history.application_history(frame(rows, SCHEMA), strict=True, attributes=people).collect()
    assert len(got) == 200
    assert all(r["score"] == {"hot": 7, "c1": 8}.get(r["id"]) for r in got)


def placements(df):
    """Columns of every shuffle in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    return sorted(", ".join(re.findall(r"([a-z_]+)#", f)) for f in found)


def test_application_rows_move_once_and_never_by_customer_alone(spark, frame):
    people = frame([("hot", 7)], "id string, score int")
    df = history.application_history(frame(made_up(50), SCHEMA), attributes=people)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # applications and day totals, which are a table already; then day totals and attributes by customer
        assert placements(df) == ["id", "id"] + ["id, _day"] * 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_application_without_a_customer_has_no_history(frame):
    day = date(2024, 5, 1)
    df = frame([(None, 1, day, 5.0, "TakeUp"), (None, 2, day, 6.0, "TakeUp"), (None, 3, date(2024, 6, 1), 6.0, None)], SCHEMA)
    for strict in (False, True):
        for r in history.application_history(df, strict=strict).collect():
            assert (r["prior_applications"], r["prior_successes"], r["prior_max_amount"]) == (0, 0, 0.0)


def test_profile(frame):
    day = date(2024, 5, 1)
    df = frame(
        [("a", 1, day, 5.0, "TakeUp"), ("a", 2, day, 9.0, "Declined"), ("a", 3, None, 1.0, None)], SCHEMA
    )
    (r,) = history.application_profile(df).collect()
    assert (r["total_applications"], r["successful_applications"]) == (3, 1)
    assert (r["max_amount"], r["max_accepted_amount"], r["last_application_date"]) == (9.0, 5.0, day)


def test_asof_features_against_brute_force(frame):
    rng = random.Random(6)
    start = date(2024, 1, 1)
    moves = [
        (rng.choice("ab"), start + timedelta(days=rng.randrange(30)), float(rng.randrange(-9, 9)),
         None if rng.random() < 0.2 else float(rng.randrange(50)))
        for _ in range(300)
    ]
    moves.append(("a", None, 100.0, 1.0))
    asked = [(rng.choice("abc"), n, start + timedelta(days=rng.randrange(30)), 1.0, None) for n in range(60)]
    df = history.asof_balance_features(
        frame(asked, SCHEMA), frame(moves, "id string, dt date, amount double, balance double")
    )
    rows = df.collect()
    assert len(rows) == len(asked)
    for r in rows:
        before = [m for m in moves if m[0] == r["id"] and m[1] and m[1] < r["dt"]]
        held = [m[3] for m in before if m[3] is not None]
        assert r["asof_transactions"] == len(before)
        assert r["asof_net_flow"] == pytest.approx(sum(m[2] for m in before))
        assert r["asof_min_balance"] == (min(held) if held else None)
        assert r["asof_avg_balance"] == (pytest.approx(sum(held) / len(held)) if held else None)


def test_a_hot_customer_with_sparse_numbers_has_few_blocks(spark):
    rows = spark.range(20_000).selectExpr(
        "case when id % 5 < 2 then 'hot' else cast(id % 50 as string) end as id",
        "xxhash64(id) as app_id",
        "date_add(date '2024-01-01', cast(case when id % 5 = 0 then 7 else id % 30 end as int)) as dt",
        "cast(id % 100 as double) as amount",
        "'TakeUp' as outcome",
    )
    marked = rows.withColumns({"_day": F.datediff("dt", F.lit("1970-01-01").cast("date")), "_hit": F.lit(1), "_won": F.col("amount")})
    cut = history.cut_days(marked, "id", "app_id", 500)
    blocks = history.history_blocks(cut, "id").where("id = 'hot'")
    assert blocks.count() <= 30 + 8_000 // 500 + 1
    assert blocks.agg(F.max("n")).first()[0] <= 2 * 500
    whole = history.application_history(rows).select("app_id", "prior_applications", "prior_max_amount")
    assert history.application_history(rows, block_rows=500).select(*whole.columns).exceptAll(whole).isEmpty()


def test_an_unknown_date_is_never_earlier(frame):
    day = date(2024, 5, 1)
    rows = [("a", 1, None, 5.0, "TakeUp"), ("a", 2, day, 6.0, "TakeUp"), ("a", 3, day + timedelta(days=1), 6.0, None)]
    extra = frame([("a", "x")], "id string, more string")
    got = history.application_history(frame(rows, SCHEMA), strict=True, attributes=extra).collect()
    assert {r["app_id"]: (r["prior_applications"], r["more"]) for r in got} == {1: (0, "x"), 2: (0, "x"), 3: (1, "x")}
