import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cleaning import clean_customers, clean_transactions, clean_with_thresholds, impute_median, parse_dates, winsorize
from tidemark.operators.prefix import grouped_quantiles, running_sums
from tidemark.operators.quality import empirical_thresholds
from tidemark.operators.quantiles import approx_quantile_table, exact_quantiles, filled_quantiles, quantile_table, quantiles_by_group

LEVELS = [0.0, 0.01, 0.1, 0.33, 0.5, 0.9, 0.99, 1.0]


def by_rank(values, level):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(round(level * len(kept), 9))) - 1]


def samples():
    rng = random.Random(7)
    return {
        "normal": [rng.gauss(0, 100) for _ in range(3000)],
        "hot": [42.0] * 1500 + [rng.uniform(-1e6, 1e6) for _ in range(1500)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-20, 300) for _ in range(2000)],
        "whole": [float(rng.randrange(20)) for _ in range(999)],
        "tiny": [5e-324 * rng.randrange(3) for _ in range(100)],
        "ends": [math.inf, -math.inf, 1.0, 2.0, math.nan, None],
        "one": [3.5],
    }


@pytest.mark.parametrize("name", list(samples()))
@pytest.mark.parametrize("few_rows", [0, 20_000])
def test_equals_sorted_rank(frame, name, few_rows):
    values = samples()[name]
    df = frame([(v,) for v in values], "x double").repartition(5)
    found = exact_quantiles(df, {"x": LEVELS}, few_rows=few_rows, cells=16)["x"]
    assert found == [by_rank(values, p) for p in LEVELS]


def test_several_columns_in_one_call_and_empty_column(frame):
    rng = random.Random(1)
    rows = [(rng.random(), rng.randrange(9), None) for _ in range(400)]
    df = frame(rows, "a double, b int, c double")
    found = exact_quantiles(df, {"a": [0.5], "b": [0.25, 0.75], "c": [0.5]}, few_rows=10)
    assert found["a"] == [by_rank([r[0] for r in rows], 0.5)]
    assert found["b"] == [by_rank([float(r[1]) for r in rows], p) for p in (0.25, 0.75)]
    assert found["c"] == [None]
    assert exact_quantiles(df.limit(0), {"a": [0.5]})["a"] == [None]


def test_independent_of_partitioning(frame):
    rng = random.Random(3)
    df = frame([(rng.gauss(0, 1),) for _ in range(1000)], "x double")
    results = {tuple(exact_quantiles(df.repartition(n), {"x": LEVELS})["x"]) for n in (1, 5, 13)}
    assert len(results) == 1


def test_tables(frame):
    df = frame([(float(i),) for i in range(1, 101)], "x double")
    rows = quantile_table(df, {"x": [0.1, 0.5]}).collect()
    assert [tuple(r) for r in rows] == [("x", 0.1, 10.0), ("x", 0.5, 50.0)]
    approx = {r["level"]: r["value"] for r in approx_quantile_table(df, {"x": [0.01, 0.99]}).collect()}
    assert approx[0.01] <= 2 and approx[0.99] >= 98


@pytest.mark.parametrize("rows_per_bucket", [7, 100, 10**6])
def test_running_sums(frame, rows_per_bucket):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), float(rng.randrange(60)) if rng.random() < 0.9 else 17.0) for _ in range(600)]
    rows += [("a", None), ("b", math.nan)]
    df = frame(rows, "g string, x double").repartition(3)
    usable = [(g, x) for g, x in rows if x is not None and not math.isnan(x)]

    plain, totals = running_sums(df, "x", {"n": F.lit(1)}, rows_per_bucket=rows_per_bucket)
    got = {r["x"]: (r["n"], r["upto_n"], r["all_n"]) for r in plain.collect()}
    assert totals["n"] == len(usable)
    for x, (n, upto, whole) in got.items():
        assert n == sum(v == x for _, v in usable)
        assert upto == sum(v <= x for _, v in usable)
        assert whole == len(usable)

    grouped, _ = running_sums(df, "x", {"n": F.lit(1)}, ["g"], rows_per_bucket=rows_per_bucket)
    for r in grouped.collect():
        assert r["upto_n"] == sum(g == r["g"] and v <= r["x"] for g, v in usable)
        assert r["all_n"] == sum(g == r["g"] for g, _ in usable)


@pytest.mark.parametrize("rows_per_bucket", [9, 10**6])
def test_grouped_quantiles(frame, rows_per_bucket):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.gauss(0, 10)) for _ in range(500)]
    df = frame(rows, "g string, x double")
    disc = grouped_quantiles(df, ["g"], "x", {"lo": 0.1, "mid": 0.5}, rows_per_bucket=rows_per_bucket)
    for r in disc.collect():
        own = [x for g, x in rows if g == r["g"]]
        assert (r["lo"], r["mid"]) == (by_rank(own, 0.1), by_rank(own, 0.5))
    mixed = grouped_quantiles(df, ["g"], "x", {"q": 0.25}, interpolate=True, rows_per_bucket=rows_per_bucket)
    for r in mixed.collect():
        own = sorted(x for g, x in rows if g == r["g"])
        at = (len(own) - 1) * 0.25
        low = int(at)
        assert r["q"] == pytest.approx(own[low] + (own[low + 1] - own[low]) * (at - low))


def test_imputation_flags_before_filling(frame):
    df = frame([(1.0,), (2.0,), (9.0,), (None,)], "x double")
    rows = impute_median(df, ["x"], {"x": "was_missing"}).orderBy("was_missing", "x").collect()
    assert [tuple(r) for r in rows] == [(1.0, 0), (2.0, 0), (9.0, 0), (2.0, 1)]
    empty = impute_median(frame([(None,)], "x double"), ["x"]).collect()
    assert empty[0]["x"] is None


def test_customers_cleaned(frame):
    rows = [("01", " f", 999.0, 5.0), ("02", None, 30.0, None), ("03", "M", 41.0, 7.0), ("04", "M", -2.0, 1e9)]
    got = {r["id"]: r for r in clean_customers(frame(rows, "id string, gender string, age double, income double")).collect()}
    assert got["01"]["gender"] == "Female" and got["02"]["gender"] == "Unknown"
    assert [got[i]["age"] for i in ("01", "02", "03", "04")] == [30, 30, 41, 30]
    assert got["02"]["income"] == 7.0 and got["04"]["income"] == 1e9


def test_transactions_cleaned_keep_negative(frame):
    rows = [("a", "2024-01-02", "5", -3.0), ("a", "no date", "x", None), ("a", "2024-01-03", "1", 4.0)]
    df = clean_transactions(frame(rows, "id string, dt string, amount string, balance double"))
    got = sorted((str(r["dt"]), r["amount"], r["balance"], r["balance_missing"]) for r in df.collect())
    assert got == [("2024-01-02", 5.0, -3.0, 0), ("2024-01-03", 1.0, 4.0, 0), ("None", None, -3.0, 1)]


def test_parse_dates(frame):
    df = frame([("2024-02-29",), ("2024-13-45",), ("x",), (None,)], "d string").coalesce(1)
    assert [str(r["d"]) for r in parse_dates(df, ["d"]).collect()] == ["2024-02-29", "None", "None", "None"]


def test_winsorize_is_idempotent(frame):
    rng = random.Random(2)
    df = frame([(rng.gauss(0, 1),) for _ in range(1000)] + [(None,)], "x double")
    once = winsorize(df, ["x"])
    twice = winsorize(once, ["x"])
    key = lambda v: (v is None, v or 0)
    assert sorted((r["x"] for r in once.collect()), key=key) == sorted((r["x"] for r in twice.collect()), key=key)
    assert once.where("x is null").count() == 1


def test_many_narrow_clusters_are_cut_to_size(spark):
    from tidemark.operators import prefix
    from tidemark.operators.quantiles import column_facts

    data = spark.range(10_000).selectExpr("cast((id % 250) * 1e6 + (id div 250) * 1e-3 as double) as x")
    cuts = prefix.split_points(data, "x", column_facts(data, ["x"])["x"], 25)
    values = sorted(r.x for r in data.collect())
    edges = [-1.0, *cuts, 1e12]
    from bisect import bisect_left

    sizes = [bisect_left(values, b) - bisect_left(values, a) for a, b in zip(edges, edges[1:])]
    assert sum(sizes) == 10_000 and max(sizes) <= 25


@pytest.mark.parametrize(("few_rows", "cells"), [(1, 4), (20, 16), (10**6, 4096)])
def test_quantiles_by_group(frame, few_rows, cells):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1e3), 7.0, -7.0, 0.0, rng.gauss(0, 1e-3)])) for _ in range(600)]
    rows += [("hot", 5.0)] * 50 + [("hot", 5.0 + 1e-9)] * 50 + [("one", -3.0), ("two", 1e300), ("two", -1e300)]
    df = frame(rows + [("void", None), ("void", math.nan), ("a", None)], "g string, x double")
    disc = quantiles_by_group(df, ["g"], "x", {"lo": 0.1, "mid": 0.5, "top": 1.0, "least": 0.0}, few_rows=few_rows, cells=cells).collect()
    assert {r["g"] for r in disc} == {"a", "b", None, "hot", "one", "two"}
    for r in disc:
        own = [x for g, x in rows if g == r["g"]]
        assert (r["lo"], r["mid"], r["top"], r["least"]) == (by_rank(own, 0.1), by_rank(own, 0.5), max(own), min(own))
        assert (r["n"], r["min_value"], r["max_value"]) == (len(own), min(own), max(own))
        assert r["mean"] == pytest.approx(sum(own) / len(own), abs=1e-6)
    for r in quantiles_by_group(df, ["g"], "x", {"q": 0.25}, interpolate=True, few_rows=few_rows, cells=cells).collect():
        own = sorted(x for g, x in rows if g == r["g"])
        at = (len(own) - 1) * 0.25
        low = int(at)
        assert r["q"] == pytest.approx(own[low] + (own[min(low + 1, len(own) - 1)] - own[low]) * (at - low))


def test_quantiles_by_group_of_several_columns_and_of_no_rows(frame):
    df = frame([("a", 1, math.inf), ("a", 1, 2.0), ("a", 2, -math.inf), (None, None, 4.0)], "g string, x int, n double")
    got = {(r["g"], r["x"]): r["half"] for r in quantiles_by_group(df, ["g", "x"], "n", {"half": 0.5}).collect()}
    assert got == {("a", 1): 2.0, ("a", 2): -math.inf, (None, None): 4.0}
    assert quantiles_by_group(df.limit(0), ["g"], "n", {"half": 0.5}).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_of_filled_columns(frame, seed):
    rng = random.Random(seed)
    share = [0.0, 0.2, 0.9, 0.5][seed]
    rows = [
        tuple(None if rng.random() < share else rng.choice([rng.gauss([5, -5][seed % 2], 9), 2.0, 0.0, -1.0]) for _ in "ab") + (None,)
        for _ in range(150)
    ]
    levels = {"a": [0.0, 0.1, 0.33, 0.5, 0.66, 1.0], "b": [0.1, 0.3, 0.9], "void": [0.5]}
    medians, found = filled_quantiles(frame(rows, "a double, b double, void double"), levels, {"b": 0.0})
    for i, c in enumerate(("a", "b")):
        middle = by_rank([r[i] for r in rows], 0.5)
        filled = [middle if r[i] is None else r[i] for r in rows]
        kept = [v for v in filled if c == "a" or v > 0]
        assert medians[c] == middle
        assert found[c] == [by_rank(kept, p) for p in levels[c]]
    assert (medians["void"], found["void"]) == (None, [None])


def test_cleaning_with_thresholds_is_cleaning_and_then_thresholds(frame):
    rng = random.Random(9)
    people = frame(
        [(str(i), rng.choice(["male ", None, "FEMALE"]), rng.choice([None, 200.0, 18.5, rng.uniform(18, 90)]), rng.choice([None, rng.uniform(0, 9e4)])) for i in range(80)],
        "id string, gender string, age double, income double",
    )
    moves = frame(
        [(str(i % 9), rng.choice(["2024-01-05", "x", None]), "1.5", rng.choice([None, rng.gauss(10, 30)])) for i in range(200)],
        "id string, dt string, amount string, balance double",
    )
    for known in (moves, moves.limit(0), moves.withColumn("balance", -F.abs("balance"))):
        got_people, got_moves, thresholds = clean_with_thresholds(people, known)
        assert sorted(map(str, got_people.collect())) == sorted(map(str, clean_customers(people).collect()))
        assert sorted(map(str, got_moves.collect())) == sorted(map(str, clean_transactions(known).collect()))
        assert thresholds == empirical_thresholds(clean_transactions(known), clean_customers(people))
