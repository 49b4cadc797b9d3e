import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import pvalues
from tidemark.operators import charts, drift, evaluation, quality, selection


def one(df):
    (row,) = df.collect()
    return row


def test_orphans(frame):
    parents = frame([("a",), ("b",), (None,)], "id string")
    children = {"x": frame([("a",), ("z",), ("z",)], "id string"), "y": frame([("b",)], "id string")}
    got = {r["child"]: (r["orphan_keys"], r["passed"]) for r in quality.referential_integrity(parents, children).collect()}
    assert got == {"x": (1, False), "y": (0, True)}


def test_fence_matches_the_recorded_arithmetic(frame):
    # quartiles 9419 and 10510 give the fence 7782.5 .. 12146.5
    values = [9419.0] * 25 + [10000.0] * 49 + [10510.0] * 25 + [99999.0]
    r = one(quality.iqr_outliers(frame([(v,) for v in values], "income double"), ["income"]))
    assert (r["lower_bound"], r["upper_bound"]) == (7782.5, 12146.5)
    assert (r["n_outliers"], r["pct_outliers"], r["n_sentinel_hits"], r["max_value"]) == (1, 1.0, 1, 99999.0)


def test_fence_of_an_empty_column(frame):
    r = one(quality.iqr_outliers(frame([(None,)], "x double"), ["x"]))
    assert r["lower_bound"] is None and r["n_outliers"] == 0


@pytest.mark.parametrize("part,whole,pct", [(69, 2500, 2.76), (33, 3203, 1.03), (177, 2500, 7.08), (2745, 3203, 85.7), (0, 0, 0.0)])
def test_recorded_percentages(spark, part, whole, pct):
    assert spark.range(1).select(quality.percent(F.lit(part), F.lit(whole))).first()[0] == pct


def test_negative_values(frame):
    df = frame([("a", -4.0), ("a", 2.0), ("b", -2.0), ("c", None)], "id string, balance double")
    r = one(quality.negative_values(df))
    assert tuple(r) == (2, 50.0, 2, 66.67, -4.0, -3.0)
    none = one(quality.negative_values(df.where("balance > 0")))
    assert tuple(none) == (0, 0.0, 0, 0.0, None, None)


def test_thin_history(frame):
    df = frame([(i,) for i in range(1, 101)], "n int")
    assert tuple(one(quality.thin_history(df, "n"))) == (0.05, 5.0, 5, 5.0)
    flagged = quality.thin_history_flag(df, "n", 5.0)
    assert flagged.agg(F.sum("flag_insufficient_history")).first()[0] == 5


def test_class_balance_counts_null(frame):
    df = frame([("x",), ("x",), (None,), ("y",)], "c string")
    assert {r["c"]: (r["n"], r["pct"]) for r in quality.class_balance(df, "c").collect()} == {
        "x": (2, 50.0), None: (1, 25.0), "y": (1, 25.0),
    }


def chi_by_cells(cells, correct):
    rows, cols = sorted({a for a, _ in cells}), sorted({b for _, b in cells})
    n = sum(cells.values())
    total = 0.0
    for a in rows:
        for b in cols:
            e = sum(v for (x, _), v in cells.items() if x == a) * sum(v for (_, y), v in cells.items() if y == b) / n
            d = abs(cells.get((a, b), 0) - e)
            total += (d - (min(0.5, d) if correct else 0)) ** 2 / e
    return total


@pytest.mark.parametrize(
    "cells",
    [
        {("p", "x"): 12, ("p", "y"): 5, ("q", "x"): 3, ("q", "y"): 9},
        {("p", "x"): 10, ("p", "y"): 10, ("q", "x"): 10, ("q", "y"): 10},
        {("p", "x"): 7, ("q", "y"): 9},
        {("p", "x"): 4, ("p", "y"): 6, ("p", "z"): 5, ("q", "x"): 9, ("q", "z"): 2},
    ],
)
def test_chi_square(frame, cells):
    df = frame([k for k, n in cells.items() for _ in range(n)], "a string, b string")
    r = one(drift.chi_square(df, "a", "b"))
    columns = len({b for _, b in cells})
    assert r["degrees_of_freedom"] == columns - 1
    assert r["chi2_statistic"] == pytest.approx(chi_by_cells(cells, columns == 2), abs=1e-9)


def test_chi_square_null_is_a_category(frame):
    df = frame([("p", "x"), ("p", None), ("q", "x"), (None, None)], "a string, b string")
    assert one(drift.chi_square(df, "a", "b"))["degrees_of_freedom"] == 2
    test = one(drift.chi_square_test(df, "a", "b"))
    assert test["p_value"] == pytest.approx(pvalues.chi_square(test["chi2_statistic"], 2))


@pytest.mark.parametrize("rows_per_bucket", [11, 10**6])
def test_ks_and_its_symmetry(frame, rows_per_bucket):
    rng = random.Random(1)
    rows = [("a", round(rng.gauss(0, 1), 1)) for _ in range(150)] + [("b", round(rng.gauss(0.5, 1), 1)) for _ in range(90)]
    rows += [("c", 0.0), ("a", None)]
    df = frame(rows, "g string, x double")
    a = [x for g, x in rows if g == "a" and x is not None]
    b = [x for g, x in rows if g == "b"]
    expected = max(abs(sum(v <= t for v in a) / len(a) - sum(v <= t for v in b) / len(b)) for t in a + b)
    r = one(drift.ks_two_sample(df, "x", "g", "a", "b", rows_per_bucket))
    assert r["ks_statistic"] == pytest.approx(expected) and (r["n_a"], r["n_b"]) == (150, 90)
    assert one(drift.ks_two_sample(df, "x", "g", "b", "a", rows_per_bucket))["ks_statistic"] == pytest.approx(expected)


def test_ks_reports_an_empty_group(frame):
    r = one(drift.ks_test(frame([("a", 1.0)], "g string, x double"), "x", "g", "a", "b"))
    assert r["ks_statistic"] is None and r["error"]


def test_psi_of_itself_and_classes(frame):
    base = frame([(float(i),) for i in range(1000)], "x double")
    same = one(drift.psi(base, base, "x"))
    assert same["psi"] == 0 and same["stability"] == "stable" and same["num_bins"] == 10
    assert one(drift.psi(base, base.select((F.col("x") + 900).alias("x")), "x"))["stability"] == "significant_shift"


def test_psi_nulls_have_their_own_bin_unless_legacy(frame):
    base = frame([(float(i),) for i in range(100)], "x double")
    holes = frame([(float(i) if i % 2 else None,) for i in range(100)], "x double")
    own = one(drift.psi(base, holes, "x"))["psi"]
    # half of the rows are null: that bin is empty in the baseline
    expected = (0.5 - 1e-4) * math.log(0.5 / 1e-4) + 10 * (0.05 - 0.1) * math.log(0.05 / 0.1)
    assert own == pytest.approx(expected, rel=0.02)
    legacy = one(drift.psi(base, holes, "x", legacy=True))["psi"]
    assert legacy < own


def test_psi_degenerate_and_error(frame):
    two = frame([(0.0,), (1.0,)] * 10, "x double")
    r = one(drift.psi(two, two, "x"))
    assert r["is_degenerate"] and r["num_bins"] == 1 and r["psi"] == 0
    assert one(drift.psi(frame([(1.0,)], "x double"), two, "x"))["error"]


def test_correlation_and_variances(frame):
    df = frame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (4.0, 8.0, 9.0)], "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in quality.correlation_long(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["a", "c"] == got["c", "a"] and len(got) == 9
    constant = df.withColumn("k", F.lit(3.0))
    kept, dropped = selection.keep_varying(constant, ["a", "k", "b"])
    assert (kept, dropped) == (["a", "b"], ["k"])


def test_vif_and_pruning(frame):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((a, b, a + b + rng.gauss(0, 0.01), rng.gauss(0, 1)))
    df = frame(rows, "a double, b double, ab double, free double")
    factors = {r["feature"]: r["vif"] for r in selection.vif(df, df.columns).collect()}
    assert factors["ab"] > 1000 and factors["free"] == pytest.approx(1.0, abs=0.05)
    kept, dropped = selection.vif_prune(df, df.columns)
    assert dropped == ["ab"] and kept == ["a", "b", "free"]
    trap = df.withColumns({"f1": (F.col("a") > 0).cast("int"), "f2": (F.col("a") <= 0).cast("int")})
    assert all(r["is_singular"] for r in selection.vif(trap, ["f1", "f2", "free"]).collect())


def test_anova(frame):
    rows = [(0, 1.0, 5.0), (0, 2.0, 5.0), (0, 3.0, 5.0), (1, 5.0, 5.0), (1, 7.0, 5.0), (1, None, 5.0), (None, 9.0, 1.0)]
    df = frame(rows, "y int, x double, k double")
    got = {r["feature"]: r for r in selection.anova_f(df, ["x", "k"], "y").collect()}
    # groups (1, 2, 3) and (5, 7): between 19.2, within 2 + 2 on 3 degrees
    assert got["x"]["f_score"] == pytest.approx(19.2 / (4 / 3))
    assert math.isnan(got["k"]["f_score"])
    with pytest.raises(ValueError):
        selection.anova_f(df.where("y = 0"), ["x"], "y")


def scored(frame):
    rng = random.Random(2)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 1)) for _ in range(300)] + [(None, 0.4)]
    return rows, frame(rows, "y int, s double")


@pytest.mark.parametrize("rows_per_bucket", [20, 10**6])
def test_auc_counts_pairs(frame, rows_per_bucket):
    rows, df = scored(frame)
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    expected = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    r = one(evaluation.auc(df, "y", "s", rows_per_bucket))
    assert r["auc"] == pytest.approx(expected) and (r["n_positive"], r["n_negative"]) == (len(pos), len(neg))
    flipped = df.withColumn("s", -F.col("s"))
    assert one(evaluation.auc(flipped, "y", "s", rows_per_bucket))["auc"] == pytest.approx(1 - expected)
    assert one(evaluation.auc(df.where("y = 1"), "y", "s"))["auc"] is None


def test_auc_agrees_with_the_evaluator_and_the_curve(frame):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, df = scored(frame)
    known = df.where("y is not null").withColumn("y", F.col("y").cast("double"))
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    area = one(evaluation.auc(df, "y", "s"))["auc"]
    assert evaluator.evaluate(known) == pytest.approx(area)
    points = sorted((r["fpr"], r["tpr"]) for r in evaluation.roc_points(df, "y", "s").collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(points, points[1:])) == pytest.approx(area)


def test_confusion_is_zero_filled(frame):
    df = frame([(1, 1.0), (1, 1.0), (0, 1.0)], "y int, p double")
    got = {r["cell"]: r["n"] for r in evaluation.confusion_matrix(df, "y", "p").collect()}
    assert got == {"true_negative": 0, "false_positive": 1, "false_negative": 0, "true_positive": 2}


def test_fairness_reproduces_the_recorded_ratio(frame):
    rows = [("Female", int(i < 124), 30) for i in range(290)] + [("Male", int(i < 68), 40) for i in range(363)]
    df = frame(rows, "gender string, prediction int, age int")
    got = {(r["metric"], r["label"]): r["value"] for r in evaluation.fairness_report(df, "prediction").collect()}
    assert got["positive_rate_by_gender", "Female"] == pytest.approx(0.42758620689655175)
    assert got["positive_rate_by_gender", "Male"] == pytest.approx(0.18732782369146006)
    assert got["disparate_impact_ratio", "gender"] == pytest.approx(0.4381053941171243)
    assert got["four_fifths_flag", "gender"] == 1.0


def test_disparate_impact_edges(frame):
    single = evaluation.group_rates(frame([("a", 1)], "g string, p int"), "g", "p")
    assert one(evaluation.disparate_impact(single))["disparate_impact_ratio"] == 1.0
    never = evaluation.group_rates(frame([("a", 0), ("b", 0)], "g string, p int"), "g", "p")
    assert one(evaluation.disparate_impact(never))["disparate_impact_ratio"] is None


def test_histograms(frame):
    df = frame([("a", 0.0), ("a", 10.0), ("a", 9.99), ("b", 5.0), ("b", 5.0), ("b", None)], "g string, x double")
    counts = [r["n"] for r in charts.histogram(df, "x", 10).orderBy("bin").collect()]
    assert counts == [1, 0, 0, 0, 0, 2, 0, 0, 0, 2]
    grouped = charts.grouped_histogram(df, "x", "g", ["a", "b", "c"], 2).orderBy("g", "bin").collect()
    assert [(r["g"], r["bin_low"], r["n"]) for r in grouped] == [
        ("a", 0.0, 1), ("a", 5.0, 2), ("b", 4.5, 0), ("b", 5.0, 2),
    ]
    assert charts.histogram(df.limit(0), "x", 4).agg(F.sum("n")).first()[0] == 0


def test_box_and_top(frame):
    df = frame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), (None, 4.0)], "g string, x double")
    got = {r["g"]: tuple(r)[1:] for r in charts.box_stats(df, "x", "g").collect()}
    assert got["a"] == (4, 1.0, 1.75, 2.5, 4.75, 10.0, 4.0)
    assert got[None][0] == 1
    best = charts.top_n(frame([("b", 5), ("a", 5), ("c", 9)], "id string, v int"), "v", "id", 2).collect()
    assert [(r["rank"], r["id"]) for r in sorted(best, key=lambda r: r["rank"])] == [(1, "c"), (2, "a")]
