from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import fixed_values as fixed


def values(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_category_spellings(frame):
    raw = [" male", "FEMALE", "f", "M ", "x", "", None]
    df = frame([(v,) for v in raw], "g string").coalesce(1)
    assert values(df, C.normalize_category(F.col("g"))) == [
        "Male", "Female", "Female", "Male", "Unknown", "Unknown", "Unknown",
    ]


def test_encoding_keeps_unknown_apart(frame):
    df = frame([("Female",), ("Male",), ("Unknown",), (None,)], "g string").coalesce(1)
    assert values(df, C.encode_category(F.col("g"))) == [0, 1, -1, -1]
    assert values(df, C.unknown_indicator(F.col("g"))) == [0, 0, 1, None]


def test_age_range_and_bands(frame):
    df = frame([(-1.0,), (0.0,), (25.0,), (26.0,), (65.0,), (66.0,), (121.0,), (None,)], "a double").coalesce(1)
    assert values(df, C.null_outside(F.col("a"))) == [None, 0.0, 25.0, 26.0, 65.0, 66.0, None, None]
    assert values(df, C.banded(F.col("a")))[2:6] == ["<=25", "26-35", "51-65", "65+"]
    assert values(df, C.banded(F.col("a")))[-1] == "Unknown"
    assert values(df, C.banded(F.col("a"), missing_label=None))[-1] == "65+"


def test_ratios_and_markers(frame):
    df = frame([(6.0, 0.0), (6.0, 3.0), (6.0, None)], "n double, d double").coalesce(1)
    assert values(df, C.guarded_ratio(F.col("n"), F.col("d"))) == [6.0, 2.0, None]
    df = frame([(1, 2), (0, 0), (None, None)], "h int, n int").coalesce(1)
    assert values(df, C.rate_or_marker(F.col("h"), F.col("n"))) == [0.5, -1.0, -1.0]


def test_recency(frame):
    df = frame([(date(2024, 1, 1),), (None,)], "d date").coalesce(1)
    assert values(df, C.recency_days(F.col("d"), "2024-01-31")) == [30, 9999]


def test_clip_is_idempotent_and_keeps_null(frame):
    df = frame([(-5.0,), (3.0,), (50.0,), (None,)], "x double").coalesce(1)
    once = df.select(C.clip(F.col("x"), 0.0, 10.0).alias("x"))
    assert values(once, F.col("x")) == [0.0, 3.0, 10.0, None]
    assert values(once, C.clip(F.col("x"), 0.0, 10.0)) == [0.0, 3.0, 10.0, None]
    assert values(df, C.clip(F.col("x"), None, None)) == [-5.0, 3.0, 50.0, None]


def test_life_stages(frame):
    rows = [(20, 1.0), (20, 9.0), (40, 1.0), (40, 9.0), (70, 1.0), (70, 9.0), (20, 5.0), (20, None), (None, 9.0), (70, None)]
    df = frame(rows, "age int, income double").coalesce(1)
    stage = C.life_stage(F.col("age"), F.col("income"), (30, 60), 5.0)
    assert values(df, stage) == [
        "Young_LowIncome", "Young_HighIncome", "MidAge_LowIncome", "MidAge_HighIncome",
        "Senior_Stable", "Senior_Stable", "Young_LowIncome", "MidAge_LowIncome", "MidAge_LowIncome", "Senior_Stable",
    ]
    flags = df.select(stage.alias("s")).select(*[c.alias(n) for n, c in C.one_hot(F.col("s"), C.life_stage_names(), "f_").items()])
    assert all(sum(r) == 1 for r in flags.collect())


def test_quadrants_first_rule_wins(frame):
    rows = [
        (10.0, 2.0, 9, 1.0, 0, -1.0),  # untapped, although volatile
        (1.0, 1.3, 0, 1.0, 0, -1.0),  # volatile
        (1.0, 1.2, 6, 1.0, 0, -1.0),  # low balances
        (10.0, 1.0, 5, 1.0, 2, 0.69),  # poor record
        (10.0, 1.2, 5, 1.0, 2, 0.90),  # ideal
        (10.0, 1.2, 5, 0.0, 2, 0.90),  # no inflow
        (1.0, 1.0, 0, 1.0, 1, 0.80),  # other
    ]
    names = "income double, balance_volatility_index double, low_balance_frequency int, net_cash_flow double"
    df = frame(rows, names + ", total_applications int, acceptance_rate double").coalesce(1)
    quadrant = C.first_rule(fixed.QUADRANT_RULES, fixed.QUADRANT_OTHER, {"income_median": 5.0})
    assert [q.split("_")[1] for q in values(df, quadrant)] == ["C", "B", "B", "B", "A", "D", "D"]
