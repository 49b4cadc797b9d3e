from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sampling, sketches


def hashed(key, seed=42):
    return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:13], 16)


def drawn(rows, size):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return sorted((x for held in groups.values() for x in sorted(held, key=lambda r: (hashed(r[1]), r[1]))[:size]), key=str)


@pytest.mark.parametrize("max_rows", [100_000, 3, 1])
def test_hash_sample_against_sorting(frame, max_rows):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None, ""]), f"k{i}", i) for i in range(900)] + [("small", "k", 1), ("b ", "k", 2)]
    df = frame(rows, "grp string, id string, of long").repartition(5)
    for size in (0, 1, 40, 5000):
        found = sampling.hash_sample(df, size, F.col("id"), ["grp"], max_rows=max_rows)
        assert found.columns == df.columns
        assert sorted((tuple(r) for r in found.collect()), key=str) == drawn(rows, size)


def test_hash_sample_without_groups_and_of_repeated_rows(frame):
    rows = [("a", "same", i) for i in range(50)] + [("a", f"k{i}", i) for i in range(50)]
    df = frame(rows, "grp string, id string, n long")
    for size in (7, 60, 100, 200):
        found = sampling.hash_sample(df, size, F.col("id"), max_rows=5).collect()
        assert sorted(r["id"] for r in found) == sorted(r[1] for r in sorted(rows, key=lambda r: (hashed(r[1]), r[1]))[:size])
    assert sampling.hash_sample(df.limit(0), 5, F.col("id"), ["grp"]).count() == 0


def test_sketches_merge_within_their_bound(frame):
    rng = random.Random(3)
    rows = [(date(2024, 1, 1) + timedelta(i % 40), rng.choice([rng.lognormvariate(0, 2), 5.0, None, float("nan")]), None) for i in range(20_000)]
    df = frame(rows, "day date, x double, y double").repartition(6)
    daily = sketches.sketch_table(df, ["x", "y"], [F.col("day")], size=200)
    assert daily.count() == 40 and daily.schema["x"].dataType.typeName() == "binary"
    levels = {"x": [0.01, 0.25, 0.5, 0.9, 0.999], "y": [0.5]}
    found = sketches.sketched_quantiles(daily, levels)
    errors = sketches.rank_errors(df, found).collect()
    known = [x for _, x, _ in rows if x is not None and x == x]
    assert [r["column_name"] for r in errors] == ["x"] * 5 and {r["n"] for r in errors} == {len(known)}
    for r in errors:
        below, upto = sum(x < r["value"] for x in known) / len(known), sum(x <= r["value"] for x in known) / len(known)
        assert r["rank_error"] == pytest.approx(max(below - r["level"], r["level"] - upto, 0))
        assert r["rank_error"] <= sketches.rank_bound(200)


def test_sketches_of_nothing(frame):
    df = frame([], "day date, x double")
    found = sketches.sketched_quantiles(sketches.sketch_table(df, ["x"], [F.col("day")]), {"x": [0.5]})
    assert found.count() == 0 and sketches.rank_errors(df, found).count() == 0
