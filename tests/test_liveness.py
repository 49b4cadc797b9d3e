from __future__ import annotations

import math
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.streaming import liveness, runtime, telemetry

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, x double, id long"


def at(seconds):
    return START + timedelta(seconds=seconds)


def arrive(spark, frame, inbox, rows, run):
    frame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    run(runtime.file_stream(spark, inbox, frame([], SCHEMA).schema)).awaitTermination()


def forget_last_commit(checkpoint):
    """As after a failure between the writing of a batch and its commit."""
    path = f"{checkpoint.removeprefix('file://')}/commits"
    last = max(int(n) for n in os.listdir(path) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{path}/{name}"):
            os.remove(f"{path}/{name}")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("max_values", "kind"), [(100_000, "wide"), (1, "wide"), (1, "narrow"), (5, "signs")])
def test_range_quantile_against_sorting(frame, max_values, kind):
    rng = random.Random(kind)
    draw = {
        "wide": lambda: math.exp(rng.uniform(-20, 20)),
        "narrow": lambda: 1.0 + rng.randint(0, 200) * 2.0**-40,
        "signs": lambda: rng.choice([0.0, -0.0, -3.5, 3.5, -1e-300, 1e300, rng.uniform(-1, 1)]),
    }[kind]
    data = [(at(rng.randint(0, 900)), draw(), 1) for _ in range(300)] + [(at(5), None, 1), (at(7), float("nan"), 1), (None, 1.0, 1), (at(5000), None, 1)]
    levels = {"low": 0.0, "p10": 0.1, "mid": 0.5, "p99": 0.99, "top": 1.0}
    found = telemetry.range_quantile(frame(data, SCHEMA), "x", levels, 300, 60, max_values=max_values).collect()
    known = [(t, x) for t, x, _ in data if t is not None and x is not None and not math.isnan(x)]
    assert sum(r["n"] for r in found) == 5 * len(known)
    for r in found:
        inside = sorted(x for t, x in known if r["window_start"] <= t < r["window_end"])
        assert r["n"] == len(inside)
        for name, level in levels.items():
            assert r[name] == inside[max(math.ceil(round(len(inside) * level, 9)), 1) - 1], name


def test_range_quantile_of_nothing(frame):
    assert telemetry.range_quantile(frame([], SCHEMA), "x", {"mid": 0.5}).count() == 0


def test_silence_shows_at_every_heartbeat(spark, frame):
    events, beats = scratch_path(spark, "events"), scratch_path(spark, "beats")
    seconds = [*range(0, 3600, 40), *range(7200, 9000, 40)]  # an hour of silence, then the end
    frame([(at(s), 1.0, 1) for s in seconds], SCHEMA).write.parquet(events)
    frame([(at(s),) for s in range(0, 20_000, 300)], "tick timestamp").write.parquet(beats)
    stream = liveness.freshness_stream(
        runtime.file_stream(spark, events, frame([], SCHEMA).schema),
        runtime.file_stream(spark, beats, frame([], "tick timestamp").schema),
        600, 300, "10 minutes",
    )
    with liveness.heartbeats_lead(spark):
        found = runtime.drain_to_table(stream, scratch_path(spark, "out")).collect()
    assert len(found) == len([s for s in range(0, 20_000, 300) if s <= 19_800 - 600])
    for r in found:
        s = (r["tick"] - START).total_seconds()
        inside = [e for e in seconds if s - 600 <= e < s]
        assert r["n_events"] == len(inside) and r["is_stale"] == (not inside)
        assert r["lag_seconds"] == (s - max(inside) if inside else None)
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
    with pytest.raises(ValueError):
        liveness.freshness_stream(frame([], SCHEMA), frame([], "tick timestamp"), 100, 60, "1 minute")


def slices():
    return [
        [(at(s), s / 10, 1) for s in range(0, 4000, 100)],
        [(at(s), s / 10, 2) for s in range(3500, 8000, 100)] + [(at(50), 1.0, 9), (at(3399), 1.0, 9), (at(3400), 1.0, 9), (None, 1.0, 9)],
        [(at(s), s / 10, 3) for s in range(100, 9000, 700)],
    ]


def test_late_rows_are_kept_and_counted(spark, frame):
    inbox, path, progress = (scratch_path(spark, n) for n in ("inbox", "arrivals", "progress"))

    def run(stream):
        return liveness.arrival_sink(stream, 500, path, progress)

    newest, late = None, []
    for part in slices():
        arrive(spark, frame, inbox, part, run)
        late += [(t, x, i) for t, x, i in part if newest and t and t < newest - timedelta(seconds=500)]
        newest = max([t for t, _, _ in part if t] + ([newest] if newest else []))

    def check():
        everything, marks = liveness.arrivals(spark, path)
        assert rows(everything.where("is_late").select("ts", "x", "id")) == sorted(late, key=str)
        assert everything.count() == sum(map(len, slices())) == marks.agg(F.sum("n")).first()[0]
        assert marks.agg(F.sum("n_late")).first()[0] == len(late) > 0
        counted = liveness.accounted_ranges(spark, path, 600, 500).collect()
        assert sum(r["n"] for r in counted) == everything.where("ts is not null").count()
        for r in counted:
            assert r["state"] in ("closed", "open", "late")
            assert (r["state"] != "closed") or r["window_end"] <= newest - timedelta(seconds=500)

    check()
    forget_last_commit(progress)
    run(runtime.file_stream(spark, inbox, frame([], SCHEMA).schema)).awaitTermination()
    check()


def test_gauge_and_drift_are_the_same_after_a_replay(spark, frame):
    base = frame([(at(i), i / 10, i) for i in range(500)], SCHEMA)
    sinks = {
        "means": lambda stream, path, progress: runtime.latest_mean_sink(stream, "x", path, progress),
        "drift": lambda stream, path, progress: runtime.drift_sink(stream, base, "x", [F.col("id")], path, progress),
    }
    for name, sink in sinks.items():
        inbox, path, progress = (scratch_path(spark, n) for n in ("inbox", name, "progress"))

        def run(stream, sink=sink, path=path, progress=progress):
            return sink(stream, path, progress)

        for part in slices():
            arrive(spark, frame, inbox, part, run)
        first = rows(spark.read.parquet(path))
        forget_last_commit(progress)
        run(runtime.file_stream(spark, inbox, frame([], SCHEMA).schema)).awaitTermination()
        assert rows(spark.read.parquet(path)) == first and len(first) >= 3
        if name == "means":
            held = [[x for _, x, _ in part if x is not None] for part in slices()]
            found = {r["batch"]: (r["mean_value"], r["n"], r["is_newest"]) for r in runtime.latest_means(spark, path).collect()}
            assert found == {i: (pytest.approx(sum(h) / len(h)), len(h), i == 2) for i, h in enumerate(held)}
