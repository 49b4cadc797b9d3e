from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import modeling
from tidemark.session import scratch_path
from tidemark.streaming import runtime, telemetry

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, status string, latency_s double, score double, id string"


def requests(n=400, gap=37):
    return [
        (START + timedelta(seconds=i * gap), "error" if i % 7 == 0 else "ok", (i % 50) / 10, (i % 11) / 10, f"c{i % 3}")
        for i in range(n)
    ]


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_sliding_counts_against_brute_force(frame):
    data = requests(60)
    got = {r["window_start"]: (r["n"], r["errors"], r["error_pct"]) for r in telemetry.error_rate(frame(data, SCHEMA)).collect()}
    for start, (n, errors, pct) in got.items():
        inside = [d for d in data if start <= d[0] < start + timedelta(minutes=5)]
        assert n == len(inside) and errors == sum(d[1] == "error" for d in inside)
        assert pct == pytest.approx(100 * errors / n)
    assert sum(n for n, _, _ in got.values()) == 5 * len(data)


def test_rates_means_and_buckets(frame):
    df = frame(requests(60), SCHEMA)
    whole = telemetry.request_rate(df).groupBy("window_start").agg(F.sum("n").alias("n"))
    parts = telemetry.rate_by_status(df).groupBy("window_start").agg(F.sum("n").alias("n"))
    assert rows(whole) == rows(parts)
    for r in telemetry.windowed_mean(df, "score").collect():
        assert r["mean_value"] == pytest.approx(r["total"] / r["n"])
    for start in {r["window_start"] for r in telemetry.score_buckets(df).limit(50).collect()}:
        buckets = [r["n"] for r in telemetry.score_buckets(df).where(F.col("window_start") == F.lit(start)).collect()]
        assert len(buckets) == 12 and max(buckets) > 0
        break
    with pytest.raises(ValueError):
        telemetry.request_rate(df, 300, 70)


def test_bucket_quantile_interpolates(frame):
    data = [(START, "ok", v, 0.0, "a") for v in (0.05, 0.05, 0.2, 0.2, 0.2, 0.2, 0.4, 0.4, 9.0, 9.0)]
    found = telemetry.bucket_quantile(
        frame(data, SCHEMA), "latency_s", (0.1, 0.3, 0.5), {"p20": 0.2, "p50": 0.5, "p95": 0.95}, 60, 60
    ).first()
    assert found["p20"] == pytest.approx(0.1)
    assert found["p50"] == pytest.approx(0.1 + 0.2 * 3 / 4)
    assert found["p95"] == 0.5


def test_value_on_a_bound_counts_under_it(frame):
    data = [(START, "ok", 0.0, s, "a") for s in (0.0, 0.1, 0.15, 1.0, 1.5)]
    got = {r["le"]: r["n"] for r in telemetry.score_buckets(frame(data, SCHEMA), length=60, slide=60).collect()}
    assert (got["0.0"], got["0.1"], got["0.2"], got["1.0"], got["+Inf"]) == (1, 2, 3, 4, 5)


def test_profiles_are_weighted_by_requests(frame):
    df = frame(requests(30, 10), SCHEMA)
    people = frame([("c0", 10.0, "Male"), ("c1", 20.0, "Female"), ("c2", None, "Unknown")], "id string, income double, gender string")
    sums = telemetry.feature_sum_rate(df, people, "id", ["income"], 60, 60).orderBy("window_start").first()
    assert sums["income"] == pytest.approx((2 * 10 + 2 * 20) / 60)
    mix = {r["gender"]: r["n"] for r in telemetry.gender_mix(df, people, "id").collect()}
    assert mix == {"Male": 10, "Female": 10, "Unknown": 10}
    assert telemetry.latest_batch_mean(df, people, "id", "income").first()["mean_value"] == 15.0
    buckets = telemetry.feature_buckets(df, people, "id", "income", [15.0], 300, 300)
    assert {r["le"]: r["n"] for r in buckets.collect()} == {"15.0": 10, "+Inf": 20}


def test_freshness(frame):
    df = frame(requests(3, 60), SCHEMA)
    late = telemetry.source_freshness(df, "2024-01-01 01:02:00", 600).first()
    assert late["lag_seconds"] == 3600 and late["is_stale"]
    assert telemetry.source_freshness(df.limit(0), "2024-01-01", 600).first()["is_stale"]


def inbox(spark, frame, batches):
    path = scratch_path(spark, "inbox")
    for batch in batches:
        frame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize(
    "operator",
    [
        telemetry.rate_by_status,
        telemetry.error_rate,
        telemetry.daily_total,
        telemetry.score_buckets,
        lambda df: telemetry.windowed_mean(df, "score"),
        lambda df: telemetry.bucket_quantile(df, "latency_s", (0.5, 2.0), {"p95": 0.95}),
    ],
)
def test_stream_equals_table_on_closed_ranges(spark, frame, operator):
    data = requests(3000, 60)
    path = inbox(spark, frame, [data[:1500], data[1500:]])
    stream = runtime.file_stream(spark, path, frame([], SCHEMA).schema, files_per_batch=1)
    streamed = runtime.drain_to_table(operator(telemetry.with_watermark(stream, "10 minutes")), scratch_path(spark, "out"))
    closed = max(d[0] for d in data) - timedelta(minutes=10)
    table = operator(frame(data, SCHEMA)).where(F.col("window_end") <= F.lit(closed))
    assert rows(streamed) == rows(table)


def test_late_rows_are_left_out(spark, frame):
    early, far = (START, "ok", 0.1, 0.1, "a"), (START + timedelta(hours=5), "ok", 0.1, 0.1, "a")
    path = scratch_path(spark, "inbox")
    schema = frame([], SCHEMA).schema
    progress, out = scratch_path(spark, "progress"), scratch_path(spark, "out")

    def run(batch):
        frame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = telemetry.with_watermark(runtime.file_stream(spark, path, schema), "1 minute")
        return runtime.drain_to_table(telemetry.request_rate(stream, 60, 60), out, progress)

    run([early, far])
    final = run([(START + timedelta(seconds=5), "ok", 0.1, 0.1, "a"), (START + timedelta(hours=9), "ok", 0.1, 0.1, "a")])
    assert {r["window_start"]: r["n"] for r in final.collect()} == {START: 1, START + timedelta(hours=5): 1}


def test_scores_and_monitors_per_batch(spark, frame):
    train = frame([(i, i % 2, float(i % 2) + i / 100) for i in range(40)], "id long, target int, x double")
    model = modeling.fit_classifier(train, ["x"], "target")
    path = scratch_path(spark, "arriving")
    train.write.parquet(path)
    stream = runtime.file_stream(spark, path, train.schema)
    scored = runtime.drain_to_table(runtime.score_stream(model, stream), scratch_path(spark, "scores"))
    assert rows(scored) == rows(modeling.with_scores(model, train).select("id", "score"))

    means = scratch_path(spark, "means")
    query = runtime.latest_mean_sink(runtime.file_stream(spark, path, train.schema), "x", means, scratch_path(spark, "progress"))
    query.awaitTermination()
    expected = train.agg(F.avg("x")).first()[0]
    assert spark.read.parquet(means).agg(F.max_by("mean_value", "batch")).first()[0] == pytest.approx(expected)

    drifts = scratch_path(spark, "drifts")
    query = runtime.drift_sink(
        runtime.file_stream(spark, path, train.schema), train, "x", [(F.col("id") % 2).alias("half")], drifts, scratch_path(spark, "progress")
    )
    query.awaitTermination()
    assert spark.read.parquet(drifts).count() == 2
