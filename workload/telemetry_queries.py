"""Telemetry of scored requests, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import history
from tidemark.plans import serving
from tidemark.session import durable, scratch_path
from tidemark.streaming import liveness, runtime, telemetry

from .registry import query, r, rounded
from .views import (
    REQUEST_COLUMNS,
    REQUESTS_AS_OF,
    raw_applications,
    raw_customers,
    raw_requests,
    raw_transactions,
    table,
    using,
)

LATENCY_BOUNDS = (0.1, 0.25, 0.5, 1.0, 2.5)
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
AGE_BOUNDS = (20, 30, 40, 50, 60, 70)
RATIO_BOUNDS = (0.5, 1.0, 10.0, 50.0, 100.0)
FLOW_BOUNDS = (0.0, 10000.0, 50000.0, 100000.0, 500000.0)
PROFILE_FEATURES = (
    "inflow_count", "outflow_count", "avg_balance", "min_balance", "std_balance",
    "total_loans", "num_declined", "max_loan_amount", "mean_loan_amount",
)


def _ranges(length: int, slide: int, columns: str = "*", source: str = "raw_requests", pane: str = "ts") -> str:
    """Each request once per sliding range that covers it."""
    start = f"time_bucket(INTERVAL '{slide} seconds', {pane}, TIMESTAMP '1970-01-01')"
    shift = f"to_seconds(CAST(k.range AS BIGINT) * {slide})"
    return (
        f"ranges AS (SELECT {start} - {shift} AS window_start, "
        f"{start} - {shift} + INTERVAL '{length} seconds' AS window_end, {columns} "
        f"FROM {source}, range({length // slide}) k)"
    )


@query(
    "request_rate",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + f" SELECT window_start, window_end, count(*) AS n, {r('count(*) / 300')} AS per_second FROM ranges GROUP BY 1, 2",
    ),
)
def request_rate(spark, folder):
    return rounded(telemetry.request_rate(raw_requests(spark, folder)), ["per_second"])


@query(
    "rate_by_status",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + f" SELECT window_start, window_end, status, count(*) AS n, {r('count(*) / 300')} AS per_second "
        "FROM ranges GROUP BY 1, 2, 3",
    ),
)
def rate_by_status(spark, folder):
    return rounded(telemetry.rate_by_status(raw_requests(spark, folder)), ["per_second"])


@query(
    "error_rate",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + f""" SELECT window_start, window_end, count(*) AS n, count(*) FILTER (status = 'error') AS errors,
               {r("100.0 * count(*) FILTER (status = 'error') / greatest(count(*), 1e-9)")} AS error_pct
               FROM ranges GROUP BY 1, 2""",
    ),
)
def error_rate(spark, folder):
    return rounded(telemetry.error_rate(raw_requests(spark, folder)), ["error_pct"])


def _bucket_quantile_sql(level: float) -> str:
    """Rank in cumulative counts, first bucket that reaches it, linear inside."""
    branches, lower, under = [], 0.0, "0"
    for i, upper in enumerate(LATENCY_BOUNDS):
        branches.append(
            f"WHEN le{i} >= {level} * n THEN {lower} + ({upper} - {lower}) * ({level} * n - {under}) / (le{i} - {under})"
        )
        lower, under = upper, f"le{i}"
    return f"CASE {' '.join(branches)} ELSE {LATENCY_BOUNDS[-1]} END"


@query(
    "bucket_quantile",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + ", counted AS (SELECT window_start, window_end, count(*) AS n, "
        + ", ".join(f"count(*) FILTER (latency_s <= {b}) AS le{i}" for i, b in enumerate(LATENCY_BOUNDS))
        + " FROM ranges GROUP BY 1, 2) SELECT window_start, window_end, n, "
        + ", ".join(
            r(f"CAST({_bucket_quantile_sql(q)} AS DOUBLE)") + f" AS p{int(q * 100)}" for q in (0.5, 0.95, 0.99)
        )
        + " FROM counted",
    ),
)
def bucket_quantile(spark, folder):
    found = telemetry.bucket_quantile(
        raw_requests(spark, folder), "latency_s", LATENCY_BOUNDS, {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )
    return rounded(found, ["p50", "p95", "p99"])


@query(
    "windowed_mean",
    using(
        "raw_requests",
        ", " + _ranges(900, 60)
        + f""" SELECT window_start, window_end, {r('sum(score)')} AS total, count(score) AS n,
               {r('sum(score) / greatest(count(score), 1e-9)')} AS mean_value FROM ranges GROUP BY 1, 2""",
    ),
)
def windowed_mean(spark, folder):
    return rounded(telemetry.windowed_mean(raw_requests(spark, folder), "score"), ["total", "mean_value"])


@query(
    "daily_total",
    using(
        "raw_requests",
        "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, "
        "CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL '1 day' AS window_end, count(*) AS n "
        "FROM raw_requests GROUP BY 1, 2",
    ),
)
def daily_total(spark, folder):
    return telemetry.daily_total(raw_requests(spark, folder))


def _bounds_sql(bounds, value: str) -> str:
    names = ", ".join(f"('{float(b)}', CAST({b} AS DOUBLE))" for b in bounds)
    return f"(VALUES {names}, ('+Inf', NULL)) b(le, bound)", f"(bound IS NULL OR {value} <= bound)"


_SCORE_VALUES, _SCORE_TEST = _bounds_sql(SCORE_BOUNDS, "score")


@query(
    "score_buckets",
    using(
        "raw_requests",
        ", " + _ranges(900, 60)
        + f" SELECT window_start, window_end, le, count(*) FILTER ({_SCORE_TEST}) AS n "
        f"FROM ranges, {_SCORE_VALUES} GROUP BY 1, 2, 3",
    ),
)
def score_buckets(spark, folder):
    return telemetry.score_buckets(raw_requests(spark, folder))


def _profiles(spark, folder):
    return serving.serving_view(
        raw_customers(spark, folder), raw_applications(spark, folder), raw_transactions(spark, folder)
    )


_PROFILE_CTES = """, moves AS (
        SELECT id, count(*) AS txn_count, count(*) FILTER (amount > 0) AS inflow_count,
               count(*) FILTER (amount < 0) AS outflow_count,
               coalesce(sum(amount) FILTER (amount > 0), 0.0) AS total_inflow,
               coalesce(-sum(amount) FILTER (amount < 0), 0.0) AS total_outflow,
               coalesce(sum(amount), 0.0) AS net_cashflow, avg(balance) AS avg_balance, min(balance) AS min_balance,
               stddev_samp(balance) AS std_balance,
               count(*) / count(DISTINCT strftime(dt, '%Y-%m')) AS txn_per_month
        FROM raw_transactions GROUP BY id),
    asked AS (SELECT id, count(*) AS total_loans, count(*) FILTER (outcome = 'Declined') AS num_declined,
                     max(amount) AS max_loan_amount, avg(amount) AS mean_loan_amount
              FROM raw_applications GROUP BY id),
    profiles AS (
        SELECT c.id, c.gender, c.age, c.income,
               coalesce(txn_count, 0) AS txn_count, coalesce(inflow_count, 0) AS inflow_count,
               coalesce(outflow_count, 0) AS outflow_count, coalesce(total_inflow, 0) AS total_inflow,
               coalesce(total_outflow, 0) AS total_outflow, coalesce(net_cashflow, 0) AS net_cashflow,
               coalesce(avg_balance, 0) AS avg_balance, coalesce(min_balance, 0) AS min_balance,
               coalesce(std_balance, 0) AS std_balance, coalesce(txn_per_month, 0) AS txn_per_month,
               coalesce(total_loans, 0) AS total_loans, coalesce(num_declined, 0) AS num_declined,
               coalesce(max_loan_amount, 0) AS max_loan_amount, coalesce(mean_loan_amount, 0) AS mean_loan_amount,
               coalesce(avg_balance, 0) / CASE WHEN income = 0 THEN 1.0 ELSE income / 12 END AS balance_to_income_ratio
        FROM valid_customers c LEFT JOIN moves m ON m.id = c.id LEFT JOIN asked a ON a.id = c.id),
    profiled AS (SELECT * FROM raw_requests q LEFT JOIN profiles p ON p.id = CAST(q.user_id AS VARCHAR))"""
_PROFILE_VIEWS = "raw_requests valid_customers raw_transactions raw_applications"
_PROFILE_DIGITS = {
    "total_inflow": 3, "total_outflow": 3, "net_cashflow": 3, "avg_balance": 6, "std_balance": 6,
    "txn_per_month": 6, "mean_loan_amount": 6, "balance_to_income_ratio": 6,
}


@query(
    "serving_features",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES
        + " SELECT * REPLACE ("
        + ", ".join(f"{r(c, d)} AS {c}" for c, d in _PROFILE_DIGITS.items())
        + ") FROM profiles",
    ),
)
def serving_features(spark, folder):
    return rounded(_profiles(spark, folder), _PROFILE_DIGITS)


def _keyed_requests(spark, folder):
    return raw_requests(spark, folder).withColumn("id", F.col("user_id").cast("string"))


def _feature_bucket_sql(feature, bounds):
    values, test = _bounds_sql(bounds, feature)
    return (
        f" SELECT window_start, window_end, le, CAST(count(*) FILTER ({test} AND {feature} IS NOT NULL) AS BIGINT) AS n, "
        f"{r(f'count(*) FILTER ({test} AND {feature} IS NOT NULL) / 60')} AS per_second "
        f"FROM ranges, {values} GROUP BY 1, 2, 3"
    )


@query(
    "feature_buckets",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES + ", " + _ranges(60, 60, source="profiled") + _feature_bucket_sql("age", AGE_BOUNDS),
    ),
)
def feature_buckets(spark, folder):
    people = raw_customers(spark, folder).select("id", C.null_outside(F.col("age")).alias("age"))
    found = telemetry.feature_buckets(_keyed_requests(spark, folder), people, "id", "age", AGE_BOUNDS)
    return rounded(found, ["per_second"])


@query(
    "cash_flow_buckets",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES + ", " + _ranges(60, 60, source="profiled") + _feature_bucket_sql("net_cashflow", FLOW_BOUNDS),
    ),
)
def cash_flow_buckets(spark, folder):
    found = telemetry.feature_buckets(
        _keyed_requests(spark, folder), _profiles(spark, folder), "id", "net_cashflow", FLOW_BOUNDS
    )
    return rounded(found, ["per_second"])


@query(
    "balance_ratio_buckets",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES + ", " + _ranges(60, 60, source="profiled")
        + _feature_bucket_sql("balance_to_income_ratio", RATIO_BOUNDS),
    ),
)
def balance_ratio_buckets(spark, folder):
    found = telemetry.feature_buckets(
        _keyed_requests(spark, folder), _profiles(spark, folder), "id", "balance_to_income_ratio", RATIO_BOUNDS
    )
    return rounded(found, ["per_second"])


@query(
    "feature_sum_rate",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES + ", " + _ranges(60, 60, source="profiled")
        + " SELECT window_start, window_end, "
        + ", ".join(f"{r(f'sum({c}) / 60', 4)} AS {c}" for c in PROFILE_FEATURES)
        + " FROM ranges GROUP BY 1, 2",
    ),
)
def feature_sum_rate(spark, folder):
    found = telemetry.feature_sum_rate(
        _keyed_requests(spark, folder), _profiles(spark, folder), "id", PROFILE_FEATURES
    )
    return rounded(found, dict.fromkeys(PROFILE_FEATURES, 4))


@query(
    "gender_mix",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES + ", " + _ranges(3600, 3600, source="profiled")
        + " SELECT window_start, window_end, coalesce(gender, 'Unknown') AS gender, count(*) AS n FROM ranges GROUP BY 1, 2, 3",
    ),
)
def gender_mix(spark, folder):
    people = raw_customers(spark, folder).select("id", C.normalize_category(F.col("gender")).alias("gender"))
    return telemetry.gender_mix(_keyed_requests(spark, folder), people, "id")


@query(
    "latest_batch_mean",
    using(
        _PROFILE_VIEWS,
        _PROFILE_CTES + ", " + _ranges(3600, 3600, source="profiled")
        + f" SELECT window_start, {r('avg(income)')} AS mean_value FROM ranges WHERE income IS NOT NULL "
        "GROUP BY 1 ORDER BY 1 DESC LIMIT 1",
    ),
)
def latest_batch_mean(spark, folder):
    people = raw_customers(spark, folder).select("id", "income")
    return rounded(telemetry.latest_batch_mean(_keyed_requests(spark, folder), people, "id", "income"), ["mean_value"])


@query(
    "source_freshness",
    using(
        "raw_requests",
        f"""SELECT max(ts) AS last_event,
                   (epoch_us(TIMESTAMP '{REQUESTS_AS_OF}') - epoch_us(max(ts))) / 1000000 AS lag_seconds,
                   (epoch_us(TIMESTAMP '{REQUESTS_AS_OF}') - epoch_us(max(ts))) / 1000000 > 3600 AS is_stale
            FROM raw_requests""",
    ),
)
def source_freshness(spark, folder):
    return telemetry.source_freshness(raw_requests(spark, folder), REQUESTS_AS_OF, 3600)


def request_stream(spark, folder, delay="1 hour"):
    events = runtime.file_stream(
        spark, folder, table(spark, folder, "events").schema, name_pattern="events.parquet"
    )
    return telemetry.with_watermark(events.selectExpr(*REQUEST_COLUMNS), delay)


_CLOSED = "window_end <= (SELECT max(ts) FROM raw_requests) - INTERVAL '1 hour'"


@query(
    "stream_request_rate",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + f" SELECT window_start, window_end, status, count(*) AS n, {r('count(*) / 300')} AS per_second "
        f"FROM ranges WHERE {_CLOSED} GROUP BY 1, 2, 3",
    ),
)
def stream_request_rate(spark, folder):
    """The rate by status as a stream; ranges still open under the watermark are not emitted."""
    rates = telemetry.rate_by_status(request_stream(spark, folder))
    return rounded(runtime.drain_to_table(rates, scratch_path(spark, "request-rate")), ["per_second"])


@query(
    "stream_daily_total",
    using(
        "raw_requests",
        f"""SELECT * FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
                   CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL '1 day' AS window_end, count(*) AS n
            FROM raw_requests GROUP BY 1, 2) WHERE {_CLOSED}""",
    ),
)
def stream_daily_total(spark, folder):
    return runtime.drain_to_table(
        telemetry.daily_total(request_stream(spark, folder)), scratch_path(spark, "daily-total")
    )


@query(
    "stream_error_rate",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + f""" SELECT window_start, window_end, count(*) AS n, count(*) FILTER (status = 'error') AS errors,
               {r("100.0 * count(*) FILTER (status = 'error') / greatest(count(*), 1e-9)")} AS error_pct
               FROM ranges WHERE {_CLOSED} GROUP BY 1, 2""",
    ),
)
def stream_error_rate(spark, folder):
    found = telemetry.error_rate(request_stream(spark, folder))
    return rounded(runtime.drain_to_table(found, scratch_path(spark, "error-rate")), ["error_pct"])


@query(
    "stream_windowed_mean",
    using(
        "raw_requests",
        ", " + _ranges(900, 60)
        + f""" SELECT window_start, window_end, {r('sum(score)')} AS total, count(score) AS n,
               {r('sum(score) / greatest(count(score), 1e-9)')} AS mean_value FROM ranges WHERE {_CLOSED} GROUP BY 1, 2""",
    ),
)
def stream_windowed_mean(spark, folder):
    found = telemetry.windowed_mean(request_stream(spark, folder), "score")
    return rounded(runtime.drain_to_table(found, scratch_path(spark, "score-mean")), ["total", "mean_value"])


@query(
    "stream_bucket_quantile",
    using(
        "raw_requests",
        ", " + _ranges(300, 60)
        + ", counted AS (SELECT window_start, window_end, count(*) AS n, "
        + ", ".join(f"count(*) FILTER (latency_s <= {b}) AS le{i}" for i, b in enumerate(LATENCY_BOUNDS))
        + f" FROM ranges WHERE {_CLOSED} GROUP BY 1, 2) SELECT window_start, window_end, n, "
        + r(f"CAST({_bucket_quantile_sql(0.95)} AS DOUBLE)")
        + " AS p95 FROM counted",
    ),
)
def stream_bucket_quantile(spark, folder):
    found = telemetry.bucket_quantile(request_stream(spark, folder), "latency_s", LATENCY_BOUNDS, {"p95": 0.95})
    return rounded(runtime.drain_to_table(found, scratch_path(spark, "latency")), ["p95"])


_EXACT_LEVELS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


@query(
    "range_quantile",
    using(
        "raw_requests",
        ", " + _ranges(300, 60, "latency_s")
        + " SELECT window_start, window_end, count(*) AS n, "
        + ", ".join(f"quantile_disc(latency_s, {q}) AS {name}" for name, q in _EXACT_LEVELS.items())
        + " FROM ranges WHERE latency_s IS NOT NULL GROUP BY 1, 2",
    ),
)
def range_quantile(spark, folder):
    """The latency that dashboards read from buckets, exactly."""
    return telemetry.range_quantile(raw_requests(spark, folder), "latency_s", _EXACT_LEVELS)


_STALE, _BEAT, _SLACK = 600, 300, 3600


def heartbeats(spark, folder):
    """Ticks every five minutes over the time of the requests and six hours more."""
    span = raw_requests(spark, folder).agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.date_trunc("hour", F.max("ts")).alias("b"))
    return span.select(
        F.explode(F.sequence("a", F.col("b") + F.expr("INTERVAL 6 HOURS"), F.expr(f"INTERVAL {_BEAT} SECONDS"))).alias("tick")
    )


@query(
    "stream_freshness",
    using(
        "raw_requests",
        f""", ticks AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) + INTERVAL 6 HOURS,
                                                 INTERVAL {_BEAT} SECONDS)) AS tick FROM raw_requests),
        held AS (SELECT tick, count(ts) AS n_events, max(ts) AS last_event
                 FROM ticks LEFT JOIN raw_requests ON ts >= tick - INTERVAL {_STALE} SECONDS AND ts < tick GROUP BY tick)
        SELECT tick, n_events, last_event, (epoch_us(tick) - epoch_us(last_event)) / 1000000 AS lag_seconds, n_events = 0 AS is_stale
        FROM held WHERE tick <= (SELECT max(tick) FROM ticks) - INTERVAL {_SLACK} SECONDS""",
    ),
)
def stream_freshness(spark, folder):
    """Liveness of the requests at every heartbeat, also where and after they fall silent."""
    path = scratch_path(spark, "heartbeats")
    ticks = durable(heartbeats(spark, folder), path)
    beats = runtime.file_stream(spark, path, ticks.schema)
    events = runtime.file_stream(spark, folder, table(spark, folder, "events").schema, name_pattern="events.parquet")
    found = liveness.freshness_stream(events.selectExpr(*REQUEST_COLUMNS), beats, _STALE, _BEAT, f"{_SLACK} seconds")
    with liveness.heartbeats_lead(spark):
        return runtime.drain_to_table(found, scratch_path(spark, "freshness"))


#: A request arrives with its week; one in ten a week late.  The same text in both engines.
_ARRIVAL = "cast(least(floor((day(ts) - 1) / 8), 3) + case when event_id % 10 = 0 then 1 else 0 end as int)"
_ARRIVAL_COLUMNS = [*REQUEST_COLUMNS, f"{_ARRIVAL} as arrival"]
_ARRIVED = f", arrived AS (SELECT {', '.join(_ARRIVAL_COLUMNS)} FROM events)"


def in_slices(spark, folder, run):
    """Let the requests arrive slice by slice; after each, ``run(stream)`` starts a query, which is awaited."""
    inbox = scratch_path(spark, "inbox")
    arrived = table(spark, folder, "events").selectExpr(*_ARRIVAL_COLUMNS)
    for slice_number in range(5):
        arrived.where(F.col("arrival") == slice_number).write.mode("append").parquet(inbox)
        run(runtime.file_stream(spark, inbox, arrived.schema)).awaitTermination()


@query(
    "stream_late_rows",
    using(
        "raw_requests",
        _ARRIVED
        + f""", marks AS (SELECT a.arrival, max(b.ts) - INTERVAL {_SLACK} SECONDS AS watermark
                  FROM (SELECT DISTINCT arrival FROM arrived) a LEFT JOIN arrived b ON b.arrival < a.arrival GROUP BY 1),
        judged AS (SELECT date_trunc('hour', ts) AS window_start, coalesce(ts < watermark, false) AS late FROM arrived JOIN marks USING (arrival))
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
               CASE WHEN late THEN 'late'
                    WHEN window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM arrived) - INTERVAL {_SLACK} SECONDS THEN 'closed'
                    ELSE 'open' END AS state, count(*) AS n
        FROM judged GROUP BY 1, 2, 3""",
    ),
)
def stream_late_rows(spark, folder):
    """Requests per hour: closed, open and late ones are all that arrived."""
    path, progress = scratch_path(spark, "arrivals"), scratch_path(spark, "progress")
    in_slices(spark, folder, lambda stream: liveness.arrival_sink(stream, _SLACK, path, progress))
    return liveness.accounted_ranges(spark, path, 3600, _SLACK)


@query(
    "stream_latest_mean",
    using(
        "raw_requests valid_customers",
        _ARRIVED
        + f""" SELECT arrival AS batch, {r('avg(income)')} AS mean_value, count(income) AS n,
                  arrival = max(arrival) OVER () AS is_newest
           FROM arrived LEFT JOIN valid_customers c ON c.id = CAST(user_id AS VARCHAR) GROUP BY arrival""",
    ),
)
def stream_latest_mean(spark, folder):
    """Mean income of the customers who ask, by micro-batch; the newest is the gauge."""
    path, progress = scratch_path(spark, "means"), scratch_path(spark, "progress")
    people = raw_customers(spark, folder).select("id", "income")

    def run(stream):
        known = stream.withColumn("id", F.col("user_id").cast("string")).join(people, "id", "left")
        return runtime.latest_mean_sink(known, "income", path, progress)

    in_slices(spark, folder, run)
    return rounded(runtime.latest_means(spark, path), ["mean_value"])


_PSI_EDGES = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
_PSI_SHARE = "CASE WHEN {n} > 0 THEN {n} / {of} ELSE 0.0001 END"


@query(
    "stream_psi",
    using(
        "raw_requests",
        _ARRIVED
        + f""", edges AS (SELECT list_sort(list_distinct(quantile_disc(score, {_PSI_EDGES}))) AS e
                          FROM raw_requests WHERE ts < TIMESTAMP '2024-01-08'),
        binned AS (SELECT arrival, ts, least(len(list_filter(e[2:], lambda x: x <= score)), len(e) - 2) AS bin FROM arrived, edges),
        bins AS (SELECT unnest(range((SELECT len(e) - 1 FROM edges))) AS bin),
        base AS (SELECT bins.bin, count(b.ts) AS n FROM bins LEFT JOIN binned b ON b.bin = bins.bin AND b.ts < TIMESTAMP '2024-01-08' GROUP BY 1),
        days AS (SELECT arrival, CAST(ts AS DATE) AS day, count(*) AS n_rows FROM binned GROUP BY 1, 2),
        cells AS (SELECT d.arrival, d.day, d.n_rows, base.bin, base.n AS b,
                         count(x.ts) AS c, (SELECT sum(n) FROM base) AS b_all
                  FROM days d CROSS JOIN base
                  LEFT JOIN binned x ON x.arrival = d.arrival AND CAST(x.ts AS DATE) = d.day AND x.bin = base.bin
                  GROUP BY ALL),
        shares AS (SELECT *, {_PSI_SHARE.format(n='b', of='b_all')} AS p, {_PSI_SHARE.format(n='c', of='n_rows')} AS q FROM cells)
        SELECT *, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi <= 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END AS stability
        FROM (SELECT arrival AS batch, day, n_rows, {r('sum((q - p) * ln(q / p))', 9)} AS psi FROM shares GROUP BY 1, 2, 3)""",
    ),
)
def stream_psi(spark, folder):
    """Drift of the score by micro-batch and day against the first week."""
    path, progress = scratch_path(spark, "drift"), scratch_path(spark, "progress")
    first_week = raw_requests(spark, folder).where(F.col("ts") < F.lit("2024-01-08").cast("timestamp"))
    day = F.to_date("ts").alias("day")
    in_slices(spark, folder, lambda stream: runtime.drift_sink(stream, first_week, "score", [day], path, progress))
    return rounded(spark.read.parquet(path).select("batch", "day", "n_rows", "psi", "stability"), {"psi": 9})
