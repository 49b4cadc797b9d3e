"""Whether a running source is alive, and what arrives too late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import literal_frame
from .runtime import AVAILABLE_NOW
from .telemetry import with_watermark

#: With it the heartbeats alone move the watermark on when a source falls silent.
_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def freshness_stream(
    events: DataFrame, heartbeats: DataFrame, stale_after: int, every: int, delay: str, ts="ts", tick="tick"
) -> DataFrame:
    """At each heartbeat: events of the last ``stale_after`` seconds, the newest of them, and whether there was none.

    A silent source emits nothing, so its own newest time never turns stale.  Here
    heartbeats (one every ``every`` seconds) are joined, left outer, with ranges
    of events that end at the heartbeat: one without events comes out unmatched.
    An event at the very time of a heartbeat counts for the next one.

    Start it through :func:`heartbeats_lead`, or the watermark waits for the
    silent source.  Events may be ``delay`` behind the heartbeats.
    """
    if stale_after % every:
        raise ValueError("the time after which a source is stale must be a multiple of the heartbeat's interval")
    length, slide = f"{stale_after} seconds", f"{every} seconds"
    # panes first, as in the telemetry: a hot interval is combined before ranges multiply it
    panes = with_watermark(events, delay, ts).groupBy(F.window(ts, slide).alias("pane")).agg(
        F.count("*").alias("n"), F.max(ts).alias("newest")
    )
    ranges = panes.groupBy(F.window(F.window_time("pane"), length, slide).alias("range")).agg(
        F.sum("n").alias("n"), F.max("newest").alias("last_event")
    )
    beats = with_watermark(heartbeats.select(tick), delay, tick)
    # of the ranges that hold the moment before the heartbeat, the one that ends at it
    beats = beats.select(tick, F.window(F.col(tick) - F.expr("INTERVAL 1 MICROSECOND"), length, slide).alias("range")).where(
        F.col("range.end") == F.col(tick)
    )
    joined = beats.join(ranges, "range", "left_outer")
    lag = (F.unix_micros(tick) - F.unix_micros("last_event")) / F.lit(1_000_000)
    return joined.select(
        tick, F.coalesce("n", F.lit(0)).alias("n_events"), "last_event", lag.alias("lag_seconds"), F.col("n").isNull().alias("is_stale")
    )


class heartbeats_lead:
    """While it is entered, the largest watermark of a query's sources counts; queries keep it once started."""

    def __init__(self, spark: SparkSession):
        self.spark, self.before = spark, None

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(_POLICY, None)
        self.spark.conf.set(_POLICY, "max")

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(_POLICY)
        else:
            self.spark.conf.set(_POLICY, self.before)


def arrival_sink(stream: DataFrame, delay_seconds: int, path: str, checkpoint: str, ts="ts", **trigger):
    """Write every row of a stream, marked on time or late, and what each micro-batch held.

    A row is late if its time is more than ``delay_seconds`` before the newest time
    of all earlier batches: where an aggregate under that watermark would drop it
    without a trace.  ``path/rows`` has the rows with ``is_late``; ``path/marks`` a
    row per batch: ``n``, ``n_late``, ``newest``, observed while the rows are
    written.  Both are replaced, batch by batch, when a batch runs again.  A row
    without a time is never late.
    """
    time = F.col(ts).cast("timestamp")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = None
        if number:
            # batch by batch, so a file of a batch that runs again is not read
            marks = [f"{path}/marks/batch={i}" for i in range(number)]
            newest = spark.read.parquet(*marks).agg(F.max("newest").cast("string")).first()[0]
        seen = Observation()
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
        marked = batch.withColumn("is_late", F.coalesce(time < limit, F.lit(False))).observe(
            seen, F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("n_late"), F.max(time.cast("string")).alias("newest")
        )
        marked.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        held = seen.get
        # what earlier batches held stays the newest if this one is older
        later = max([t for t in (newest, held["newest"]) if t is not None], default=None)
        row = literal_frame(spark, {"n": "bigint", "n_late": "bigint", "newest": "string"}, [(held["n"], held["n_late"], later)])
        row.withColumn("newest", F.col("newest").cast("timestamp")).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def arrivals(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows and the marks that :func:`arrival_sink` has written so far."""
    return spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/marks")


def accounted_ranges(spark: SparkSession, path: str, length: int, delay_seconds: int, ts="ts") -> DataFrame:
    """Rows per range and state: ``closed``, still ``open``, or ``late``; together they are the input.

    A range is closed when the newest time is ``delay_seconds`` past its end; no
    row on time can enter it any more.
    """
    rows, marks = arrivals(spark, path)
    newest = marks.agg(F.max("newest").cast("string")).first()[0]
    limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
    counted = rows.groupBy(F.window(ts, f"{length} seconds").alias("range"), "is_late").agg(F.count("*").alias("n"))

    def state() -> Column:
        return F.when(F.col("is_late"), "late").when(F.col("range.end") <= limit, "closed").otherwise("open")

    return counted.select(
        F.col("range.start").alias("window_start"), F.col("range.end").alias("window_end"), state().alias("state"), "n"
    )
