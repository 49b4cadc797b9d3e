"""Running streams to a table, scoring streams and per-batch monitors."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.drift import baseline_counts, psi_with
from ..operators.modeling import with_scores
from ..session import scratch_path

#: Take what is there, then end.
AVAILABLE_NOW = {"availableNow": True}


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, name_pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drain_to_table(stream: DataFrame, path: str, checkpoint: str | None = None) -> DataFrame:
    """Process everything available, append it to a parquet table and return the table.

    Progress is kept in a checkpoint on shared storage; running again with the
    same checkpoint continues where the last run stopped.
    """
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def score_stream(model: PipelineModel, stream: DataFrame, key="id") -> DataFrame:
    """Key and score of every row that arrives."""
    return with_scores(model, stream).select(key, "score")


def latest_mean_sink(stream: DataFrame, value: str, path: str, checkpoint: str, **trigger):
    """Write the mean of every micro-batch; the newest one is the gauge.

    The batch number is the file partition, so a batch that runs again after a
    failure replaces its own row.  ``trigger`` is Spark's, say
    ``processingTime="1 minute"`` to run on; the default takes what is there and ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.agg(F.avg(value).alias("mean_value"), F.count(value).alias("n")).withColumn(
            "batch", F.lit(number)
        ).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def latest_means(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`latest_mean_sink` has written: a row per micro-batch, the newest one marked."""
    written = spark.read.parquet(path).select("batch", "mean_value", "n")
    newest = written.agg(F.max("batch")).first()[0]
    return written.withColumn("is_newest", F.col("batch") == F.lit(newest))


def drift_sink(
    stream: DataFrame, baseline: DataFrame, column: str, keys: list[Column], path: str, checkpoint: str, **trigger
):
    """Stability index of every micro-batch against a fixed baseline, which is read once at the start.

    ``trigger`` is as for :func:`latest_mean_sink`.
    """
    edges, counts = baseline_counts(baseline, column)

    def write(batch: DataFrame, number: int) -> None:
        psi_with(edges, counts, batch, column, keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
