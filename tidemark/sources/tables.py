"""Reading tables with a declared schema, and writing results."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUSTOMERS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("income", T.DoubleType()),
    ]
)
APPLICATIONS = T.StructType(
    [
        T.StructField("app_id", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("outcome", T.StringType()),
    ]
)
TRANSACTIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("balance", T.DoubleType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that are present; others stay as they are.

    Only columns whose type differs are cast, so filters on the rest still reach
    the file scan.  A value that does not fit becomes null.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[
            F.col(f.name).try_cast(wanted[f.name]).alias(f.name)
            if f.name in wanted and wanted[f.name] != f.dataType
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def scan_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet scan conformed to a schema; a declared column may be absent."""
    return conform(spark.read.parquet(path), schema)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan by the names in the header, with the declared types; nothing is inferred.

    As for Parquet, the order of columns does not matter, a declared column may
    be absent, and others stay (as text).  A value that does not fit is null.
    """
    return conform(spark.read.option("header", True).option("enforceSchema", False).csv(path), schema)


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Choose the reader by the extension of the path."""
    reader = scan_typed if path.rstrip("/").endswith(".parquet") else scan_csv
    return reader(spark, path, schema)


def load_tables(spark: SparkSession, customers: str, applications: str, transactions: str):
    """The three raw tables, uncleaned."""
    return (
        scan(spark, customers, CUSTOMERS),
        scan(spark, applications, APPLICATIONS),
        scan(spark, transactions, TRANSACTIONS),
    )


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the table at ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_report(report: DataFrame, path: str, run_date: str, form: str = "parquet") -> None:
    """Keep a long report under its run date, so that runs can be compared.

    Only the partition of this date is replaced, so repeating a run is harmless.
    """
    (
        report.withColumn("run_date", F.lit(run_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .format(form)
        .save(path)
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
