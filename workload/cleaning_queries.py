"""Sources, sinks, cleaning and row-level expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions import fixed_values as fixed
from tidemark.operators import cleaning, history, modeling
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans import customer as plans
from tidemark.session import scratch_path
from tidemark.sources import tables

from .registry import query, r, rounded
from .views import AS_OF, raw_applications, raw_customers, raw_transactions, staged_transactions, table, using


@query(
    "scan_typed",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
    "c_acctbal, c_mktsegment FROM customer",
)
def scan_typed(spark, folder):
    declared = T.StructType(
        [
            T.StructField("c_custkey", T.StringType()),
            T.StructField("c_nationkey", T.LongType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_phone", T.StringType()),
        ]
    )
    return tables.scan_typed(spark, f"{folder}/customer.parquet", declared)


@query("scan_csv", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, folder):
    """The file has its columns in another order, one more and one less than declared."""
    source = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "customer-csv")
    shuffled = source.select("c_mktsegment", "c_acctbal", F.lit("x").alias("more"), "c_custkey", "c_name")
    shuffled.write.option("header", True).csv(path)
    declared = T.StructType([*source.schema.fields, T.StructField("c_phone", T.StringType())])
    return tables.scan(spark, path, declared).select(*source.columns)


@query(
    "sink_parquet",
    using("raw_applications", "SELECT *, CAST(year(dt) AS INTEGER) AS app_year FROM raw_applications"),
)
def sink_parquet(spark, folder):
    path = scratch_path(spark, "applications") + ".parquet"
    dated = raw_applications(spark, folder).withColumn("app_year", F.year("dt"))
    tables.write_table(dated, path, ("app_year",))
    return spark.read.parquet(path)


@query(
    "load_tables",
    using(
        "raw_customers raw_applications raw_transactions",
        f"""SELECT c.id, c.gender, c.age, c.income, coalesce(asked, 0) AS asked, taken, last_asked, coalesce(moves, 0) AS moves,
                   {r("net", 4)} AS net, low_balance
            FROM raw_customers c
            LEFT JOIN (SELECT id, count(*) AS asked, count(*) FILTER (outcome = 'TakeUp') AS taken, max(dt) AS last_asked
                       FROM raw_applications GROUP BY id) a ON a.id = c.id
            LEFT JOIN (SELECT id, count(*) AS moves, sum(amount) AS net, min(balance) AS low_balance
                       FROM raw_transactions GROUP BY id) t ON t.id = c.id""",
    ),
)
def load_tables(spark, folder):
    """The three tables from files of two kinds, each read with its declared types."""
    root = scratch_path(spark, "mixed")
    raw_customers(spark, folder).write.parquet(f"{root}/customers.parquet")
    raw_applications(spark, folder).write.option("header", True).csv(f"{root}/applications")
    raw_transactions(spark, folder).write.option("header", True).csv(f"{root}/transactions")
    customers, applications, transactions = tables.load_tables(
        spark, f"{root}/customers.parquet", f"{root}/applications", f"{root}/transactions"
    )
    asked = applications.groupBy("id").agg(
        F.count("*").alias("asked"), F.count_if(F.col("outcome") == "TakeUp").alias("taken"), F.max(F.col("dt").try_cast("date")).alias("last_asked")
    )
    moves = transactions.groupBy("id").agg(
        F.count("*").alias("moves"), F.sum("amount").alias("net"), F.min("balance").alias("low_balance")
    )
    known = customers.select("id", "gender", "age", "income").join(asked, "id", "left").join(moves, "id", "left")
    return rounded(known.fillna(0, ["asked", "moves"]), {"net": 4})


@query("normalize_category", using("valid_customers", "SELECT id, gender FROM valid_customers"))
def normalize_category(spark, folder):
    return raw_customers(spark, folder).select("id", C.normalize_category(F.col("gender")).alias("gender"))


@query("null_out_of_range", using("valid_customers", "SELECT id, age FROM valid_customers"))
def null_out_of_range(spark, folder):
    return raw_customers(spark, folder).select("id", C.null_outside(F.col("age")).alias("age"))


@query("impute_median", using("customers", "SELECT id, gender, age, income FROM customers"))
def impute_median(spark, folder):
    return cleaning.clean_customers(raw_customers(spark, folder))


@query(
    "missing_flag",
    using(
        "raw_transactions",
        """SELECT l_orderkey, l_linenumber, CAST(balance IS NULL AS INTEGER) AS balance_missing,
                  coalesce(balance, (SELECT quantile_disc(balance, 0.5) FROM raw_transactions)) AS balance
           FROM raw_transactions""",
    ),
)
def missing_flag(spark, folder):
    cleaned = cleaning.clean_transactions(staged_transactions(spark, folder))
    return cleaned.select("l_orderkey", "l_linenumber", "balance_missing", "balance")


_DATE_TEXT = (
    "case o_orderpriority when '5-LOW' then 'not a date' when '2-HIGH' then '2024-13-45' "
    "else cast(cast(o_orderdate as date) as varchar(20)) end"
)


@query("parse_dates", f"SELECT o_orderkey, try_cast({_DATE_TEXT} AS DATE) AS dt FROM orders")
def parse_dates(spark, folder):
    texts = table(spark, folder, "orders").selectExpr("o_orderkey", f"{_DATE_TEXT} as dt")
    return cleaning.parse_dates(texts, ["dt"])


@query(
    "guarded_ratio",
    "SELECT c_custkey, " + r("c_acctbal / CASE WHEN c_nationkey = 0 THEN 1.0 ELSE c_nationkey END")
    + " AS ratio FROM customer",
)
def guarded_ratio(spark, folder):
    ratio = C.guarded_ratio(F.col("c_acctbal"), F.col("c_nationkey"))
    return rounded(table(spark, folder, "customer").select("c_custkey", ratio.alias("ratio")), ["ratio"])


def _customer_history(spark, folder):
    profile = history.application_profile(raw_applications(spark, folder))
    return raw_customers(spark, folder).select("id").join(profile, "id", "left")


@query(
    "rate_or_marker",
    using(
        "raw_customers applied",
        "SELECT c.id, " + r("CASE WHEN n > 0 THEN won / n ELSE -1.0 END")
        + " AS acceptance_rate FROM raw_customers c LEFT JOIN applied a ON a.id = c.id",
    ),
)
def rate_or_marker(spark, folder):
    rate = C.rate_or_marker(F.col("successful_applications"), F.col("total_applications"))
    return rounded(_customer_history(spark, folder).select("id", rate.alias("acceptance_rate")), ["acceptance_rate"])


@query(
    "recency_days",
    using(
        "raw_customers applied",
        f"SELECT c.id, CAST(coalesce(date_diff('day', last_dt, DATE '{AS_OF}'), 9999) AS INTEGER) AS days_since "
        "FROM raw_customers c LEFT JOIN applied a ON a.id = c.id",
    ),
)
def recency_days(spark, folder):
    days = C.recency_days(F.col("last_application_date"), AS_OF)
    return _customer_history(spark, folder).select("id", days.alias("days_since"))


@query(
    "segment_label",
    using(
        "raw_customers applied",
        "SELECT c.id, CASE WHEN a.id IS NULL THEN 'Deposit-Only Prospect' ELSE 'Existing Borrower' END "
        "AS customer_segment FROM raw_customers c LEFT JOIN applied a ON a.id = c.id",
    ),
)
def segment_label(spark, folder):
    label = C.segment_label(F.col("total_applications") > 0)
    return _customer_history(spark, folder).select("id", label.alias("customer_segment"))


@query(
    "lifecycle_flags",
    using(
        "customer_table",
        "SELECT id, flag_seg_young_lowincome, flag_seg_midage_highincome, flag_seg_senior_stable, "
        "flag_seg_young_highincome, flag_seg_midage_lowincome FROM customer_table",
    ),
)
def lifecycle_flags(spark, folder):
    people = cleaning.clean_customers(raw_customers(spark, folder))
    found = exact_quantiles(people, {"age": list(fixed.AGE_TERTILE_LEVELS), "income": [0.5]})
    flagged = plans.with_segments(people, found["income"][0], tuple(found["age"]))
    return flagged.drop("gender", "age", "income")


@query(
    "winsorize",
    using(
        "raw_applications",
        """SELECT app_id, greatest(least(amount, hi), lo) AS amount
           FROM raw_applications, (SELECT quantile_disc(amount, 0.01) AS lo, quantile_disc(amount, 0.99) AS hi
                                   FROM raw_applications)""",
    ),
)
def winsorize(spark, folder):
    return cleaning.winsorize(raw_applications(spark, folder), ["amount"]).select("app_id", "amount")


@query(
    "encode_category",
    using(
        "valid_customers",
        """SELECT id, CASE gender WHEN 'Female' THEN 0 WHEN 'Male' THEN 1 ELSE -1 END AS gender_encoded,
                  CAST(gender = 'Unknown' AS INTEGER) AS gender_unknown FROM valid_customers""",
    ),
)
def encode_category(spark, folder):
    named = raw_customers(spark, folder).withColumn("gender", C.normalize_category(F.col("gender")))
    return modeling.encode_gender(named).select("id", "gender_encoded", "gender_unknown")


@query(
    "age_bands",
    using(
        "valid_customers",
        """SELECT id, CASE WHEN age IS NULL THEN 'Unknown' WHEN age <= 25 THEN '<=25' WHEN age <= 35 THEN '26-35'
                           WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65' ELSE '65+' END AS age_band
           FROM valid_customers""",
    ),
)
def age_bands(spark, folder):
    valid = raw_customers(spark, folder).withColumn("age", C.null_outside(F.col("age")))
    return valid.select("id", C.banded(F.col("age")).alias("age_band"))


@query(
    "class_weights",
    using(
        "raw_applications",
        "SELECT app_id, " + r("t.total / (k.classes * count(*) OVER (PARTITION BY outcome))")
        + """ AS class_weight
        FROM raw_applications,
             (SELECT count(*) AS total FROM raw_applications WHERE outcome IS NOT NULL) t,
             (SELECT count(DISTINCT outcome) AS classes FROM raw_applications) k
        WHERE outcome IS NOT NULL""",
    ),
)
def class_weights(spark, folder):
    labelled = raw_applications(spark, folder).where("outcome is not null")
    weighted = modeling.class_weights(labelled.withColumn("target", history.accepted_flag()), "target")
    return rounded(weighted.select("app_id", "class_weight"), ["class_weight"])
