"""Visit-history roles played by the test tables.

``orders`` stands in for registrations (one camp per month), ``customer`` for patient
profiles, and three selections of orders for the attendance tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Schemas of the tables that queries read often, so that no job has to look into the files for them.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

TRAIN_BEFORE = "2000-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def camp_of(date: str):
    return (F.year(date) * 100 + F.month(date)).cast("bigint")


def registrations(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("Patient_ID"),
        camp_of("o_orderdate").alias("Health_Camp_ID"),
        F.col("o_orderdate").alias("Registration_Date"),
        (F.col("o_custkey") % 97).alias("Var1"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("Var2"),
        (F.col("o_orderkey") % 13).alias("Var4"),
        F.floor("o_totalprice").cast("bigint").alias("Var5"),
    )


def train_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = registrations(spark, folder)
    border = F.lit(TRAIN_BEFORE).cast("timestamp_ntz")
    return rows.where(F.col("Registration_Date") < border), rows.where(F.col("Registration_Date") >= border)


def camps(spark: SparkSession, folder: str) -> DataFrame:
    """One row per month: its first and last order date, and three made categories."""
    orders = table(spark, folder, "orders").withColumn("Health_Camp_ID", camp_of("o_orderdate"))
    grouped = orders.groupBy("Health_Camp_ID").agg(
        F.min("o_orderdate").alias("Camp_Start_Date"),
        F.max("o_orderdate").alias("Camp_End_Date"),
        F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("Category2"),
    )
    level = F.col("Health_Camp_ID") % 3
    return grouped.select(
        "Health_Camp_ID",
        "Camp_Start_Date",
        "Camp_End_Date",
        F.when(level == 0, "First").when(level == 1, "Second").otherwise("Third").alias("Category1"),
        "Category2",
        (F.col("Health_Camp_ID") % 2).alias("Category3"),
    )


def patients(spark: SparkSession, folder: str) -> DataFrame:
    first = F.expr("timestamp_ntz'1994-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 365 as int))")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Patient_ID"),
        first.alias("First_Interaction"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("c_acctbal").alias("Balance"),
    )


def _attended(spark: SparkSession, folder: str, status: str, priorities: tuple[str, ...]) -> DataFrame:
    orders = table(spark, folder, "orders")
    kept = orders.where((F.col("o_orderstatus") == status) & F.col("o_orderpriority").isin(list(priorities)))
    return kept.groupBy(
        F.col("o_custkey").alias("Patient_ID"), camp_of("o_orderdate").alias("Health_Camp_ID")
    ).agg(F.round(F.avg("o_totalprice") / 1e6, 6).alias("Score"))


def attendance_1(spark: SparkSession, folder: str) -> DataFrame:
    df = _attended(spark, folder, "F", ("1-URGENT", "2-HIGH"))
    return df.withColumnRenamed("Score", "Health_Score")


def attendance_2(spark: SparkSession, folder: str) -> DataFrame:
    return _attended(spark, folder, "O", ("1-URGENT",)).withColumnRenamed("Score", "Health Score")


def attendance_records(spark: SparkSession, folder: str, status: str, name: str = "Health_Score") -> DataFrame:
    """One attendance record per order of a status: a patient has several in some camps."""
    return table(spark, folder, "orders").where(F.col("o_orderstatus") == status).select(
        F.col("o_custkey").alias("Patient_ID"),
        camp_of("o_orderdate").alias("Health_Camp_ID"),
        F.round(F.col("o_totalprice") / 1e6, 6).alias(name),
    )


def attendance_3(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") == "P")
    stalls = (
        table(spark, folder, "lineitem")
        .where(F.col("l_quantity") >= 45)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("stalls"))
    )
    return (
        orders.join(stalls, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("Patient_ID"), camp_of("o_orderdate").alias("Health_Camp_ID"))
        .agg(F.sum(F.coalesce("stalls", F.lit(0))).cast("bigint").alias("Number_of_stall_visited"))
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three formula-made scores per order, stacked with a model name."""
    orders = table(spark, folder, "orders")
    scores = {
        "model1": (F.col("o_custkey") % 1000) / 1000.0,
        "model2": ((F.col("o_orderkey") * 7919) % 10007) / 10007.0,
        "model3": F.col("o_totalprice") / (F.col("o_totalprice") + 100000.0),
    }
    rows = [F.struct(F.lit(m).alias("model"), s.cast("double").alias("Outcome")) for m, s in scores.items()]
    return orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("Patient_ID"),
        camp_of("o_orderdate").alias("Health_Camp_ID"),
        F.inline(F.array(*rows)),
    )
