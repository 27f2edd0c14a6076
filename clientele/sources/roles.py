"""The given tables in the roles of the customer-analytics model.

=================  ==============================================================================
role               built from
=================  ==============================================================================
customers          customer (+ nation, region for state and city)
transactions       orders: one row per order, the feed used wherever no category is needed
raw_lines          lineitem: itemised feed with re-delivered rows (same order and line number)
fact               raw_lines deduplicated, with customer/date/channel of the order and the category
                   of the part
changes            events: change records per user
=================  ==============================================================================

No table is hinted to be broadcast: Spark compares the measured size of a side with
``spark.sql.autoBroadcastJoinThreshold`` and uses a shuffled join beyond it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.columns import MONEY, lookup
from clientele.operators.dedupe import latest_per_key

# Reference dates of the given data: the day after the last order, and the day after the last event.
AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 1, 31)
# Events before this moment form the existing history, the rest is the change batch.
CHANGES_FROM = dt.datetime(2024, 1, 16)

# Part type -> merchant category.
CATEGORY_OF_TYPE = {
    "ECONOMY": "Grocery",
    "STANDARD": "Utilities",
    "SMALL": "Gas",
    "MEDIUM": "Retail",
    "LARGE": "Dining",
    "PROMO": "Travel",
}
# Event type -> (change action, is part of an update).
CHANGE_OF_EVENT = {
    "signup": ("INSERT", False),
    "purchase": ("INSERT", True),
    "click": ("INSERT", True),
    "view": ("INSERT", True),
    "error": ("DELETE", False),
}


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is read from the files once per application, not once per query; after the files of a
    path were rewritten with other columns, call :func:`forget_schemas`."""
    path = f"{folder}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def forget_schemas(folder: str = "") -> None:
    """Read the schemas of the tables below ``folder`` (default: all) anew when they are asked for next."""
    for key in [k for k in _schemas if k[1].startswith(folder)]:
        del _schemas[key]


def customers(spark: SparkSession, folder: str) -> DataFrame:
    places = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("city"))
    )
    balance = F.col("c_acctbal")
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(
                F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
                F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com"),
            ).alias("email"),
            (F.lit(22) + F.col("c_custkey") % 54).alias("age"),
            "state",
            "city",
            F.when(balance < 0, "Unemployed").when(balance < 3000, "Self-Employed").when(balance < 8000, "Employed")
            .otherwise("Retired").alias("employment_status"),
            F.when(balance >= 5000, "Premium").otherwise("Standard").alias("card_type"),
            balance.cast(MONEY).alias("credit_limit"),
            F.date_add(F.lit(dt.date(1993, 1, 1)), (F.col("c_custkey") % 730).cast("int")).alias("account_open_date"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.when(
                F.col("c_mktsegment") == "MACHINERY", F.when(balance < 5000, "gradual").otherwise("sudden")
            ).alias("decline_type"),
        )
    )


def _status(c: str):
    return F.when(F.col(c) == "P", "declined").otherwise("approved")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Order-grain feed; a plain projection, so filters and pruning reach the scan of orders."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderpriority").alias("channel"),
        _status("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("ingestion_timestamp"),
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Itemised feed. The same transaction_id can arrive more than once with different ship dates."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Itemised feed with the latest delivery of every transaction_id.

    The order follows from the transaction id. As a second grouping column it stays visible to the optimizer, which can
    then filter lines by the joined orders before they are deduplicated.
    """
    return latest_per_key(
        raw_lines(spark, folder), ["transaction_id", "order_id"], ["ingestion_timestamp", "amount", "part_id", "merchant_id"]
    )


def category(c: str = "p_type"):
    return lookup(F.trim(F.col(c)), CATEGORY_OF_TYPE, "Uncategorized")


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplicated lines with the order's customer, date, channel, status and the part's category."""
    orders = transactions(spark, folder).select(
        F.col("transaction_id").alias("order_id"), "customer_id", "transaction_date", "channel", "status"
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("part_id"), category().alias("category_name"))
    return lines(spark, folder).join(orders, "order_id").join(parts, "part_id").select(
        "transaction_id", "customer_id", "transaction_date", "amount", "merchant_id", "category_name", "channel",
        "status", "ingestion_timestamp",
    )


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change records: entity id, change time, action, is_update and two tracked attributes."""
    event = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("id"),
        F.col("ts").alias("update_timestamp"),
        lookup(event, {k: v[0] for k, v in CHANGE_OF_EVENT.items()}).alias("action"),
        lookup(event, {k: v[1] for k, v in CHANGE_OF_EVENT.items()}).alias("is_update"),
        event.alias("label"),
        F.col("value").cast(MONEY).alias("amount"),
    )
