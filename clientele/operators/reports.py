"""Grouped reports over transactions, customers and the profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import mean, pct, safe_divide
from clientele.functions.text import format_bytes, format_millis
from clientele.operators.selection import percentiles
from clientele.operators.setops import beside
from clientele.operators.windows import share_of_total


def per_customer(transactions: DataFrame, *keys: str) -> DataFrame:
    """Mergeable totals per customer. Joining these instead of the rows makes a busy customer one row of the join."""
    return transactions.groupBy("customer_id", *keys).agg(
        F.count("transaction_id").alias("_n"),
        F.sum("amount").alias("_sum"),
        F.min("amount").alias("_min"),
        F.max("amount").alias("_max"),
        F.min("transaction_date").alias("_first"),
        F.max("transaction_date").alias("_last"),
    )


def merged(*wanted: str) -> list[Column]:
    """Final aggregates over :func:`per_customer` rows."""
    n, total = F.sum("_n"), F.sum("_sum")
    known = {
        "txn_count": F.coalesce(n, F.lit(0)),
        "total_spend": total,
        "avg_amount": safe_divide(total.cast("double"), n.cast("double")),
        "min_amount": F.min("_min"),
        "max_amount": F.max("_max"),
        "first_txn": F.min("_first"),
        "last_txn": F.max("_last"),
    }
    return [known[w].alias(w) for w in wanted]


def group_profile(df: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    """Count and share per value of ``key`` with further aggregates."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("customer_count"), *[c.alias(n) for n, c in aggregates.items()])
    return share_of_total(counts, "customer_count", "percentage")


def five_numbers(df: DataFrame, keys: Sequence[str], value: str, count: str | None = None) -> DataFrame:
    """min, quartiles, max and mean per group; quartiles are exact for groups of any size.

    ``count``: how often a row counts, for rows that were counted before a join.
    """
    quartiles = percentiles(df, keys, {value: {"q1": 0.25, "median": 0.5, "q3": 0.75}}, count)
    average = mean(value)
    if count:
        filled = F.sum(F.when(F.col(value).isNotNull(), F.col(count)))
        average = F.sum(F.col(value) * F.col(count)).cast("double") / filled.cast("double")
    plain = df.groupBy(*keys).agg(
        F.min(value).cast("double").alias("min_value"),
        F.max(value).cast("double").alias("max_value"),
        average.alias("avg_value"),
    )
    rounded = quartiles.select(*keys, *[F.round(q, 2).alias(q) for q in ("q1", "median", "q3")])
    return _with(plain, rounded, keys) if keys else beside(plain, rounded)


def _with(groups: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``more`` to every group; NULL keys match each other, groups it lacks (all values NULL) get NULLs."""
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    added = [F.col(f"m.{c}") for c in more.columns if c not in keys]
    return groups.alias("g").join(more.alias("m"), same, "left").select("g.*", *added)


def monthly_totals(transactions: DataFrame) -> DataFrame:
    """Rows, distinct customers, mean and sum per month. One row per customer-month feeds the distinct count."""
    month = F.trunc("transaction_date", "month").alias("month")
    return per_customer(transactions.withColumn("month", month), "month").groupBy("month").agg(
        *merged("txn_count", "avg_amount", "total_spend"), F.count("customer_id").alias("unique_customers")
    )


def usage_statistics(log: DataFrame, keys: Sequence[str], elapsed: str, volume: str) -> DataFrame:
    """Query-log report: count, median and 90th percentile of the elapsed time, median and mean of the volume."""
    found = percentiles(log, keys, {elapsed: {"median_elapsed": 0.5, "p90_elapsed": 0.9}, volume: {"median_volume": 0.5}})
    plain = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_queries"), mean(volume).alias("avg_volume"))
    return _with(plain, found, keys) if keys else beside(plain, found)


def formatted_usage(log: DataFrame, keys: Sequence[str], elapsed: str, volume: str) -> DataFrame:
    """:func:`usage_statistics` by any number of keys, with times and sizes as text."""
    stats = usage_statistics(log, keys, elapsed, volume)
    return stats.select(
        *keys, "count_queries", *[format_millis(F.floor(c)).alias(c) for c in ("median_elapsed", "p90_elapsed")],
        *[format_bytes(F.floor(c)).alias(c) for c in ("median_volume", "avg_volume")],
    )


def size_totals(files: DataFrame, keys: Sequence[str], size: str, over: int = 262_144_000) -> DataFrame:
    """Files above ``over`` by table: number, mean and total size, as text and in whole bytes."""
    s = F.col(size)
    totals = files.where(s > over).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"), F.floor(mean(s)).cast("bigint").alias("avg_file_size_bytes"), F.sum(s).cast("bigint").alias("total_file_size_bytes")
    )
    return totals.withColumns({
        "avg_file_size": format_bytes("avg_file_size_bytes"), "total_file_size": format_bytes("total_file_size_bytes"),
    })


def size_bands(files: DataFrame, size: str, low: int, high: int) -> DataFrame:
    """Mean and count of sizes up to ``low``, between both bounds (both included), and above ``high``."""
    s = F.col(size)
    bands = {"small": s <= low, "middle": s.between(low, high), "large": s > high}
    out = []
    for name, hit in bands.items():
        inside = F.when(hit, s)
        out += [mean(inside).alias(f"avg_{name}"), F.count(inside).alias(f"count_{name}")]
    return files.agg(*out)


def with_and_without(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers with and without any transaction, and their shares."""
    active = transactions.select("customer_id").distinct().withColumn("_seen", F.lit(True))
    status = F.when(F.col("_seen"), "With Transactions").otherwise("No Transactions")
    counts = (
        customers.select("customer_id").join(active, "customer_id", "left")
        .groupBy(status.alias("customer_status")).agg(F.count(F.lit(1)).alias("customer_count"))
    )
    return share_of_total(counts, "customer_count", "percentage")


def segment_activity(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per declared segment: customers, active customers, transactions and spend, unmatched customers included."""
    joined = customers.select("customer_id", "customer_segment").join(per_customer(transactions), "customer_id", "left")
    n = F.count(F.lit(1))
    return joined.groupBy("customer_segment").agg(
        n.alias("total_customers"),
        F.count("_n").alias("customers_with_transactions"),
        *merged("txn_count", "min_amount", "avg_amount", "max_amount", "total_spend"),
    ).withColumns({
        "avg_txns_per_customer": F.round(safe_divide(F.col("txn_count").cast("double"), F.col("total_customers")), 2),
        "spend_per_customer": safe_divide(F.col("total_spend").cast("double"), F.col("total_customers").cast("double")),
    })


def activity_rate(customers: DataFrame, transactions: DataFrame, since) -> DataFrame:
    """Share of all customers with a transaction on or after ``since``."""
    active = transactions.where(F.col("transaction_date") >= F.lit(since)).select("customer_id").distinct()
    counted = active.agg(F.count(F.lit(1)).alias("active_customers"))
    total = customers.agg(F.count(F.lit(1)).alias("total_customers"))
    return beside(counted, total).withColumn("active_pct", pct("active_customers", "total_customers"))
