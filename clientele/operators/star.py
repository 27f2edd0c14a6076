"""Star schema: calendar, category and customer dimensions, fact, and point-in-time joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.functions.columns import surrogate_key
from clientele.functions.dates import date_attributes, months_before
from clientele.operators.clean import category_attributes
from clientele.operators.joins import dimension_join
from clientele.operators.ordered import ROWS

FOREVER = dt.date(9999, 12, 31)


def dim_date(spark: SparkSession, as_of: dt.date, days: int = 580, back_months: int = 18) -> DataFrame:
    """One row per calendar day, starting ``back_months`` before ``as_of``."""
    start = months_before(as_of, back_months)
    spine = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))
    return spine.select(*date_attributes("date_day", as_of))


def calendar_between(bounds: DataFrame, as_of: dt.date) -> DataFrame:
    """Calendar rows for the ``first`` and ``last`` day held by the one-row table ``bounds``."""
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date_day")).select(
        *date_attributes("date_day", as_of)
    )


def dim_category(names: DataFrame, column: str) -> DataFrame:
    """Distinct categories with attributes, numbered by name. The distinct names are few, so one window is enough."""
    distinct = names.select(F.col(column).alias("category_name")).distinct()
    key = F.row_number().over(Window.orderBy("category_name"))
    return distinct.select(key.alias("category_key"), "category_name", *category_attributes())


def initial_dimension(customers: DataFrame) -> DataFrame:
    """Full-refresh customer dimension: every row is the current version, valid from the account opening."""
    return customers.select(
        surrogate_key("customer_id", "account_open_date").alias("customer_key"),
        "*",
        F.col("account_open_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def fact_transactions(
    transactions: DataFrame, dim_customer: DataFrame, dim_cat: DataFrame, carry: Sequence[str] = (), most: int = ROWS, feed: DataFrame | None = None
) -> DataFrame:
    """Resolve the keys of the current customer version and of the category; rows without both keys are dropped.

    ``carry``: columns of either dimension to keep beside the keys, so that a star query reads each dimension once. Customers
    with very many transactions are joined apart (see :func:`dimension_join`, also for ``most`` and ``feed``).
    """
    wanted = [c for c in carry if c in dim_customer.columns]
    current = dim_customer.where("is_current").select("customer_id", "customer_key", *wanted)
    cats = dim_cat.select("category_name", F.col("category_key").alias("merchant_category_key"), *[c for c in carry if c not in wanted])
    joined = dimension_join(transactions, current, "customer_id", "inner", most, feed)
    return joined.join(cats, "category_name").select(
        surrogate_key("transaction_id").alias("transaction_key"),
        "transaction_id",
        "customer_key",
        F.date_format("transaction_date", "yyyyMMdd").cast("int").alias("date_key"),
        "merchant_category_key",
        "transaction_date",
        "merchant_id",
        "channel",
        "status",
        "amount",
        "ingestion_timestamp",
        *carry,
    )


def join_as_of(facts: DataFrame, versions: DataFrame, key: str, day: str) -> DataFrame:
    """The version that was valid on the fact's date: equal key, date inside [valid_from, valid_to].

    An equi-join with a range residual, so Spark shuffles both sides on the key (or ships the versions when they are
    measured small) and splits a skewed key's facts at run time. Every fact meets all versions of its key: for keys with
    many versions take :func:`clientele.operators.ordered.as_of_merge`.
    """
    valid = F.col(f"f.{day}").between(F.col("v.valid_from"), F.coalesce("v.valid_to", F.lit(FOREVER)))
    return facts.alias("f").join(versions.alias("v"), (F.col(f"f.{key}") == F.col(f"v.{key}")) & valid).select(
        "f.*", *[F.col(f"v.`{c}`") for c in versions.columns if c not in facts.columns]
    )


def before_after(facts: DataFrame, first_days: DataFrame, key: str, day: str) -> DataFrame:
    """Count, sum and mean of ``amount`` before and after a per-key date (columns ``key``, ``upgrade_date``).

    Facts are first reduced to (key, date), so a busy key reaches the join as one row per day.
    """
    daily = facts.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_s"))
    period = F.when(F.col(day) < F.col("upgrade_date"), "Before Upgrade").otherwise("After Upgrade")
    return daily.join(first_days, key).groupBy(key, period.alias("upgrade_period")).agg(
        F.sum("_n").alias("txn_count"),
        F.sum("_s").alias("total_spend"),
        (F.sum("_s").cast("double") / F.sum("_n").cast("double")).alias("avg_spend"),
    )


def upgrades(dim: DataFrame, card_type: str = "Premium") -> DataFrame:
    """Versions with ``card_type`` that started after the account was opened."""
    names = [c for c in ("first_name", "last_name") if c in dim.columns]
    return dim.where((F.col("card_type") == card_type) & (F.col("valid_from") > F.col("account_open_date"))).select(
        "customer_id", *names, "card_type", F.col("valid_from").alias("upgrade_date"),
        F.datediff("valid_from", "account_open_date").alias("days_to_upgrade"),
    )
