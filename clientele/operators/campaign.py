"""Audiences, campaign lists, return on investment, segment migration and priorities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import money_mean
from clientele.operators import customer as C
from clientele.operators.windows import global_ranks
from clientele.session import checkpointed

# Fixed value: share of the lifetime value that counts as one year's value of a retained customer.
ANNUAL_SHARE = 0.2


def audience(profile: DataFrame, any_of: Mapping[str, Iterable], at_least: Mapping[str, float]) -> DataFrame:
    """Rows that match every given value list and minimum; empty lists do not filter. Values are bound as literals."""
    terms: list[Column] = [F.col(c).isin(*values) for c, values in any_of.items() if values]
    terms += [F.col(c) >= F.lit(bound) for c, bound in at_least.items()]
    return profile.where(reduce(lambda a, b: a & b, terms)) if terms else profile


def search(profile: DataFrame, customer_id=None, name: str | None = None, email: str | None = None, limit: int = 20) -> DataFrame:
    """One customer by id, or the first customers whose name or email contains a text in any case."""
    if customer_id is not None:
        return profile.where(F.col("customer_id") == F.lit(customer_id))
    column, text = ("full_name", name) if name is not None else ("email", email)
    return profile.where(F.contains(F.lower(column), F.lower(F.lit(text)))).orderBy("customer_id").limit(limit)


def history(
    fact: DataFrame, as_of: dt.date, days: int | None = None, category: str | None = None, status: str | None = None,
    customer_id=None,
) -> DataFrame:
    """Transactions of the last ``days`` days, optionally of one category, status or customer."""
    if days is not None:
        fact = fact.where(F.col("transaction_date") >= F.lit(as_of - dt.timedelta(days=days)))
    for column, value in (("category_name", category), ("status", status), ("customer_id", customer_id)):
        if value is not None:
            fact = fact.where(F.col(column) == F.lit(value))
    return fact


def _roi(targets: DataFrame, incentive: float, cost: float, rates: Column) -> DataFrame:
    """ROI figures for each rate of the array ``rates``; the audience is reduced to one row first."""
    n, retained = F.col("num_customers"), F.col("expected_retained_customers")
    one = targets.agg(F.count(F.lit(1)).alias("num_customers"), money_mean("lifetime_value").alias("avg_ltv"))
    return (
        one.withColumns({"incentive_cost": n * F.lit(float(incentive)), "campaign_cost": n * F.lit(float(cost))})
        .withColumn("total_cost", F.col("incentive_cost") + F.col("campaign_cost"))
        .withColumn("rate", F.explode(rates))
        .withColumn("expected_retained_customers", (n * (F.col("rate") / F.lit(100.0))).cast("bigint"))
        .withColumn("expected_retained_value", retained * F.col("avg_ltv") * F.lit(ANNUAL_SHARE))
        .withColumn("net_benefit", F.col("expected_retained_value") - F.col("total_cost"))
        .withColumn(
            "roi_pct", F.when(F.col("total_cost") > 0, F.col("net_benefit") / F.col("total_cost") * 100).otherwise(0.0)
        )
        .withColumn(
            "cost_per_retained_customer", F.when(retained > 0, F.col("total_cost") / retained).otherwise(0.0)
        )
        .drop("avg_ltv")
    )


def campaign_roi(targets: DataFrame, incentive: float, cost: float, rate: float) -> DataFrame:
    return _roi(targets, incentive, cost, F.array(F.lit(rate))).drop("rate")


def roi_grid(targets: DataFrame, incentive: float, cost: float, rates: Iterable[int]) -> DataFrame:
    return _roi(targets, incentive, cost, F.array(*[F.lit(r) for r in rates]))


def breakeven_rate(targets: DataFrame, incentive: float, cost: float) -> DataFrame:
    """Least whole retention rate from 1 to 100 whose ROI is not negative; NULL when there is none."""
    grid = _roi(targets, incentive, cost, F.sequence(F.lit(1), F.lit(100)))
    return grid.agg(F.min(F.when(F.col("roi_pct") >= 0, F.col("rate"))).alias("breakeven_rate"))


def campaign_lists(segments: DataFrame, contacts: DataFrame) -> DataFrame:
    """The three contact lists. Each list is cut to its length first and joined to the contacts afterwards.

    Members of the three segments are checkpointed, so that the job behind them runs once and not for each list.
    """
    segments = checkpointed(segments.where(F.col("customer_segment").isin(C.TRAVELERS, C.DECLINING, C.GROWING)).select(
        "customer_id", "customer_segment", "lifetime_value", "avg_monthly_spend", "spend_change_pct"
    ))
    value, change, monthly = F.col("lifetime_value"), F.col("spend_change_pct"), F.col("avg_monthly_spend")
    lists = [
        ("premium", C.TRAVELERS, monthly >= 7500, value.desc(), 5000),
        ("retention", C.DECLINING, value >= 50000, change.asc(), 1000),
        ("onboarding", C.GROWING, monthly >= 3000, change.desc(), 2000),
    ]
    picked = [
        segments.where((F.col("customer_segment") == segment) & rule).orderBy(order, "customer_id").limit(size)
        .select(F.lit(name).alias("campaign"), "customer_id", "lifetime_value", "avg_monthly_spend", "spend_change_pct")
        for name, segment, rule, order, size in lists
    ]
    return reduce(DataFrame.unionByName, picked).join(contacts, "customer_id")


def decline_ranks(segments: DataFrame) -> DataFrame:
    """Declining customers ranked by value and by severity of the decline, both ranks from one stored table."""
    declining = segments.where(F.col("customer_segment") == C.DECLINING).select(
        "customer_id", "lifetime_value", "spend_last_90_days", "spend_prior_90_days", "spend_change_pct"
    )
    return global_ranks(declining, {"ltv_rank": ("lifetime_value", False), "decline_rank": ("spend_change_pct", True)})


def segment_pairs(fact: DataFrame, rules: C.SegmentRules, before: dt.date, now: dt.date) -> DataFrame:
    """Segment of every customer at two reference dates, from one pass over the fact.

    Both snapshots of a customer land in the same group, so no join of two snapshots is needed.
    """
    both = C.assign_segments(C.customer_summary(C.at_dates(fact, [before, now]), "as_of", median=False), rules)

    def at(day: dt.date) -> Column:
        return F.max(F.when(F.col("as_of") == F.lit(day), F.col("customer_segment")))

    return both.groupBy("customer_id").agg(at(before).alias("prior_segment"), at(now).alias("current_segment")).where(
        F.col("prior_segment").isNotNull() & F.col("current_segment").isNotNull()
    )


def migration_between(fact: DataFrame, rules: C.SegmentRules, before: dt.date, now: dt.date) -> DataFrame:
    """Customers that changed segment between two reference dates, counted per pair of segments."""
    moved = segment_pairs(fact, rules, before, now).where(F.col("prior_segment") != F.col("current_segment"))
    return moved.groupBy("prior_segment", "current_segment").agg(F.count(F.lit(1)).alias("customer_count"))
