"""Customer metrics: transaction summary, segments, LTV / ATV, 360 profile, monthly mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import banded, mean
from clientele.functions.dates import days_before, days_between, months_between_boundaries, on
from clientele.operators.ordered import ROWS, heavy_keys, is_same
from clientele.operators.selection import percentiles

# Categories that count as travel and as necessities.
TRAVEL = ("Travel", "Airlines", "Hotels")
NECESSITIES = ("Grocery", "Gas", "Utilities")
# Names of the behavioural segments.
TRAVELERS, DECLINING, GROWING, BUDGET, STABLE = (
    "High-Value Travelers", "Declining", "New & Growing", "Budget-Conscious", "Stable Mid-Spenders",
)
# Band labels.
TIERS = [(10_000, "<$10K"), (50_000, "$10K-$50K"), (100_000, "$50K-$100K")]
RECENCY = [(30, "Active (30 days)"), (60, "Recent (60 days)"), (90, "At Risk (90 days)")]


@dataclass(frozen=True)
class SegmentRules:
    """Thresholds of the segment rules, applied in the order of the fields."""

    travel_monthly_spend: float = 5000
    travel_share: float = 25
    decline_change: float = -30
    decline_prior_spend: float = 2000
    growth_tenure: int = 6
    growth_change: float = 50
    budget_monthly_spend: float = 1500
    budget_share: float = 60


def consistency(stddev) -> Column:
    """Band of the spread; no spread at all is reported as 'No Transactions'."""
    s = F.col(stddev) if isinstance(stddev, str) else stddev
    return F.when(s.isNull() | (s == 0), "No Transactions").otherwise(
        banded(s, [(50, "Consistent"), (200, "Moderate")], "Variable")
    )


def spend_change(last: Column, prior: Column) -> Column:
    """Change in percent, 0 without prior spend."""
    return F.when(prior > 0, (last - prior) / prior * 100).otherwise(0.0)


def customer_summary(
    fact: DataFrame, as_of: dt.date | str, key: str = "customer_id", median: bool = True, most: int = ROWS, feed: DataFrame | None = None
) -> DataFrame:
    """All per-customer aggregates in one pass over the fact: lifetime, value spread, 90-day windows, category shares.

    ``as_of`` is a date, or the name of a date column of the fact: then one row per customer and date is made (see
    :func:`at_dates`).

    One lazy aggregate with a map-side part. The exact median belongs to it, too, unless a customer has more than ``most``
    rows, which is counted first (``feed``: see :func:`heavy_keys`): then the sums merge map-side without the median, and
    :func:`percentiles` selects the medians. Jobs that do not read the median leave it out.
    """
    if isinstance(as_of, str):
        keys, today = [key, as_of], F.col(as_of)
        recent, prior = F.date_sub(today, 90), F.date_sub(today, 180)
    else:
        keys, today = [key], on(as_of)
        recent, prior = F.lit(days_before(as_of, 90)), F.lit(days_before(as_of, 180))
    day, amount = F.col("transaction_date"), F.col("amount")
    parts = {
        "spend_last_90_days": day >= recent,
        "spend_prior_90_days": (day >= prior) & (day < recent),
        "_travel": F.col("category_name").isin(*TRAVEL),
        "_necessities": F.col("category_name").isin(*NECESSITIES),
    }
    inline = median and not heavy_keys(fact, keys, most, feed)
    middle = F.round(F.percentile(amount.cast("double"), F.lit(0.5)), 4) if inline else F.lit(None).cast("double")
    base = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amount).cast("double").alias("lifetime_value"),
        F.min(day).alias("first_transaction_date"),
        F.max(day).alias("last_transaction_date"),
        mean(amount).alias("avg_transaction_value"),
        F.round(F.stddev_samp(amount.cast("double")), 4).alias("transaction_value_stddev"),
        F.min(amount).cast("double").alias("min_transaction_value"),
        F.max(amount).cast("double").alias("max_transaction_value"),
        *[F.sum(F.when(hit, amount).otherwise(0)).cast("double").alias(name) for name, hit in parts.items()],
        middle.alias("median_transaction_value"),
    )
    if median and not inline:
        medians = percentiles(fact, keys, {"amount": {"_median": 0.5}}, most=most)
        base = base.alias("l").join(medians.alias("r"), is_same(keys, "l", "r"), "left").select(
            "l.*", F.round("_median", 4).alias("_median")
        ).withColumn("median_transaction_value", F.col("_median"))
    age, ltv = days_between("first_transaction_date", "last_transaction_date"), F.col("lifetime_value")
    return base.select(
        *keys,
        "total_transactions",
        "lifetime_value",
        "first_transaction_date",
        "last_transaction_date",
        age.alias("customer_age_days"),
        F.when(age > 0, ltv / age).otherwise(0.0).alias("avg_spend_per_day"),
        "avg_transaction_value",
        "transaction_value_stddev",
        "min_transaction_value",
        "max_transaction_value",
        "median_transaction_value",
        consistency("transaction_value_stddev").alias("spending_consistency"),
        "spend_last_90_days",
        "spend_prior_90_days",
        spend_change(F.col("spend_last_90_days"), F.col("spend_prior_90_days")).alias("spend_change_pct"),
        (F.col("spend_last_90_days") / 3).alias("avg_monthly_spend"),
        F.when(ltv > 0, F.col("_travel") / ltv * 100).otherwise(0.0).alias("travel_spend_pct"),
        F.when(ltv > 0, F.col("_necessities") / ltv * 100).otherwise(0.0).alias("necessities_spend_pct"),
        months_between_boundaries("first_transaction_date", today).alias("tenure_months"),
        today.alias("metric_calculated_date"),
    )


def at_dates(fact: DataFrame, dates: Sequence[dt.date], name: str = "as_of") -> DataFrame:
    """The fact as it was known before each of the ``dates``: one scan serves all reference dates."""
    return fact.select("*", F.explode(F.array(*[F.lit(d) for d in dates])).alias(name)).where(
        F.col("transaction_date") < F.col(name)
    )


def assign_segments(summary: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """First matching rule decides the segment; the rest are stable."""
    monthly, change = F.col("avg_monthly_spend"), F.col("spend_change_pct")
    segment = (
        F.when((monthly >= rules.travel_monthly_spend) & (F.col("travel_spend_pct") >= rules.travel_share), TRAVELERS)
        .when((change <= rules.decline_change) & (F.col("spend_prior_90_days") >= rules.decline_prior_spend), DECLINING)
        .when((F.col("tenure_months") <= rules.growth_tenure) & (change >= rules.growth_change), GROWING)
        .when((monthly < rules.budget_monthly_spend) & (F.col("necessities_spend_pct") >= rules.budget_share), BUDGET)
        .otherwise(STABLE)
    )
    return summary.withColumn("customer_segment", segment).withColumn(
        "segment_assigned_date", F.col("metric_calculated_date")
    )


LTV_COLUMNS = (
    "customer_id", "customer_segment", "lifetime_value", "total_transactions", "first_transaction_date",
    "last_transaction_date", "customer_age_days", "avg_spend_per_day", "metric_calculated_date",
)
ATV_COLUMNS = (
    "customer_id", "customer_segment", "avg_transaction_value", "transaction_value_stddev", "min_transaction_value",
    "max_transaction_value", "transaction_count", "median_transaction_value", "spending_consistency",
    "metric_calculated_date",
)


def ltv_metric(summary: DataFrame, segments: DataFrame) -> DataFrame:
    """Lifetime value per customer with the segment, for customers with and without one."""
    return summary.join(segments.select("customer_id", "customer_segment"), "customer_id", "left").select(*LTV_COLUMNS)


def atv_metric(summary: DataFrame, segments: DataFrame) -> DataFrame:
    """Average transaction value per customer with the segment."""
    return (
        summary.withColumnRenamed("total_transactions", "transaction_count")
        .join(segments.select("customer_id", "customer_segment"), "customer_id", "left").select(*ATV_COLUMNS)
    )


def risk_band(score: str = "churn_risk_score") -> Column:
    s = F.col(score)
    return F.when(s >= 70, "High Risk").when(s >= 40, "Medium Risk").when(s < 40, "Low Risk").otherwise("Not Scored")


def profile(customers: DataFrame, segments: DataFrame, predictions: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per customer with demographics, segment, metrics and churn score.

    ``segments`` carries every summary column, so segment, LTV and ATV come from one customer-level table instead of
    three joins to the same summary.
    """
    demographics = customers.drop("customer_segment", "decline_type")
    scores = predictions.select("customer_id", "churn_risk_score", "predicted_churn")
    return profile_row(demographics.join(segments, "customer_id").join(scores, "customer_id", "left"), as_of)


def profile_row(joined: DataFrame, as_of: dt.date) -> DataFrame:
    """The profile columns of a row that holds demographics, summary, segment and score."""
    idle = days_between("last_transaction_date", on(as_of))
    limit, score = F.col("credit_limit").cast("double"), F.col("churn_risk_score")
    return joined.select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "first_name", "last_name", "email", "age", "state", "city", "employment_status", "card_type",
        limit.alias("credit_limit"),
        "account_open_date",
        days_between("account_open_date", on(as_of)).alias("account_age_days"),
        "customer_segment", "segment_assigned_date", "tenure_months", "lifetime_value", "total_transactions",
        "customer_age_days", "avg_spend_per_day", "avg_transaction_value", "transaction_value_stddev",
        "min_transaction_value", "max_transaction_value", "median_transaction_value", "spending_consistency",
        "spend_last_90_days", "spend_prior_90_days", "spend_change_pct", "avg_monthly_spend",
        "first_transaction_date", "last_transaction_date",
        idle.alias("days_since_last_transaction"),
        banded(idle, RECENCY, "Inactive (90+ days)", op="le").alias("recency_status"),
        "travel_spend_pct", "necessities_spend_pct",
        F.when(F.col("travel_spend_pct") >= 25, "Travel-Focused")
        .when(F.col("necessities_spend_pct") >= 60, "Necessity-Focused").otherwise("Balanced").alias("spending_profile"),
        F.when(limit > 0, F.col("spend_last_90_days") / 3 / limit * 100).otherwise(0.0).alias("credit_utilization_pct"),
        "churn_risk_score",
        risk_band().alias("churn_risk_category"),
        F.when((F.col("customer_segment") == DECLINING) | (score >= 70), True).otherwise(False)
        .alias("eligible_for_retention_campaign"),
        (F.col("customer_segment") == GROWING).alias("eligible_for_onboarding_campaign"),
        (F.col("customer_segment") == TRAVELERS).alias("eligible_for_premium_campaign"),
        "predicted_churn",
        on(as_of).alias("profile_updated_date"),
    )


def monthly_spending(transactions: DataFrame, status: str = "approved") -> DataFrame:
    """Customer-month totals of the rows with ``status``."""
    return (
        transactions.where(F.col("status") == status)
        .groupBy("customer_id", F.trunc("transaction_date", "month").alias("month"))
        .agg(
            F.sum("amount").alias("total_spend"),
            F.count("transaction_id").alias("transaction_count"),
            mean("amount").alias("avg_transaction_value"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
        )
    )


def ltv_tier(c: str = "lifetime_value") -> Column:
    return banded(c, TIERS, "$100K+")
