"""Customer metrics, segments, profile and campaign queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from clientele.functions.columns import money_mean, stable_mean
from clientele.functions.dates import months_before
from clientele.operators import customer as C
from clientele.operators.campaign import (
    audience, breakeven_rate, campaign_lists, campaign_roi, decline_ranks, migration_between, roi_grid,
    segment_pairs,
)
from clientele.operators.customer import SegmentRules
from clientele.operators.reports import activity_rate
from clientele.operators.windows import share_of_total
from clientele.plans import inputs
from clientele.plans.catalog import query
from clientele.plans.oracle import AS_OF as AS_OF_SQL
from clientele.plans.oracle import CTES, SCALED, avg, n, pct, segment_case, sql, stable
from clientele.session import scratch
from clientele.sources.roles import AS_OF, customers, fact, transactions


@query("agg_customer_summary", sql("select * from summary", "summary"))
def agg_customer_summary(spark, folder):
    return inputs.summary(spark, folder, median=True)


SEGMENT_COLUMNS = (
    "customer_id", "customer_segment", "segment_assigned_date", "total_transactions", "lifetime_value",
    "avg_transaction_value", "first_transaction_date", "last_transaction_date", "tenure_months", "spend_last_90_days",
    "spend_prior_90_days", "spend_change_pct", "avg_monthly_spend", "travel_spend_pct", "necessities_spend_pct",
)


@query("ca_segments", sql(f"select {', '.join(SEGMENT_COLUMNS)} from seg", "seg"))
def ca_segments(spark, folder):
    return inputs.segments(spark, folder).select(*SEGMENT_COLUMNS)


@query("agg_pct_of_total", sql(
    f"""with g as (select customer_segment, {n('count(*)')} as customer_count from seg group by 1)
    select customer_segment, customer_count, {pct('customer_count', 'sum(customer_count) over ()')} as percentage from g""",
    "seg"))
def agg_pct_of_total(spark, folder):
    counts = inputs.segments(spark, folder).groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customer_count"))
    return share_of_total(counts, "customer_count", "percentage")


@query("ca_profile", sql("select * from profile", "profile"))
def ca_profile(spark, folder):
    return inputs.profile(spark, folder, median=True)


@query("ca_segments_default", sql(
    f"select customer_id, {segment_case(SegmentRules())} as customer_segment from summary", "summary"))
def ca_segments_default(spark, folder):
    return C.assign_segments(inputs.summary(spark, folder)).select("customer_id", "customer_segment")


@query("ca_ltv", sql(f"select {', '.join(C.LTV_COLUMNS)} from seg", "seg"))
def ca_ltv(spark, folder):
    # Segment and metrics come from the same customer-level rows, so no join is needed here.
    return inputs.segments(spark, folder).select(*C.LTV_COLUMNS)


@query("ca_atv", sql(
    f"select {', '.join('total_transactions as transaction_count' if c == 'transaction_count' else c for c in C.ATV_COLUMNS)} from seg",
    "seg"))
def ca_atv(spark, folder):
    # Segment and metrics come from the same customer-level rows, so no join is needed here.
    return inputs.segments(spark, folder, median=True).withColumnRenamed("total_transactions", "transaction_count").select(
        *C.ATV_COLUMNS
    )


@query("ca_consistency", sql(
    f"select spending_consistency, {n('count(*)')} as customer_count, {stable('avg_transaction_value')} as avg_atv from summary group by 1",
    "summary"))
def ca_consistency(spark, folder):
    return inputs.summary(spark, folder).groupBy("spending_consistency").agg(
        F.count(F.lit(1)).alias("customer_count"), stable_mean("avg_transaction_value").alias("avg_atv")
    )


@query("ca_spend_change", sql(
    "select customer_id, spend_last_90_days, spend_prior_90_days, spend_change_pct, avg_monthly_spend from summary", "summary"))
def ca_spend_change(spark, folder):
    return inputs.summary(spark, folder).select(
        "customer_id", "spend_last_90_days", "spend_prior_90_days", "spend_change_pct", "avg_monthly_spend"
    )


@query("ca_ltv_tier", sql(
    f"""select case when lifetime_value < 10000 then '<$10K' when lifetime_value < 50000 then '$10K-$50K'
    when lifetime_value < 100000 then '$50K-$100K' else '$100K+' end as ltv_tier, {n('count(*)')} as customer_count from summary group by 1""",
    "summary"))
def ca_ltv_tier(spark, folder):
    return inputs.summary(spark, folder).groupBy(C.ltv_tier().alias("ltv_tier")).agg(F.count(F.lit(1)).alias("customer_count"))


@query("ca_recalculate", sql(
    f"""with g as (select customer_segment, {n('count(*)')} as customer_count from seg group by 1)
    select customer_segment, customer_count, {pct('customer_count', 'sum(customer_count) over ()')} as percentage,
    {n('sum(customer_count) over ()')} as total_customers, {n('count(*) over ()')} as segment_count from g""", "seg"))
def ca_recalculate(spark, folder):
    """Rebuild the segment table as a new written version, then report its distribution from the written table."""
    path = scratch(spark, "customer_segments")
    inputs.segments(spark, folder).write.parquet(path)
    counts = spark.read.parquet(path).groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customer_count"))
    everything = Window.partitionBy()
    return share_of_total(counts, "customer_count", "percentage").withColumns({
        "total_customers": F.sum("customer_count").over(everything), "segment_count": F.count(F.lit(1)).over(everything),
    })


# ---- segment analyses ----


def _prior_segments_sql() -> str:
    """The segment building blocks once more for the earlier reference date."""
    parts = []
    for name in ("base", "summary", "seg"):
        text = CTES[name][1].replace(AS_OF_SQL, PRIOR_SQL)
        for ref in ("base", "summary"):
            text = text.replace(f"from {ref}", f"from prior_{ref}")
        if name == "base":
            text = text.replace("from fact", f"from fact where transaction_date < {PRIOR_SQL}")
        parts.append(f"prior_{name} as ({text})")
    return ", ".join(parts)


PRIOR = dt.date(2001, 5, 2)
PRIOR_SQL = "date '2001-05-02'"


@query("ca_migration", sql(
    f"""with {_prior_segments_sql()}
    select p.customer_segment as prior_segment, c.customer_segment as current_segment, {n('count(*)')} as customer_count
    from seg c join prior_seg p using (customer_id) where p.customer_segment != c.customer_segment group by 1, 2""", "seg"))
def ca_migration(spark, folder):
    return migration_between(fact(spark, folder), SCALED, PRIOR, AS_OF)


@query("jn_self_migration", sql(
    f"""with {_prior_segments_sql()}
    select p.customer_id, p.customer_segment as prior_segment, c.customer_segment as current_segment
    from seg c join prior_seg p using (customer_id)""", "seg"))
def jn_self_migration(spark, folder):
    return segment_pairs(fact(spark, folder), SCALED, PRIOR, AS_OF)


PRIORITY_SQL = """with r as (select customer_id, lifetime_value, spend_last_90_days, spend_prior_90_days, spend_change_pct,
    cast(rank() over (order by lifetime_value desc) as bigint) as ltv_rank,
    cast(rank() over (order by spend_change_pct) as bigint) as decline_rank from seg where customer_segment = 'Declining')"""


@query("win_dual_rank", sql(f"{PRIORITY_SQL} select * from r", "seg"))
def win_dual_rank(spark, folder):
    return decline_ranks(inputs.segments(spark, folder))


@query("ca_priority", sql(f"{PRIORITY_SQL} select * from r order by ltv_rank + decline_rank, customer_id limit 100", "seg"))
def ca_priority(spark, folder):
    return decline_ranks(inputs.segments(spark, folder)).orderBy(F.col("ltv_rank") + F.col("decline_rank"), "customer_id").limit(100)


@query("ca_growth", sql(
    """select customer_id, tenure_months, spend_change_pct, avg_monthly_spend, lifetime_value, avg_monthly_spend * 12 as projected_annual_value
    from seg where customer_segment = 'New & Growing' order by projected_annual_value desc, customer_id limit 100""", "seg"))
def ca_growth(spark, folder):
    return inputs.segments(spark, folder).where(F.col("customer_segment") == C.GROWING).select(
        "customer_id", "tenure_months", "spend_change_pct", "avg_monthly_spend", "lifetime_value",
        (F.col("avg_monthly_spend") * 12).alias("projected_annual_value"),
    ).orderBy(F.desc("projected_annual_value"), "customer_id").limit(100)


@query("ca_campaign_lists", sql(
    """(select 'premium' as campaign, cust.customer_id, email, lifetime_value, avg_monthly_spend, spend_change_pct from seg join cust using (customer_id)
        where seg.customer_segment = 'High-Value Travelers' and avg_monthly_spend >= 7500 order by lifetime_value desc, customer_id limit 5000)
    union all (select 'retention', cust.customer_id, email, lifetime_value, avg_monthly_spend, spend_change_pct from seg join cust using (customer_id)
        where seg.customer_segment = 'Declining' and lifetime_value >= 50000 order by spend_change_pct, customer_id limit 1000)
    union all (select 'onboarding', cust.customer_id, email, lifetime_value, avg_monthly_spend, spend_change_pct from seg join cust using (customer_id)
        where seg.customer_segment = 'New & Growing' and avg_monthly_spend >= 3000 order by spend_change_pct desc, customer_id limit 2000)""",
    "seg", "cust"))
def ca_campaign_lists(spark, folder):
    return campaign_lists(inputs.segments(spark, folder), customers(spark, folder).select("customer_id", "email"))


# ---- lists and campaigns over the profile ----


@query("ca_retention_list", sql(
    """select customer_id, full_name, email, churn_risk_score, lifetime_value, spend_change_pct from profile
    where churn_risk_category = 'High Risk' and lifetime_value > 5000""", "profile"))
def ca_retention_list(spark, folder):
    wanted = (F.col("churn_risk_category") == "High Risk") & (F.col("lifetime_value") > 5000)
    return inputs.profile(spark, folder).where(wanted).select(
        "customer_id", "full_name", "email", "churn_risk_score", "lifetime_value", "spend_change_pct"
    ).orderBy(F.desc("churn_risk_score"))


@query("ca_early_warning", sql(
    """select customer_id, full_name, churn_risk_score, days_since_last_transaction, spend_change_pct from profile
    where churn_risk_category in ('Medium Risk', 'High Risk') and days_since_last_transaction > 30""", "profile"))
def ca_early_warning(spark, folder):
    wanted = F.col("churn_risk_category").isin("Medium Risk", "High Risk") & (F.col("days_since_last_transaction") > 30)
    return inputs.profile(spark, folder).where(wanted).select(
        "customer_id", "full_name", "churn_risk_score", "days_since_last_transaction", "spend_change_pct"
    ).orderBy(F.desc("churn_risk_score"))


@query("ca_win_back", sql(
    """select customer_id, full_name, email, lifetime_value, days_since_last_transaction from profile
    where predicted_churn and lifetime_value > 10000 and days_since_last_transaction between 200 and 400""", "profile"))
def ca_win_back(spark, folder):
    wanted = (
        F.col("predicted_churn") & (F.col("lifetime_value") > 10000) & F.col("days_since_last_transaction").between(200, 400)
    )
    return inputs.profile(spark, folder).where(wanted).select(
        "customer_id", "full_name", "email", "lifetime_value", "days_since_last_transaction"
    ).orderBy(F.desc("lifetime_value"))


@query("ca_segment_risk", sql(
    f"""select customer_segment, churn_risk_category, {n('count(*)')} as customer_count,
    {avg('cast(churn_risk_score as decimal(28,2))')} as avg_risk from profile group by 1, 2""", "profile"))
def ca_segment_risk(spark, folder):
    return inputs.profile(spark, folder).groupBy("customer_segment", "churn_risk_category").agg(
        F.count(F.lit(1)).alias("customer_count"), money_mean("churn_risk_score").alias("avg_risk")
    )


AUDIENCE_COLUMNS = (
    "customer_id", "full_name", "email", "customer_segment", "churn_risk_category", "churn_risk_score", "card_type",
    "lifetime_value", "avg_monthly_spend", "spend_last_90_days", "state",
)
AUDIENCE_SQL = """customer_segment in ('Declining', 'Stable Mid-Spenders') and churn_risk_category in ('Medium Risk', 'High Risk')
    and card_type in ('Premium') and lifetime_value >= 1000000 and churn_risk_score >= 40"""


def _audience(spark, folder):
    return audience(
        inputs.profile(spark, folder),
        {
            "customer_segment": ["Declining", "Stable Mid-Spenders"],
            "churn_risk_category": ["Medium Risk", "High Risk"],
            "card_type": ["Premium"],
        },
        {"lifetime_value": 1_000_000, "churn_risk_score": 40},
    )


@query("flt_audience", sql(f"select {', '.join(AUDIENCE_COLUMNS)} from profile where {AUDIENCE_SQL}", "profile"))
def flt_audience(spark, folder):
    return _audience(spark, folder).select(*AUDIENCE_COLUMNS).orderBy(F.desc("churn_risk_score"), F.desc("lifetime_value"))


EXPLORER_COLUMNS = (
    "customer_id", "full_name", "email", "state", "city", "customer_segment", "card_type", "lifetime_value",
    "avg_transaction_value", "churn_risk_category", "churn_risk_score", "days_since_last_transaction",
)


@query("flt_segment_explorer", sql(
    f"""select {', '.join(EXPLORER_COLUMNS)} from profile where customer_segment in ('Stable Mid-Spenders', 'Declining')
    and churn_risk_category = 'Low Risk' and lifetime_value >= 500000 order by lifetime_value desc, customer_id limit 5000""", "profile"))
def flt_segment_explorer(spark, folder):
    found = audience(
        inputs.profile(spark, folder),
        {"customer_segment": ["Stable Mid-Spenders", "Declining"], "churn_risk_category": ["Low Risk"]},
        {"lifetime_value": 500_000},
    )
    return found.select(*EXPLORER_COLUMNS).orderBy(F.desc("lifetime_value"), "customer_id").limit(5000)


ROI_SQL = f"""agg as (select {n('count(*)')} as num_customers, cast(sum(cast(lifetime_value as decimal(28,2))) as double) / count(*) as avg_ltv
    from profile where {AUDIENCE_SQL}),
    costs as (select *, num_customers * 50.0::double as incentive_cost, num_customers * 5.0::double as campaign_cost,
        num_customers * 50.0::double + num_customers * 5.0::double as total_cost from agg),
    grid as (select costs.*, rate, cast(trunc(num_customers * (rate / 100.0::double)) as bigint) as expected_retained_customers
        from costs, (select cast(unnest(range(1, 101)) as bigint) as rate)),
    roi as (select *, expected_retained_customers * avg_ltv * 0.2::double as expected_retained_value,
        expected_retained_customers * avg_ltv * 0.2::double - total_cost as net_benefit,
        case when total_cost > 0 then (expected_retained_customers * avg_ltv * 0.2::double - total_cost) / total_cost * 100 else 0.0::double end as roi_pct,
        case when expected_retained_customers > 0 then total_cost / expected_retained_customers else 0.0::double end as cost_per_retained_customer from grid)"""


@query("ca_campaign_roi", sql(
    f"with {ROI_SQL} select * exclude (rate, avg_ltv) from roi where rate = 30", "profile"))
def ca_campaign_roi(spark, folder):
    return campaign_roi(_audience(spark, folder), incentive=50.0, cost=5.0, rate=30)


@query("ca_roi_grid", sql(
    f"with {ROI_SQL} select rate, roi_pct, net_benefit from roi where rate % 10 = 0 and rate <= 80", "profile"))
def ca_roi_grid(spark, folder):
    return roi_grid(_audience(spark, folder), incentive=50.0, cost=5.0, rates=range(10, 81, 10)).select(
        "rate", "roi_pct", "net_benefit"
    )


@query("ca_breakeven", sql(f"with {ROI_SQL} select min(rate) as breakeven_rate from roi where roi_pct >= 0", "profile"))
def ca_breakeven(spark, folder):
    return breakeven_rate(_audience(spark, folder), incentive=50.0, cost=5.0)


@query("ca_activity_rate", sql(
    f"""select {n(f"count(distinct case when transaction_date >= {AS_OF_SQL} - interval 1 month then txn.customer_id end)")} as active_customers,
    {n('(select count(*) from cust)')} as total_customers,
    {pct(f"count(distinct case when transaction_date >= {AS_OF_SQL} - interval 1 month then txn.customer_id end)", '(select count(*) from cust)')} as active_pct
    from txn""", "txn", "cust"))
def ca_activity_rate(spark, folder):
    return activity_rate(customers(spark, folder), transactions(spark, folder), months_before(AS_OF, 1))
