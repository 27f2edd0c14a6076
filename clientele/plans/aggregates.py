"""Grouped reports, verified queries and exploratory profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clientele.functions.columns import flag_count, mean, money_mean, stable_mean
from clientele.functions.dates import days_between, months_before, months_between_boundaries, on
from clientele.operators import reports as R
from clientele.operators.clean import category_attributes
from clientele.operators.customer import monthly_spending
from clientele.operators.windows import share_of_total
from clientele.plans import inputs
from clientele.plans.catalog import query
from clientele.plans.oracle import AS_OF as AS_OF_SQL
from clientele.plans.oracle import avg, d, days, month_of, months, n, pct, rnd, sql, stable
from clientele.sources.roles import AS_OF, customers, fact, table, transactions

# ---- verified queries over the profile ----


@query("vq_top_ltv", sql(
    """select customer_id, full_name, customer_segment, lifetime_value, total_transactions from profile
    order by lifetime_value desc, customer_id limit 10""", "profile"))
def vq_top_ltv(spark, folder):
    return inputs.profile(spark, folder).select(
        "customer_id", "full_name", "customer_segment", "lifetime_value", "total_transactions"
    ).orderBy(F.desc("lifetime_value"), "customer_id").limit(10)


RISK_COLUMNS = ("customer_id", "full_name", "customer_segment", "churn_risk_score", "churn_risk_category",
                "days_since_last_transaction", "spend_change_pct")


@query("vq_high_risk", sql(
    f"select {', '.join(RISK_COLUMNS)} from profile where churn_risk_category = 'High Risk'", "profile"))
def vq_high_risk(spark, folder):
    return inputs.profile(spark, folder).where(F.col("churn_risk_category") == "High Risk").select(*RISK_COLUMNS).orderBy(
        F.desc("churn_risk_score"), "customer_id"
    )


@query("agg_segment_summary", sql(
    f"""select customer_segment, {n('count(*)')} as customer_count, {avg('cast(lifetime_value as decimal(28,2))')} as avg_lifetime_value,
    {avg('cast(churn_risk_score as decimal(28,2))')} as avg_churn_risk, round(sum(lifetime_value), 2) as total_ltv
    from profile group by 1""", "profile"))
def agg_segment_summary(spark, folder):
    return inputs.profile(spark, folder).groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_mean("lifetime_value").alias("avg_lifetime_value"),
        money_mean("churn_risk_score").alias("avg_churn_risk"),
        F.round(F.sum("lifetime_value"), 2).alias("total_ltv"),
    )


@query("agg_monthly_volume", sql(
    f"""select {month_of('transaction_date')} as month, {n('count(*)')} as transaction_count, {d('sum(amount)')} as total_amount,
    {avg('amount')} as avg_amount from txn where status = 'approved' group by 1 order by 1 desc limit 12""", "txn"))
def agg_monthly_volume(spark, folder):
    return (
        transactions(spark, folder).where(F.col("status") == "approved")
        .groupBy(F.trunc("transaction_date", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_amount"), mean("amount").alias("avg_amount"))
        .orderBy(F.desc("month")).limit(12)
    )


@query("agg_category_spend", sql(
    f"""select fact.category_name, category_group, {n('count(*)')} as transaction_count, {d('sum(amount)')} as total_spend
    from fact join cat on fact.category_name = cat.category_name where status = 'approved' group by 1, 2""", "fact", "cat"))
def agg_category_spend(spark, folder):
    approved = fact(spark, folder).where(F.col("status") == "approved")
    per_category = approved.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_spend")
    )
    return per_category.select("category_name", category_attributes()[0], "transaction_count", "total_spend")


DECLINING_COLUMNS = ("customer_id", "full_name", "state", "lifetime_value", "spend_last_90_days", "spend_prior_90_days",
                     "spend_change_pct", "days_since_last_transaction", "churn_risk_category")


@query("vq_declining", sql(
    f"""select {', '.join(DECLINING_COLUMNS)} from profile where customer_segment = 'Declining'
    order by spend_change_pct, customer_id limit 50""", "profile"))
def vq_declining(spark, folder):
    return inputs.profile(spark, folder).where(F.col("customer_segment") == "Declining").select(*DECLINING_COLUMNS).orderBy(
        "spend_change_pct", "customer_id"
    ).limit(50)


@query("agg_card_perf", sql(
    f"""select card_type, {n('count(*)')} as customer_count, {avg('cast(lifetime_value as decimal(28,2))')} as avg_ltv,
    {stable('credit_utilization_pct')} as avg_utilization, {avg('total_transactions')} as avg_txn_count,
    {n("count(*) filter (where churn_risk_category = 'High Risk')")} as high_risk_count from profile group by 1""", "profile"))
def agg_card_perf(spark, folder):
    return inputs.profile(spark, folder).groupBy("card_type").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_mean("lifetime_value").alias("avg_ltv"),
        stable_mean("credit_utilization_pct").alias("avg_utilization"),
        mean("total_transactions").alias("avg_txn_count"),
        flag_count(F.col("churn_risk_category") == "High Risk").alias("high_risk_count"),
    )


@query("agg_state_top", sql(
    f"""select state, {n('count(*)')} as customer_count, {avg('cast(lifetime_value as decimal(28,2))')} as avg_ltv,
    round(sum(lifetime_value), 2) as total_ltv from profile group by 1 order by customer_count desc, state limit 10""", "profile"))
def agg_state_top(spark, folder):
    return inputs.profile(spark, folder).groupBy("state").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_mean("lifetime_value").alias("avg_ltv"),
        F.round(F.sum("lifetime_value"), 2).alias("total_ltv"),
    ).orderBy(F.desc("customer_count"), "state").limit(10)


@query("agg_state_compare", sql(
    f"""select state, {n('count(*)')} as customer_count, round(sum(lifetime_value), 2) as total_spending,
    {avg('cast(lifetime_value as decimal(28,2))')} as avg_spending_per_customer, round(sum(spend_last_90_days), 2) as spending_last_90_days,
    {stable('avg_transaction_value')} as avg_transaction_value
    from profile where state in ('NATION_3', 'NATION_7') group by 1""", "profile"))
def agg_state_compare(spark, folder):
    return inputs.profile(spark, folder).where(F.col("state").isin("NATION_3", "NATION_7")).groupBy("state").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.round(F.sum("lifetime_value"), 2).alias("total_spending"),
        money_mean("lifetime_value").alias("avg_spending_per_customer"),
        F.round(F.sum("spend_last_90_days"), 2).alias("spending_last_90_days"),
        stable_mean("avg_transaction_value").alias("avg_transaction_value"),
    )


FIVE_STATES = ("NATION_1", "NATION_2", "NATION_5", "NATION_11", "NATION_20")


@query("agg_state_multi", sql(
    f"""select state, {n('count(*)')} as customer_count, round(sum(lifetime_value), 2) as total_lifetime_value,
    {avg('cast(lifetime_value as decimal(28,2))')} as avg_lifetime_value, {avg('cast(spend_last_90_days as decimal(28,2))')} as avg_recent_spending,
    {n("count(case when customer_segment = 'High-Value Travelers' then 1 end)")} as high_value_count,
    {n("count(case when churn_risk_category = 'High Risk' then 1 end)")} as high_risk_count
    from profile where state in {FIVE_STATES} group by 1""", "profile"))
def agg_state_multi(spark, folder):
    return inputs.profile(spark, folder).where(F.col("state").isin(*FIVE_STATES)).groupBy("state").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.round(F.sum("lifetime_value"), 2).alias("total_lifetime_value"),
        money_mean("lifetime_value").alias("avg_lifetime_value"),
        money_mean("spend_last_90_days").alias("avg_recent_spending"),
        flag_count(F.col("customer_segment") == "High-Value Travelers").alias("high_value_count"),
        flag_count(F.col("churn_risk_category") == "High Risk").alias("high_risk_count"),
    )


@query("agg_state_segment", sql(
    f"""select state, customer_segment, {n('count(*)')} as customer_count, {avg('cast(lifetime_value as decimal(28,2))')} as avg_ltv,
    {avg('cast(churn_risk_score as decimal(28,2))')} as avg_churn_risk from profile group by 1, 2""", "profile"))
def agg_state_segment(spark, folder):
    return inputs.profile(spark, folder).groupBy("state", "customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_mean("lifetime_value").alias("avg_ltv"),
        money_mean("churn_risk_score").alias("avg_churn_risk"),
    )


# ---- star queries ----


def _rows_and_spend(alias_avg: str | None = None):
    out = [F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_spend")]
    return out + ([mean("amount").alias(alias_avg)] if alias_avg else [])


@query("agg_star_segment_category", sql(
    f"""select customer_segment, category_group, year(transaction_date) as year, strftime(transaction_date, '%b') as month_name,
    {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend, {avg('amount')} as avg_txn_amount
    from fact join cust using (customer_id) join cat using (category_name) where year(transaction_date) = 2000 group by 1, 2, 3, 4""",
    "fact", "cust", "cat"))
def agg_star_segment_category(spark, folder):
    # The year filter is a range on the date, so it reaches the scan of orders.
    year = fact(spark, folder).where(F.col("transaction_date").between(F.lit(dt.date(2000, 1, 1)), F.lit(dt.date(2000, 12, 31))))
    daily = year.groupBy("customer_id", "category_name", F.trunc("transaction_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum")
    )
    return daily.join(customers(spark, folder).select("customer_id", "customer_segment"), "customer_id").groupBy(
        "customer_segment", category_attributes()[0], F.year("month").alias("year"), F.date_format("month", "MMM").alias("month_name")
    ).agg(
        F.sum("_n").alias("txn_count"), F.sum("_sum").alias("total_spend"),
        (F.sum("_sum").cast("double") / F.sum("_n").cast("double")).alias("avg_txn_amount"),
    )


@query("agg_star_current", sql(
    f"select customer_segment, {d('sum(amount)')} as total_spend from txn join cust using (customer_id) group by 1", "txn", "cust"))
def agg_star_current(spark, folder):
    spend = R.per_customer(transactions(spark, folder))
    return spend.join(customers(spark, folder), "customer_id").groupBy("customer_segment").agg(*R.merged("total_spend"))


@query("agg_star_weekend_trend", sql(
    f"""select strftime(transaction_date, '%Y-%m') as year_month, strftime(transaction_date, '%b') as month_name,
    dayofweek(transaction_date) in (0, 6) as is_weekend, {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend
    from txn group by 1, 2, 3""", "txn"))
def agg_star_weekend_trend(spark, folder):
    daily = transactions(spark, folder).groupBy("transaction_date").agg(*_rows_and_spend())
    return daily.groupBy(
        F.date_format("transaction_date", "yyyy-MM").alias("year_month"),
        F.date_format("transaction_date", "MMM").alias("month_name"),
        F.dayofweek("transaction_date").isin(1, 7).alias("is_weekend"),
    ).agg(F.sum("txn_count").alias("txn_count"), F.sum("total_spend").alias("total_spend"))


@query("agg_star_discretionary", sql(
    f"""select customer_segment, discretionary_flag, category_group, {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend,
    {avg('amount')} as avg_spend from fact join cust using (customer_id) join cat using (category_name) group by 1, 2, 3""",
    "fact", "cust", "cat"))
def agg_star_discretionary(spark, folder):
    spend = R.per_customer(fact(spark, folder), "category_name").join(customers(spark, folder), "customer_id")
    group, _, flag = category_attributes()
    return spend.groupBy("customer_segment", flag, group).agg(*R.merged("txn_count", "total_spend", "avg_amount")).withColumnRenamed(
        "avg_amount", "avg_spend"
    )


@query("agg_star_channel", sql(
    f"""select customer_segment, channel, status, {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend, {avg('amount')} as avg_spend
    from txn join cust using (customer_id) where status = 'approved' group by 1, 2, 3""", "txn", "cust"))
def agg_star_channel(spark, folder):
    approved = transactions(spark, folder).where(F.col("status") == "approved")
    spend = R.per_customer(approved, "channel", "status").join(customers(spark, folder), "customer_id")
    return spend.groupBy("customer_segment", "channel", "status").agg(
        *R.merged("txn_count", "total_spend", "avg_amount")
    ).withColumnRenamed("avg_amount", "avg_spend")


@query("agg_month_segment", sql(
    f"""select customer_segment, month, {d('sum(total_spend)')} as segment_spend, {n('count(distinct customer_id)')} as customer_count
    from monthly join cust using (customer_id) where month >= {AS_OF_SQL} - interval 6 month group by 1, 2""", "monthly", "cust"))
def agg_month_segment(spark, folder):
    # A month start on or after the bound has only rows on or after it, so the bound also filters the scan.
    recent = transactions(spark, folder).where(F.col("transaction_date") >= F.lit(months_before(AS_OF, 6)))
    monthly = monthly_spending(recent).where(F.col("month") >= F.lit(months_before(AS_OF, 6)))
    return monthly.join(customers(spark, folder), "customer_id").groupBy("customer_segment", "month").agg(
        F.sum("total_spend").alias("segment_spend"), F.count("customer_id").alias("customer_count")
    )


@query("agg_monthly_customer", sql(
    f"""select customer_id, customer_segment, card_type, state, city, month, {d('total_spend')} as total_spend, transaction_count,
    avg_transaction_value, first_transaction_date, last_transaction_date from monthly left join cust using (customer_id)""",
    "monthly", "cust"))
def agg_monthly_customer(spark, folder):
    who = customers(spark, folder).select("customer_id", "customer_segment", "card_type", "state", "city")
    return monthly_spending(transactions(spark, folder)).join(who, "customer_id", "left")


@query("agg_monthly_distinct", sql(
    f"""select {month_of('transaction_date')} as month, {n('count(*)')} as txn_count, {avg('amount')} as avg_amount,
    {d('sum(amount)')} as total_spend, {n('count(distinct customer_id)')} as unique_customers from txn group by 1""", "txn"))
def agg_monthly_distinct(spark, folder):
    return R.monthly_totals(transactions(spark, folder))


@query("agg_risk_by_segment", sql(
    f"""select customer_segment, {avg('cast(churn_risk_score as decimal(28,2))')} as avg_risk,
    {n("count(case when churn_risk_category = 'High Risk' then 1 end)")} as high_risk_count, {n('count(*)')} as total_customers
    from profile group by 1""", "profile"))
def agg_risk_by_segment(spark, folder):
    return inputs.profile(spark, folder).groupBy("customer_segment").agg(
        money_mean("churn_risk_score").alias("avg_risk"),
        flag_count(F.col("churn_risk_category") == "High Risk").alias("high_risk_count"),
        F.count(F.lit(1)).alias("total_customers"),
    )


# ---- exploratory profiles ----


@query("agg_eda_account_age", sql(
    f"""select customer_segment, {rnd(f"sum({days('account_open_date', AS_OF_SQL)}) / 365.25::double / count(*)", 1)} as avg_account_age_years,
    min(account_open_date) as oldest_account, max(account_open_date) as newest_account from cust group by 1""", "cust"))
def agg_eda_account_age(spark, folder):
    age = F.sum(days_between("account_open_date", on(AS_OF)))
    return customers(spark, folder).groupBy("customer_segment").agg(
        F.round(age / F.lit(365.25).cast("double") / F.count(F.lit(1)), 1).alias("avg_account_age_years"),
        F.min("account_open_date").alias("oldest_account"), F.max("account_open_date").alias("newest_account"),
    )


PROFILE_KEYS = ("customer_segment", "card_type", "employment_status", "state", "decline_type")


@query("agg_eda_group_profile", sql(
    " union all ".join(
        f"""select '{k}' as attribute, {k} as value, {n('count(*)')} as customer_count,
        {pct('count(*)', 'sum(count(*)) over ()')} as percentage, {avg('credit_limit')} as avg_credit_limit,
        {d('min(credit_limit)')} as min_credit_limit, {d('max(credit_limit)')} as max_credit_limit, {avg('age')} as avg_age
        from cust {"where customer_segment = 'MACHINERY'" if k == 'decline_type' else ''} group by {k}"""
        for k in PROFILE_KEYS), "cust"))
def agg_eda_group_profile(spark, folder):
    # One scan: every customer is turned into one row per attribute, then grouped once.
    values = F.array(*[F.struct(F.lit(k).alias("attribute"), F.col(k).alias("value")) for k in PROFILE_KEYS])
    wanted = (F.col("attribute") != "decline_type") | (F.col("customer_segment") == "MACHINERY")
    long = customers(spark, folder).select("credit_limit", "age", "customer_segment", F.inline(values)).where(wanted)
    counts = long.groupBy("attribute", "value").agg(
        F.count(F.lit(1)).alias("customer_count"), mean("credit_limit").alias("avg_credit_limit"),
        F.min("credit_limit").alias("min_credit_limit"), F.max("credit_limit").alias("max_credit_limit"),
        mean("age").alias("avg_age"),
    )
    return share_of_total(counts, "customer_count", "percentage", ["attribute"])


@query("agg_eda_txn_profile", sql(
    " union all ".join(
        f"""select '{k}' as attribute, {k} as value, {n('count(*)')} as txn_count, {pct('count(*)', 'sum(count(*)) over ()')} as percentage,
        {avg('amount')} as avg_amount, {d('sum(amount)')} as total_amount from fact group by {k}"""
        for k in ("status", "channel", "category_name")), "fact"))
def agg_eda_txn_profile(spark, folder):
    keys = ("status", "channel", "category_name")
    # The three attributes have few combinations: one aggregate over the fact, the rest runs on its result.
    cells = fact(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum"))
    values = F.array(*[F.struct(F.lit(k).alias("attribute"), F.col(k).alias("value")) for k in keys])
    counts = cells.select("_n", "_sum", F.inline(values)).groupBy("attribute", "value").agg(
        F.sum("_n").alias("txn_count"), (F.sum("_sum").cast("double") / F.sum("_n").cast("double")).alias("avg_amount"),
        F.sum("_sum").alias("total_amount"),
    )
    return share_of_total(counts, "txn_count", "percentage", ["attribute"])


@query("agg_eda_date_span", sql(
    f"""select min(transaction_date) as earliest_date, max(transaction_date) as latest_date,
    {months('min(transaction_date)', 'max(transaction_date)')} as months_of_data,
    {days('min(transaction_date)', 'max(transaction_date)')} as days_of_data from txn""", "txn"))
def agg_eda_date_span(spark, folder):
    span = transactions(spark, folder).agg(
        F.min("transaction_date").alias("earliest_date"), F.max("transaction_date").alias("latest_date")
    )
    return span.withColumns({
        "months_of_data": months_between_boundaries("earliest_date", "latest_date"),
        "days_of_data": days_between("earliest_date", "latest_date"),
    })


@query("agg_with_without", sql(
    f"""with g as (select case when exists (select 1 from txn where txn.customer_id = cust.customer_id)
        then 'With Transactions' else 'No Transactions' end as customer_status from cust)
    select customer_status, {n('count(*)')} as customer_count, {pct('count(*)', 'sum(count(*)) over ()')} as percentage from g group by 1""",
    "cust", "txn"))
def agg_with_without(spark, folder):
    return R.with_and_without(customers(spark, folder), transactions(spark, folder))


@query("agg_share_partitioned", sql(
    f"""with g as (select year(transaction_date) as snapshot, customer_segment, sum(amount) as spend from txn join cust using (customer_id) group by 1, 2)
    select snapshot, customer_segment, {d('spend')} as total_spend,
    {pct('spend', 'sum(spend) over (partition by snapshot)')} as pct_of_total_spend from g""", "txn", "cust"))
def agg_share_partitioned(spark, folder):
    yearly = R.per_customer(transactions(spark, folder).withColumn("snapshot", F.year("transaction_date")), "snapshot")
    spend = yearly.join(customers(spark, folder), "customer_id").groupBy("snapshot", "customer_segment").agg(*R.merged("total_spend"))
    return share_of_total(spend, "total_spend", "pct_of_total_spend", ["snapshot"])


@query("agg_value_share", sql(
    f"""with g as (select customer_segment, count(*) as c, sum(cast(lifetime_value as decimal(28,2))) as v, {stable('avg_monthly_spend')} as m from seg group by 1)
    select customer_segment, {n('c')} as customer_count, {pct('c', 'sum(c) over ()')} as percentage,
    cast(v as double) / c as avg_lifetime_value, m as avg_monthly_spend, {d('v')} as total_segment_value,
    {pct('v', 'sum(v) over ()')} as value_percentage from g""", "seg"))
def agg_value_share(spark, folder):
    value = F.col("lifetime_value").cast("decimal(28,2)")
    g = inputs.segments(spark, folder).groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), mean(value).alias("avg_lifetime_value"),
        stable_mean("avg_monthly_spend").alias("avg_monthly_spend"), F.sum(value).alias("total_segment_value"),
    )
    return share_of_total(share_of_total(g, "customer_count", "percentage"), "total_segment_value", "value_percentage")


@query("agg_quartiles", sql(
    f"""select customer_segment, {d('min(amount)')} as min_value, {d('max(amount)')} as max_value, {avg('amount')} as avg_value,
    {rnd('quantile_cont(cast(amount as double), 0.25)')} as q1, {rnd('quantile_cont(cast(amount as double), 0.5)')} as median,
    {rnd('quantile_cont(cast(amount as double), 0.75)')} as q3 from txn join cust using (customer_id) group by 1""", "txn", "cust"))
def agg_quartiles(spark, folder):
    who = customers(spark, folder).select("customer_id", "customer_segment")
    # Amounts are counted per customer before the join, so that a busy customer is no hot key of it.
    counts = transactions(spark, folder).groupBy("customer_id", "amount").agg(F.count(F.lit(1)).alias("n"))
    return R.five_numbers(counts.join(who, "customer_id"), ["customer_segment"], "amount", "n")


@query("agg_distinct", sql(
    f"""select customer_segment, {n('count(distinct cust.customer_id)')} as total_customers, {n('count(distinct txn.customer_id)')} as customers_with_transactions,
    {n('count(transaction_id)')} as txn_count, {d('min(amount)')} as min_amount, {avg('amount')} as avg_amount, {d('max(amount)')} as max_amount,
    {d('sum(amount)')} as total_spend,
    {rnd('cast(count(transaction_id) as double) / nullif(count(distinct cust.customer_id), 0)')} as avg_txns_per_customer,
    cast(sum(amount) as double) / nullif(cast(count(distinct cust.customer_id) as double), 0) as spend_per_customer
    from cust left join txn on cust.customer_id = txn.customer_id group by 1""", "cust", "txn"))
def agg_distinct(spark, folder):
    return R.segment_activity(customers(spark, folder), transactions(spark, folder))


@query("agg_distinct_conditional", sql(
    f"""select channel, {n('count(distinct customer_id)')} as customers,
    {n("count(distinct case when status = 'approved' then customer_id end)")} as approved_customers,
    {n("count(distinct case when amount > 400000 then customer_id end)")} as large_customers from txn group by 1""", "txn"))
def agg_distinct_conditional(spark, folder):
    # One row per channel and customer carries the conditions, so a single distinct key is shuffled.
    flags = transactions(spark, folder).groupBy("channel", "customer_id").agg(
        F.max(F.col("status") == "approved").alias("approved"), F.max(F.col("amount") > 400000).alias("large")
    )
    return flags.groupBy("channel").agg(
        F.count(F.lit(1)).alias("customers"), flag_count(F.col("approved")).alias("approved_customers"),
        flag_count(F.col("large")).alias("large_customers"),
    )


@query("agg_count_if", sql(
    f"""select unnest(['null_customer_id', 'null_email', 'age_out_of_range', 'null_credit_limit', 'credit_limit_not_positive', 'duplicate_customer_id']) as check_name,
    unnest([{n('count(*) filter (customer_id is null)')}, {n('count(*) filter (email is null)')}, {n('count(*) filter (age < 18 or age > 100)')},
    {n('count(*) filter (credit_limit is null)')}, {n('count(*) filter (credit_limit <= 0)')}, {n('count(*) - count(distinct customer_id)')}]) as issue_count from cust""",
    "cust"))
def agg_count_if(spark, folder):
    checks = {
        "null_customer_id": flag_count(F.col("customer_id").isNull()),
        "null_email": flag_count(F.col("email").isNull()),
        "age_out_of_range": flag_count((F.col("age") < 18) | (F.col("age") > 100)),
        "null_credit_limit": flag_count(F.col("credit_limit").isNull()),
        "credit_limit_not_positive": flag_count(F.col("credit_limit") <= 0),
        "duplicate_customer_id": F.count(F.lit(1)) - F.count_distinct("customer_id"),
    }
    return customers(spark, folder).agg(*[c.alias(k) for k, c in checks.items()]).unpivot(
        [], list(checks), "check_name", "issue_count"
    )


@query("agg_having", sql(
    f"""select customer_id, {n(f"count(distinct {month_of('transaction_date')})")} as active_months from txn
    where status = 'approved' group by 1 having count(distinct {month_of('transaction_date')}) >= 6""", "txn"))
def agg_having(spark, folder):
    months_seen = transactions(spark, folder).where(F.col("status") == "approved").select(
        "customer_id", F.trunc("transaction_date", "month").alias("month")
    ).distinct()
    return months_seen.groupBy("customer_id").agg(F.count(F.lit(1)).alias("active_months")).where(F.col("active_months") >= 6)


TWO_LEVEL = f"""with g as (select cust.customer_id, decline_type, {month_of('transaction_date')} as month, sum(amount) as s, count(*) as c
    from txn join cust using (customer_id) where customer_segment = 'MACHINERY' group by 1, 2, 3)
    select decline_type, month, {avg('s')} as avg_monthly_spend, {avg('c')} as avg_monthly_txns, {n('count(distinct customer_id)')} as customers
    from g group by 1, 2"""


@query("agg_two_level", sql(TWO_LEVEL, "txn", "cust"))
def agg_two_level(spark, folder):
    declining = customers(spark, folder).where(F.col("customer_segment") == "MACHINERY").select("customer_id", "decline_type")
    month = transactions(spark, folder).withColumn("month", F.trunc("transaction_date", "month"))
    monthly = R.per_customer(month, "month").join(declining, "customer_id")
    return monthly.groupBy("decline_type", "month").agg(
        mean("_sum").alias("avg_monthly_spend"), mean("_n").alias("avg_monthly_txns"), F.count(F.lit(1)).alias("customers")
    )


@query("agg_distribution", sql(
    f"""with g as (select customer_id, count(*) as c from txn group by 1) select {n('min(c)')} as min_txns_per_customer,
    {n('max(c)')} as max_txns_per_customer, {avg('c')} as avg_txns_per_customer, round(stddev_samp(c), 4) as stddev_txns from g""", "txn"))
def agg_distribution(spark, folder):
    counts = transactions(spark, folder).groupBy("customer_id").agg(F.count(F.lit(1)).alias("c"))
    return counts.agg(
        F.min("c").alias("min_txns_per_customer"), F.max("c").alias("max_txns_per_customer"),
        mean("c").alias("avg_txns_per_customer"), F.round(F.stddev_samp("c"), 4).alias("stddev_txns"),
    )


@query("agg_usage_percentiles", sql(
    f"""select event_type, {n('count(*)')} as count_queries, {rnd('quantile_cont(value, 0.5)', 4)} as median_elapsed,
    {rnd('quantile_cont(value, 0.9)', 4)} as p90_elapsed, {rnd('quantile_cont(cast(length(props) as double), 0.5)', 4)} as median_volume,
    {avg('length(props)')} as avg_volume from events group by 1"""))
def agg_usage_percentiles(spark, folder):
    log = table(spark, folder, "events").withColumn("volume", F.length("props"))
    stats = R.usage_statistics(log, ["event_type"], "value", "volume")
    return stats.withColumns({c: F.round(c, 4) for c in ("median_elapsed", "p90_elapsed", "median_volume")})


def _bytes(b: str) -> str:
    return f"case when {b} > 1048576 then ({b} // 1048576)::varchar || 'MB' when {b} > 1024 then ({b} // 1024)::varchar || 'KB' else {b}::varchar end"


def _millis(ms: str) -> str:
    s = f"({ms} // 1000)"
    return (f"case when {s} >= 3600 then ({s} // 3600) || 'h ' || ({s} % 3600 // 60) || 'm ' || ({s} % 60) || 's' when {s} >= 60 then ({s} // 60) || 'm ' || ({s} % 60) || 's' "
            f"when {s} > 0 then {s} || 's' else {ms} || 'ms' end")


@query("agg_usage_report", f"""with g as (select event_type, cast(date_trunc('month', ts) as date) as month, count(*)::bigint as count_queries, floor(quantile_cont(floor(value * 1000), 0.5))::bigint as m, floor(quantile_cont(floor(value * 1000), 0.9))::bigint as p,
        floor(quantile_cont(cast(length(props) * 100 as double), 0.5))::bigint as v, floor(avg(length(props) * 100))::bigint as a from events group by 1, 2)
    select event_type, month, count_queries, {_millis('m')} as median_elapsed, {_millis('p')} as p90_elapsed, {_bytes('v')} as median_volume, {_bytes('a')} as avg_volume from g""")
def agg_usage_report(spark, folder):
    """Usage by two keys with times and sizes as text."""
    log = table(spark, folder, "events").select(
        "event_type", F.trunc("ts", "month").alias("month"), F.floor(F.col("value") * 1000).alias("elapsed"), (F.length("props") * 100).alias("volume")
    )
    return R.formatted_usage(log, ["event_type", "month"], "elapsed", "volume")


@query("agg_size_totals", f"""with g as (select lang, source, count(*)::bigint as n_files, floor(avg(n_chars))::bigint as avg_file_size_bytes, sum(n_chars)::bigint as total_file_size_bytes from documents where n_chars > 1000 group by 1, 2)
    select *, {_bytes('avg_file_size_bytes')} as avg_file_size, {_bytes('total_file_size_bytes')} as total_file_size from g""")
def agg_size_totals(spark, folder):
    """The large texts of each language and source, as a file report by table."""
    return R.size_totals(table(spark, folder, "documents"), ["lang", "source"], "n_chars", over=1000)


@query("agg_size_buckets", sql(
    f"""select {avg('case when n_chars <= 1000 then n_chars end')} as avg_small, {n('count(case when n_chars <= 1000 then 1 end)')} as count_small,
    {avg('case when n_chars between 1000 and 5000 then n_chars end')} as avg_middle, {n('count(case when n_chars between 1000 and 5000 then 1 end)')} as count_middle,
    {avg('case when n_chars > 5000 then n_chars end')} as avg_large, {n('count(case when n_chars > 5000 then 1 end)')} as count_large from documents"""))
def agg_size_buckets(spark, folder):
    return R.size_bands(table(spark, folder, "documents"), "n_chars", 1000, 5000)


@query("agg_listagg", sql("select r_name, string_agg(n_name, ', ' order by n_name) as nations from nation join region on n_regionkey = r_regionkey group by 1"))
def agg_listagg(spark, folder):
    # Names of a dimension: the list per region is as long as the region has nations.
    joined = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.expr("listagg(n_name, ', ') within group (order by n_name)").alias("nations"))


@query("agg_daily", sql(f"select transaction_date, {d('sum(amount)')} as amount from txn group by 1", "txn"))
def agg_daily(spark, folder):
    return transactions(spark, folder).groupBy("transaction_date").agg(F.sum("amount").alias("amount"))


@query("agg_category_history", sql(
    f"select customer_id, category_name, {d('sum(amount)')} as amount from fact group by 1, 2", "fact"))
def agg_category_history(spark, folder):
    return fact(spark, folder).groupBy("customer_id", "category_name").agg(F.sum("amount").alias("amount"))


@query("agg_explorer_kpis", sql(
    f"""select 'all' as kind, 'all' as label, {n('count(*)')} as customers, {d('sum(cast(lifetime_value as decimal(28,2)))')} as total_ltv,
        {avg('cast(lifetime_value as decimal(28,2))')} as avg_ltv, {avg('cast(churn_risk_score as decimal(28,2))')} as avg_risk from profile
    union all select 'segment', customer_segment, {n('count(*)')}, {d('sum(cast(lifetime_value as decimal(28,2)))')},
        {avg('cast(lifetime_value as decimal(28,2))')}, {avg('cast(churn_risk_score as decimal(28,2))')} from profile group by 2
    union all select 'risk', churn_risk_category, {n('count(*)')}, {d('sum(cast(lifetime_value as decimal(28,2)))')},
        {avg('cast(lifetime_value as decimal(28,2))')}, {avg('cast(churn_risk_score as decimal(28,2))')} from profile group by 2""", "profile"))
def agg_explorer_kpis(spark, folder):
    labels = F.array(
        F.struct(F.lit("all").alias("kind"), F.lit("all").alias("label")),
        F.struct(F.lit("segment").alias("kind"), F.col("customer_segment").alias("label")),
        F.struct(F.lit("risk").alias("kind"), F.col("churn_risk_category").alias("label")),
    )
    long = inputs.profile(spark, folder).select(
        F.col("lifetime_value").cast("decimal(28,2)").alias("ltv"), "churn_risk_score", F.inline(labels)
    )
    return long.groupBy("kind", "label").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("ltv").alias("total_ltv"), mean("ltv").alias("avg_ltv"),
        money_mean("churn_risk_score").alias("avg_risk"),
    )


# ---- statements of the reference's time limits ----


@query("perf_count", sql(f"select {n('count(*)')} as txn_count from lineitem"))
def perf_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("txn_count"))


@query("perf_one_customer", sql(
    f"""select {n('count(*)')} as txn_count, {avg('amount')} as avg_amount, min(transaction_date) as first_txn, max(transaction_date) as last_txn
    from txn where customer_id = 77""", "txn"))
def perf_one_customer(spark, folder):
    return transactions(spark, folder).where(F.col("customer_id") == 77).agg(
        F.count(F.lit(1)).alias("txn_count"), mean("amount").alias("avg_amount"),
        F.min("transaction_date").alias("first_txn"), F.max("transaction_date").alias("last_txn"),
    )


@query("perf_three_months", sql(
    f"""select {n('count(*)')} as txn_count, {d('sum(amount)')} as total_amount from txn
    where transaction_date >= {AS_OF_SQL} - interval 3 month and transaction_date < {AS_OF_SQL}""", "txn"))
def perf_three_months(spark, folder):
    day = F.col("transaction_date")
    recent = transactions(spark, folder).where((day >= F.lit(months_before(AS_OF, 3))) & (day < F.lit(AS_OF)))
    return recent.agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"))


@query("perf_segment_join", sql(
    f"select customer_segment, {n('count(*)')} as txn_count, {avg('amount')} as avg_amount from txn join cust using (customer_id) group by 1",
    "txn", "cust"))
def perf_segment_join(spark, folder):
    spend = R.per_customer(transactions(spark, folder))
    return spend.join(customers(spark, folder), "customer_id").groupBy("customer_segment").agg(*R.merged("txn_count", "avg_amount"))
