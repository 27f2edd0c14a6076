"""Dimension history, change capture, policies and the metric layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clientele.functions.dates import at_time
from clientele.functions.columns import MONEY
from clientele.operators import cdc, policy, scd, semantic, star
from clientele.operators.customer import monthly_spending
from clientele.plans import inputs
from clientele.plans.catalog import query
from clientele.plans.oracle import AS_OF as AS_OF_SQL
from clientele.plans.oracle import CHANGES_FROM as CUT_SQL
from clientele.plans.oracle import EVENTS_AS_OF as EVENTS_SQL
from clientele.plans.oracle import avg, d, days, n, sql, stable
from clientele.sources.roles import (
    AS_OF, CHANGES_FROM, EVENTS_AS_OF, category, changes, customers, fact, table, transactions,
)

# ---- dimension history ----

DIM_COLUMNS = ("customer_id", "email", "card_type", "credit_limit", "account_open_date", "decline_type")
TRACKING = scd.Tracking("customer_id", tracked=("card_type", "credit_limit"), overwritten=("email", "decline_type"), blank_aware=("decline_type",))


def _history(spark, folder):
    dim = star.initial_dimension(customers(spark, folder).select(*DIM_COLUMNS))
    return dim.withColumn("updated_on", F.col("account_open_date"))


def _snapshot(spark, folder):
    """A later snapshot: richer customers get the Premium card, builders a higher limit, some mails and decline types
    change, furniture customers are absent, and suppliers appear as new customers."""
    who = customers(spark, folder)
    segment = F.col("customer_segment")
    known = who.where(segment != "FURNITURE").select(
        "customer_id",
        F.when(segment == "HOUSEHOLD", F.upper("email")).otherwise(F.col("email")).alias("email"),
        F.when(F.col("credit_limit") >= 4000, "Premium").otherwise(F.col("card_type")).alias("card_type"),
        F.when(segment == "BUILDING", F.col("credit_limit") + 500).otherwise(F.col("credit_limit")).cast(MONEY).alias("credit_limit"),
        "account_open_date",
        F.when(F.col("decline_type") == "sudden", None).otherwise(F.col("decline_type")).alias("decline_type"),
    )
    fresh = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 10_000_000_000).alias("customer_id"),
        F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@supplier.example.com")).alias("email"),
        F.lit("Standard").alias("card_type"), F.col("s_acctbal").cast(MONEY).alias("credit_limit"),
        F.lit(AS_OF).alias("account_open_date"), F.lit(None).cast("string").alias("decline_type"),
    )
    return known.unionByName(fresh)


SCD_SQL = f"""hist as (select md5(customer_id || '-' || account_open_date) as customer_key, customer_id, email, card_type, credit_limit, account_open_date, decline_type,
        account_open_date as valid_from, cast(null as date) as valid_to, true as is_current, account_open_date as updated_on from cust),
    snap as (select customer_id, case when customer_segment = 'HOUSEHOLD' then upper(email) else email end as email, case when credit_limit >= 4000 then 'Premium' else card_type end as card_type,
        cast(case when customer_segment = 'BUILDING' then credit_limit + 500 else credit_limit end as decimal(18,2)) as credit_limit, account_open_date, case when decline_type = 'sudden' then null else decline_type end as decline_type
        from cust where customer_segment != 'FURNITURE'
        union all select s_suppkey + 10000000000, lower(replace(s_name, '#', '.')) || '@supplier.example.com', 'Standard', cast(s_acctbal as decimal(18,2)), {AS_OF_SQL}, null from supplier),
    det as (select s.customer_id, case when h.customer_id is null then 'NEW' when s.card_type != h.card_type or s.credit_limit != h.credit_limit then 'CHANGED' else 'NO_CHANGE' end as change_type,
        h.card_type as old_card_type, s.card_type as new_card_type, h.credit_limit as old_credit_limit, s.credit_limit as new_credit_limit from snap s left join hist h on s.customer_id = h.customer_id),
    expired as (select 'expired' as _part, h.* replace ({AS_OF_SQL} - 1 as valid_to, false as is_current, {AS_OF_SQL} as updated_on) from hist h join det on h.customer_id = det.customer_id and change_type = 'CHANGED'),
    inserted as (select 'inserted' as _part, md5(s.customer_id || '-' || {AS_OF_SQL}) as customer_key, s.customer_id, email, card_type, credit_limit, account_open_date, decline_type, {AS_OF_SQL} as valid_from, cast(null as date) as valid_to,
        true as is_current, {AS_OF_SQL} as updated_on from snap s join det on s.customer_id = det.customer_id and change_type in ('NEW', 'CHANGED')),
    updated as (select 'updated' as _part, h.* replace (s.email as email, s.decline_type as decline_type, {AS_OF_SQL} as updated_on) from hist h join snap s on h.customer_id = s.customer_id join det on h.customer_id = det.customer_id and change_type = 'NO_CHANGE'
        where s.email != h.email or coalesce(s.decline_type, '') != coalesce(h.decline_type, '')),
    kept as (select 'kept' as _part, * from hist where customer_id not in (select customer_id from expired) and customer_id not in (select customer_id from updated)),
    merged as (select * from expired union all by name select * from inserted union all by name select * from updated union all by name select * from kept)"""


@query("scd_initial", sql(f"with {SCD_SQL} select * replace ({d('credit_limit')} as credit_limit) from hist", "cust"))
def scd_initial(spark, folder):
    return _history(spark, folder)


@query("scd_detect", sql(f"with {SCD_SQL} select * replace ({d('old_credit_limit')} as old_credit_limit, {d('new_credit_limit')} as new_credit_limit) from det", "cust"))
def scd_detect(spark, folder):
    return scd.detect(_history(spark, folder), _snapshot(spark, folder), TRACKING)


@query("scd_expire_insert", sql(
    f"with {SCD_SQL} select * replace ({d('credit_limit')} as credit_limit) from (select * from expired union all by name select * from inserted)", "cust"))
def scd_expire_insert(spark, folder):
    return scd.changes(_history(spark, folder), _snapshot(spark, folder), TRACKING, AS_OF, kinds=(scd.NEW, scd.CHANGED))


@query("scd_type1", sql(f"with {SCD_SQL} select * replace ({d('credit_limit')} as credit_limit) from updated", "cust"))
def scd_type1(spark, folder):
    same = scd.changes(_history(spark, folder), _snapshot(spark, folder), TRACKING, AS_OF, kinds=(scd.SAME,))
    return same.where(F.col("_part") == "updated")


@query("scd_merge", sql(f"with {SCD_SQL} select * exclude (_part) replace ({d('credit_limit')} as credit_limit) from merged", "cust"))
def scd_merge(spark, folder):
    return scd.scd2_merge(_history(spark, folder), _snapshot(spark, folder), TRACKING, AS_OF)


@query("ca_upgrade", sql(
    f"""with {SCD_SQL} select customer_id, card_type, valid_from as upgrade_date, {days('account_open_date', 'valid_from')} as days_to_upgrade from merged
    where card_type = 'Premium' and valid_from > account_open_date order by upgrade_date desc, customer_id limit 100""", "cust"))
def ca_upgrade(spark, folder):
    dim = scd.scd2_merge(_history(spark, folder), _snapshot(spark, folder), TRACKING, AS_OF)
    return star.upgrades(dim).orderBy(F.desc("upgrade_date"), "customer_id").limit(100)


# ---- change capture ----

ATTRIBUTES = ("label", "amount")
EVENTS_END = dt.datetime.combine(EVENTS_AS_OF, dt.time())


def _split(spark, folder):
    rows = changes(spark, folder)
    cut = at_time(CHANGES_FROM)
    old = rows.where((F.col("update_timestamp") < cut) & (F.col("action") == "INSERT")).select(
        "id", *ATTRIBUTES, F.col("update_timestamp").alias("start_time")
    )
    return cdc.intervals(old, "id", "start_time"), rows.where(F.col("update_timestamp") >= cut)


def _lead(over: str) -> str:
    return f"lead(start_time) over (partition by id order by start_time) as nxt from {over}"


CDC_SQL = f"""h0 as (select id, label, amount, update_timestamp as start_time from chg where update_timestamp < {CUT_SQL} and action = 'INSERT'),
    hist as (select id, label, amount, start_time, coalesce(nxt, timestamp '9999-12-31') as end_time, case when nxt is null then 1 else 0 end::bigint as current_flag from (select *, {_lead('h0')})),
    batch as (select * from chg where update_timestamp >= {CUT_SQL}),
    fresh as (select id, label, amount, start_time, coalesce(nxt, timestamp '9999-12-31') as end_time, case when nxt is null then 1 else 0 end::bigint as current_flag, 'I' as dml_type
        from (select *, {_lead("(select id, label, amount, update_timestamp as start_time from batch where action = 'INSERT' and not is_update)")})),
    u0 as (select id, label, amount, update_timestamp as start_time, 'I' as dml_type from batch where action = 'INSERT' and is_update
        union select id, null, null, start_time, 'U' from hist where current_flag = 1 and id in (select id from batch where action = 'INSERT' and is_update)),
    upd as (select id, label, amount, start_time, coalesce(nxt, timestamp '9999-12-31') as end_time, case when nxt is null then 1 else 0 end::bigint as current_flag, dml_type from (select *, {_lead('u0')})),
    del as (select hist.id, null, null, hist.start_time, cast({EVENTS_SQL} as timestamp) as end_time, null::bigint as current_flag, 'D' as dml_type from hist join batch on hist.id = batch.id where batch.action = 'DELETE' and current_flag = 1),
    cls as (select * from fresh union select * from upd union select * from del),
    closed as (select id, start_time, min(end_time) as close_at from cls where dml_type in ('U', 'D') group by 1, 2),
    merged as (select hist.id, label, amount, hist.start_time, coalesce(close_at, end_time) as end_time, case when close_at is not null then 0 else current_flag end as current_flag
        from hist left join closed on hist.id = closed.id and hist.start_time = closed.start_time
        union all select id, label, amount, start_time, end_time, current_flag from cls where dml_type = 'I' and not exists (select 1 from hist where hist.id = cls.id and hist.start_time = cls.start_time))"""


@query("cdc_classify", sql(f"with {CDC_SQL} select * replace ({d('amount')} as amount) from cls", "chg"))
def cdc_classify(spark, folder):
    history, batch = _split(spark, folder)
    return cdc.classify(batch, history, ATTRIBUTES, EVENTS_END)


@query("cdc_merge_history", sql(f"with {CDC_SQL} select * replace ({d('amount')} as amount, {n('current_flag')} as current_flag) from merged", "chg"))
def cdc_merge_history(spark, folder):
    history, batch = _split(spark, folder)
    return cdc.apply_changes(batch, history, ATTRIBUTES, EVENTS_END)


def fact_changes(spark, folder):
    """Change batch for the order feed, from the lines: returned lines delete their order, lines with a large quantity
    bring new ids, the others update amount and status."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") + F.when(F.col("l_quantity") > 40, 1_000_000_000_000).otherwise(0)).alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.lit("line").alias("status"),
        F.when(F.col("l_returnflag") == "R", "DELETE").otherwise("INSERT").alias("action"),
        F.col("l_shipdate").alias("changed_at"),
    )


CHANGE_ORDER = ("changed_at", "amount", "action")
FACT_SQL = f"""b0 as (select l_orderkey + case when l_quantity > 40 then 1000000000000 else 0 end as transaction_id, cast(l_shipdate as date) as transaction_date, cast(l_extendedprice as decimal(18,2)) as amount, 'line' as status,
        case when l_returnflag = 'R' then 'DELETE' else 'INSERT' end as action, l_shipdate as changed_at from lineitem),
    b as (select * exclude (rn) from (select *, row_number() over (partition by transaction_id order by changed_at desc, amount desc, action desc) as rn from b0) where rn = 1),
    applied as (select coalesce(txn.transaction_id, b.transaction_id) as transaction_id, customer_id, coalesce(b.transaction_date, txn.transaction_date) as transaction_date, {d('coalesce(b.amount, txn.amount)')} as amount, channel,
        coalesce(b.status, txn.status) as status from txn full join b on txn.transaction_id = b.transaction_id where b.action is distinct from 'DELETE')"""


def order_target(spark, folder):
    return transactions(spark, folder).drop("ingestion_timestamp")


@query("cdc_apply_fact", sql(f"with {FACT_SQL} select * from applied", "txn"))
def cdc_apply_fact(spark, folder):
    return cdc.upsert(
        order_target(spark, folder), fact_changes(spark, folder), ["transaction_id"], CHANGE_ORDER,
        updated=["amount", "transaction_date", "status"], action="action",
    )


@query("inc_upsert_key", sql(
    """select coalesce(b.transaction_id, t.transaction_id) as transaction_id, cast(coalesce(b.amount, t.amount) as double) as amount, coalesce(b.status, t.status) as status
    from (select * from txn where transaction_date < date '2000-01-01') t full join (select transaction_id, amount + 1 as amount, 'batch' as status from txn where transaction_date >= date '1999-06-01') b on t.transaction_id = b.transaction_id""", "txn"))
def inc_upsert_key(spark, folder):
    txn, day = transactions(spark, folder), F.col("transaction_date")
    target = txn.where(day < F.lit(dt.date(2000, 1, 1))).select("transaction_id", "amount", "status")
    batch = txn.where(day >= F.lit(dt.date(1999, 6, 1))).select(
        "transaction_id", (F.col("amount") + 1).alias("amount"), F.lit("batch").alias("status"), "ingestion_timestamp"
    )
    return cdc.upsert(target, batch, ["transaction_id"], ["ingestion_timestamp"])


@query("cdc_summary", sql(
    f"select {n('count(*)')} as total_changes, {n("sum(case when action = 'INSERT' then 1 else 0 end)")} as inserts, {n("sum(case when action = 'DELETE' then 1 else 0 end)")} as deletes from chg", "chg"))
def cdc_summary(spark, folder):
    return cdc.summary(changes(spark, folder))


# ---- policies ----


@query("pol_mask", sql("select customer_id, email as clear, regexp_replace(email, '.+@', '*****@') as partly, '*** MASKED ***' as hidden from cust", "cust"))
def pol_mask(spark, folder):
    return customers(spark, folder).select(
        "customer_id", policy.mask("email", [policy.HIGH]).alias("clear"), policy.mask("email", [policy.CONFIDENTIAL]).alias("partly"),
        policy.mask("email", []).alias("hidden"),
    )


@query("pol_mask_tag", sql(
    "select customer_id, regexp_replace(email, '.+@', '*****@') as email, first_name, last_name, state from cust", "cust"))
def pol_mask_tag(spark, folder):
    tagged = policy.tag_columns(
        customers(spark, folder).select("customer_id", "email", "first_name", "last_name", "state"),
        {"email": policy.HIGH, "first_name": policy.CONFIDENTIAL, "last_name": policy.CONFIDENTIAL},
    )
    return policy.mask_by_tag(tagged, [policy.CONFIDENTIAL])


def _mappings(spark, folder):
    """Role mappings: a regional role sees the states of its region; each role sees some segments."""
    states = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("role"), F.col("n_name").alias("state")
    )
    kinds = spark.createDataFrame(
        [("ASIA", "BUILDING"), ("ASIA", "MACHINERY"), ("EUROPE", "BUILDING"), ("EUROPE", "HOUSEHOLD")], "role string, kind string"
    )
    return states, kinds


@query("pol_rows", sql(
    """select customer_id, state, customer_segment, 'state' as policy from cust where state in (select n_name from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA')
    union all select customer_id, state, customer_segment, 'state and kind' from cust where state in (select n_name from nation join region on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE'))
        and customer_segment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""", "cust"))
def pol_rows(spark, folder):
    states, kinds = _mappings(spark, folder)
    who = customers(spark, folder).select("customer_id", "state", "customer_segment")
    by_state = policy.row_policy(who, [(states, "state", "state")], ["ASIA"])
    both = policy.row_policy(who, [(states, "state", "state"), (kinds, "kind", "customer_segment")], ["ASIA", "EUROPE"])
    return by_state.withColumn("policy", F.lit("state")).unionByName(both.withColumn("policy", F.lit("state and kind")))


@query("jn_semi_policy", sql(
    "select customer_id, state from cust where exists (select 1 from nation join region on n_regionkey = r_regionkey where r_name in ('AFRICA', 'AMERICA') and n_name = cust.state)", "cust"))
def jn_semi_policy(spark, folder):
    states, _ = _mappings(spark, folder)
    return policy.row_policy(customers(spark, folder).select("customer_id", "state"), [(states, "state", "state")], ["AFRICA", "AMERICA"])


TAX_SQL = "select customer_id, upper(left(c_mktsegment, 2)) || lpad(cast(customer_id % 1000000 as varchar), 6, '0') || 'A' as ni_number, c_mktsegment as segment, case when c_acctbal < 0 then upper(left(c_mktsegment, 2)) || '000000B' else c_name end as note from (select *, c_custkey as customer_id from customer)"


@query("pol_classify", f"""with t as ({TAX_SQL}), l as (select unnest(['ni_number', 'segment', 'note']) as column_name,
        unnest([count(ni_number), count(segment), count(note)]) as n_values, unnest([count(*) filter (regexp_matches(ni_number, '^[A-Z]{{2}}\\d{{6}}[A-Z]$')), 0, count(*) filter (regexp_matches(note, '^[A-Z]{{2}}\\d{{6}}[A-Z]$'))]) as n_matches from t)
    select column_name, {n('n_values')} as n_values, {n('n_matches')} as n_matches, cast(n_matches as double) / n_values as match_rate, column_name = 'ni_number' as name_match, case when column_name = 'ni_number' then 'UK_TAX_IDENTIFIER' end as category from l""")
def pol_classify(spark, folder):
    prefix = F.upper(F.left("c_mktsegment", F.lit(2)))
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(prefix, F.lpad((F.col("c_custkey") % 1000000).cast("string"), 6, "0"), F.lit("A")).alias("ni_number"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") < 0, F.concat(prefix, F.lit("000000B"))).otherwise(F.col("c_name")).alias("note"),
    )
    return policy.classify_columns(rows, policy.UK_TAX_ID, "NI.*", "UK_TAX_IDENTIFIER")


# ---- metric layer ----


@query("sem_metric", sql(
    f"""select customer_segment, churn_risk_category, round(sum(lifetime_value), 2) as lifetime_value, {n('sum(total_transactions)')} as total_transactions, {stable('credit_limit')} as credit_limit,
    {stable('churn_risk_score')} as churn_risk_score, {n('count(customer_id)')} as customer_count from profile group by 1, 2""", "profile"))
def sem_metric(spark, folder):
    got = semantic.metric(
        {"customer_profile": inputs.profile(spark, folder)}, "customer_profile",
        ["lifetime_value", "total_transactions", "credit_limit", "churn_risk_score", "customer_count"], ["customer_segment", "churn_risk_category"],
    )
    return got.withColumn("lifetime_value", F.round("lifetime_value", 2))


@query("sem_join", sql(
    f"""select channel, card_type as customer_profile_card_type, category_group as merchant_categories_category_group, {d('sum(amount)')} as transaction_amount, {n('count(transaction_id)')} as transaction_count
    from fact left join cust using (customer_id) left join cat using (category_name) group by 1, 2, 3""", "fact", "cust", "cat"))
def sem_join(spark, folder):
    categories = star.dim_category(table(spark, folder, "part").select(category().alias("c")), "c")
    tables = {"transactions": fact(spark, folder), "customer_profile": customers(spark, folder), "merchant_categories": categories}
    return semantic.metric(
        tables, "transactions", ["transaction_amount", "transaction_count"],
        ["channel", "customer_profile.card_type", "merchant_categories.category_group"],
    )


@query("sem_monthly", sql(
    f"""select month, card_type as customer_profile_card_type, {d('sum(total_spend)')} as total_spend, {n('sum(transaction_count)')} as transaction_count, {stable('avg_transaction_value')} as avg_transaction_value,
    {n('count(distinct customer_id)')} as customer_count from monthly left join cust using (customer_id) group by 1, 2""", "monthly", "cust"))
def sem_monthly(spark, folder):
    tables = {"monthly_spending": monthly_spending(transactions(spark, folder)), "customer_profile": customers(spark, folder)}
    return semantic.metric(
        tables, "monthly_spending", ["total_spend", "transaction_count", "avg_transaction_value", "customer_count"],
        ["month", "customer_profile.card_type"],
    )


@query("sem_verified", sql(
    f"""select 'customers in each segment' as question, customer_segment as label, {d('count(*)')} as answer from profile group by 2
    union all select 'average lifetime value by segment', customer_segment, {avg('cast(lifetime_value as decimal(28,2))')} from profile group by 2
    union all select 'total spending in the last 90 days', 'all', {d('sum(cast(spend_last_90_days as decimal(28,2)))')} from profile
    union all select 'premium customers at medium or high risk', churn_risk_category, {d('count(*)')} from profile where card_type = 'Premium' and churn_risk_category in ('Medium Risk', 'High Risk') group by 2""", "profile"))
def sem_verified(spark, folder):
    """The canned questions, answered from one pass over the profile."""
    money = F.col("lifetime_value").cast("decimal(28,2)")
    cells = inputs.profile(spark, folder).groupBy("customer_segment", "card_type", "churn_risk_category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money).alias("ltv"), F.sum(F.col("spend_last_90_days").cast("decimal(28,2)")).alias("recent")
    )
    risky = (F.col("card_type") == "Premium") & F.col("churn_risk_category").isin("Medium Risk", "High Risk")
    asked = F.array(
        F.struct(F.lit("customers in each segment").alias("question"), F.col("customer_segment").alias("label")),
        F.struct(F.lit("average lifetime value by segment").alias("question"), F.col("customer_segment").alias("label")),
        F.struct(F.lit("total spending in the last 90 days").alias("question"), F.lit("all").alias("label")),
        F.when(risky, F.struct(F.lit("premium customers at medium or high risk").alias("question"), F.col("churn_risk_category").alias("label"))),
    )
    long = cells.select("n", "ltv", "recent", F.inline(F.filter(asked, lambda a: a.isNotNull())))
    n_, ltv, recent = F.sum("n").cast("double"), F.sum("ltv").cast("double"), F.sum("recent").cast("double")
    answer = F.when(F.col("question").startswith("average"), ltv / n_).when(F.col("question").startswith("total"), recent).otherwise(n_)
    return long.groupBy("question", "label").agg(answer.alias("answer"))
