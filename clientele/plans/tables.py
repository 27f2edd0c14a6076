"""Projections, filters, joins, windows, set operations, reshaping and column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from clientele.functions import columns as K
from clientele.functions import text as X
from clientele.functions.dates import at_time, days_before, months_between_boundaries, on
from clientele.operators import campaign, clean, reshape, setops, star
from clientele.operators import windows as W
from clientele.operators.customer import monthly_spending
from clientele.operators.dedupe import deduplicate, latest_per_key
from clientele.operators.ordered import as_of_merge, neighbour
from clientele.operators.quality import mutually_exclusive_ranges, scd_gaps, sequential_values
from clientele.operators.reports import monthly_totals, per_customer, merged
from clientele.plans import inputs
from clientele.plans.catalog import query
from clientele.plans.oracle import AS_OF as AS_OF_SQL
from clientele.plans.oracle import avg, d, days, month_of, months, n, rnd, sql
from clientele.session import written
from clientele.sources.roles import (
    AS_OF, category, changes, customers, fact, lines, raw_lines, table, transactions,
)

# ---- projections ----


@query("prj_clean_customers", """select c_custkey as customer_id, 'Customer' as first_name, split_part(c_name, '#', 2) as last_name,
    lower(trim('  ' || replace(c_name, '#', '.') || '@Example.COM ')) as email, upper(trim(' ' || lower(n_name) || ' ')) as state,
    trim(r_name || '  ') as city from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def prj_clean_customers(spark, folder):
    # Blanks and mixed case are put around the values, as raw files have them.
    raw = customers(spark, folder).select(
        "customer_id",
        F.concat(F.lit(" "), "first_name", F.lit("  ")).alias("first_name"),
        F.concat("last_name", F.lit(" ")).alias("last_name"),
        F.concat(F.lit("  "), "first_name", F.lit("."), "last_name", F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lit(" "), F.lower("state"), F.lit(" ")).alias("state"),
        F.concat("city", F.lit("  ")).alias("city"),
    )
    return clean.clean_customers(raw)


@query("prj_clean_transactions", """select l_orderkey * 10 + l_linenumber as transaction_id, 'Supplier ' || l_suppkey as merchant_name,
    coalesce(trim(case when p_type = 'LARGE' then null else ' ' || p_type || ' ' end), 'Uncategorized') as merchant_category
    from lineitem join part on l_partkey = p_partkey""")
def prj_clean_transactions(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.when(F.col("p_type") != "LARGE", F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("merchant_category"),
    )
    raw = raw_lines(spark, folder).join(parts, "part_id").select(
        "transaction_id", F.concat(F.lit(" Supplier "), "merchant_id", F.lit(" ")).alias("merchant_name"), "merchant_category"
    )
    return clean.clean_transactions(raw)


@query("prj_category_map", sql("select * from cat", "cat"))
def prj_category_map(spark, folder):
    return star.dim_category(table(spark, folder, "part").select(category().alias("c")), "c")


@query("prj_star_except", """select l_orderkey as raw_l_orderkey_v1, l_partkey as raw_l_partkey_v1, l_linenumber::bigint as raw_l_linenumber_v1,
    l_quantity as raw_l_quantity_v1, l_extendedprice as raw_l_extendedprice_v1, l_returnflag as raw_l_returnflag_v1 from lineitem""")
def prj_star_except(spark, folder):
    hidden = ["L_SUPPKEY", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
    return clean.star(table(spark, folder, "lineitem"), except_=hidden, prefix="raw_", suffix="_v1")


@query("prj_blank_to_null", "select event_id, nullif(case when event_type = 'error' then '' else event_type end, '') as event_type, nullif(props, '') as props, value from events")
def prj_blank_to_null(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type"), "props", "value"
    )
    return clean.blank_to_null(raw)


@query("prj_secure_columns", "select o_orderkey, cast(o_orderdate as date) as sales_date, o_orderpriority as item_sold, o_totalprice as total_price from orders")
def prj_secure_columns(spark, folder):
    """The consumer view leaves out the customer and the status."""
    return table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("sales_date"), F.col("o_orderpriority").alias("item_sold"),
        F.col("o_totalprice").alias("total_price"),
    )


# ---- filters ----


@query("flt_search", sql(
    "select customer_id, full_name, email, customer_segment, lifetime_value from profile where lower(full_name) like '%00012%' order by customer_id limit 20",
    "profile"))
def flt_search(spark, folder):
    rows = inputs.profile(spark, folder).select("customer_id", "full_name", "email", "customer_segment", "lifetime_value")
    return campaign.search(rows, name="00012")


@query("flt_history_window", sql(
    f"""select transaction_id, customer_id, transaction_date, {d('amount')} as amount, category_name, channel, status from fact
    where transaction_date >= {AS_OF_SQL} - 90 and category_name = 'Travel' and status = 'approved'""", "fact"))
def flt_history_window(spark, folder):
    return campaign.history(fact(spark, folder), AS_OF, days=90, category="Travel", status="approved").select("transaction_id", "customer_id", "transaction_date", "amount", "category_name", "channel", "status")


@query("flt_email_regex", sql(
    r"""select customer_id, regexp_matches(email, '^[^@]+@[^@]+\.[^@]+$') as valid_email, regexp_matches(first_name || last_name, '^Customer\d{9}$') as valid_id,
    credit_limit % 1000 = 0 as valid_step from cust""", "cust"))
def flt_email_regex(spark, folder):
    return customers(spark, folder).select(
        "customer_id",
        F.col("email").rlike(r"^[^@]+@[^@]+\.[^@]+$").alias("valid_email"),
        F.concat("first_name", "last_name").rlike(r"^Customer\d{9}$").alias("valid_id"),
        (F.col("credit_limit") % 1000 == 0).alias("valid_step"),
    )


@query("flt_between", "select o_orderkey, o_totalprice from orders where o_totalprice between 100000 and 150000 and o_orderdate between timestamp '1997-01-01' and timestamp '1998-12-31'")
def flt_between(spark, folder):
    return table(spark, folder, "orders").where(
        F.col("o_totalprice").between(100000.0, 150000.0)
        & F.col("o_orderdate").between(at_time(dt.datetime(1997, 1, 1)), at_time(dt.datetime(1998, 12, 31)))
    ).select("o_orderkey", "o_totalprice")


@query("flt_in", "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus in ('F')")
def flt_in(spark, folder):
    return table(spark, folder, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("F")
    ).select("o_orderkey", "o_orderpriority")


@query("flt_like", "select p_partkey, p_name from part where p_name like '%red%' and p_type not like 'S%'")
def flt_like(spark, folder):
    return table(spark, folder, "part").where(F.col("p_name").like("%red%") & ~F.col("p_type").like("S%")).select("p_partkey", "p_name")


@query("flt_ilike", "select p_partkey, p_brand from part where p_brand ilike 'BRAND#1%'")
def flt_ilike(spark, folder):
    return table(spark, folder, "part").where(F.col("p_brand").ilike("BRAND#1%")).select("p_partkey", "p_brand")


# ---- joins ----


@query("jn_fact_enrich", sql(
    f"""select md5(cast(transaction_id as varchar)) as transaction_key, transaction_id, customer_key, {n("strftime(transaction_date, '%Y%m%d')")} as date_key,
    category_key as merchant_category_key, transaction_date, merchant_id, channel, fact.status, {d('amount')} as amount, ingestion_timestamp
    from fact left join dim using (customer_id) left join cat using (category_name)
    where customer_key is not null and category_key is not null""", "fact", "dim", "cat"))
def jn_fact_enrich(spark, folder):
    dim = star.initial_dimension(customers(spark, folder))
    categories = star.dim_category(table(spark, folder, "part").select(category().alias("c")), "c")
    return star.fact_transactions(fact(spark, folder), dim, categories, feed=table(spark, folder, "lineitem"))


@query("jn_star", sql(
    f"""select customer_segment, category_group, year(transaction_date)::bigint as year, dayofweek(transaction_date) in (0, 6) as is_weekend,
    {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend
    from fact join dim using (customer_id) join cat using (category_name) group by 1, 2, 3, 4""", "fact", "dim", "cat"))
def jn_star(spark, folder):
    """Fact joined to the customer, category and date dimensions. The columns asked for come along with the keys, so every
    dimension is joined once."""
    dim = star.initial_dimension(customers(spark, folder))
    categories = star.dim_category(table(spark, folder, "part").select(category().alias("c")), "c")
    facts = star.fact_transactions(
        fact(spark, folder), dim, categories, carry=("customer_segment", "category_group"), feed=table(spark, folder, "lineitem")
    )
    span = transactions(spark, folder).agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    calendar = star.calendar_between(span, AS_OF).select("date_key", "year", "is_weekend")
    return (
        facts.join(calendar, "date_key").groupBy("customer_segment", "category_group", "year", "is_weekend")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_spend"))
    )


@query("jn_profile", sql(
    "select cust.customer_id, state, seg.customer_segment, lifetime_value, avg_transaction_value, churn_risk_score from cust join seg using (customer_id) left join pred using (customer_id)",
    "cust", "seg", "pred"))
def jn_profile(spark, folder):
    scored = inputs.with_scores(inputs.segments(spark, folder))
    return customers(spark, folder).select("customer_id", "state").join(
        scored.select("customer_id", "customer_segment", "lifetime_value", "avg_transaction_value", "churn_risk_score"), "customer_id"
    )


@query("jn_left_agg", sql(
    f"""select cust.customer_id, {n('count(transaction_id)')} as txn_count, {d('sum(amount)')} as total_spend, {avg('amount')} as avg_amount
    from cust left join txn t on cust.customer_id = t.customer_id group by 1""", "cust", "txn"))
def jn_left_agg(spark, folder):
    totals = per_customer(transactions(spark, folder))
    return customers(spark, folder).select("customer_id").join(totals, "customer_id", "left").groupBy("customer_id").agg(
        *merged("txn_count", "total_spend", "avg_amount")
    )


@query("jn_anti_orphans", sql(
    f"""select 'orders of unknown customers' as kind, {n('count(*)')} as issue_count from txn
        where not exists (select 1 from cust where cust.customer_id = txn.customer_id)
    union all select 'customers without orders', {n('count(*)')} from cust
        where not exists (select 1 from txn where txn.customer_id = cust.customer_id)""", "txn", "cust"))
def jn_anti_orphans(spark, folder):
    txn, who = transactions(spark, folder), customers(spark, folder)
    # Orders are counted per customer before the anti join, so that a busy customer is one row of it.
    counted = txn.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    orphans = counted.join(who, "customer_id", "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("issue_count")
    )
    idle = who.join(counted, "customer_id", "left_anti").agg(F.count(F.lit(1)).alias("issue_count"))
    return orphans.withColumn("kind", F.lit("orders of unknown customers")).unionByName(
        idle.withColumn("kind", F.lit("customers without orders"))
    )


@query("jn_asof_scd", sql(
    f"""with v as (select customer_id, card_type, account_open_date as valid_from, date '1998-06-30' as valid_to from cust
        union all select customer_id, 'Premium', date '1998-07-01', null from cust)
    select txn.transaction_id, txn.customer_id, transaction_date, {d('amount')} as amount, card_type, valid_from from txn join v on txn.customer_id = v.customer_id
    and transaction_date between valid_from and coalesce(valid_to, date '9999-12-31')""", "txn", "cust"))
def jn_asof_scd(spark, folder):
    who = customers(spark, folder)
    change = dt.date(1998, 7, 1)
    first = who.select("customer_id", "card_type", F.col("account_open_date").alias("valid_from"), F.lit(days_before(change, 1)).alias("valid_to"))
    second = who.select("customer_id", F.lit("Premium").alias("card_type"), F.lit(change).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    joined = star.join_as_of(transactions(spark, folder), first.unionByName(second), "customer_id", "transaction_date")
    return joined.select("transaction_id", "customer_id", "transaction_date", "amount", "card_type", "valid_from")


@query("jn_asof_dense", sql(
    f"""with rate as (select channel, transaction_date as valid_from, {d('max(amount)')} as top_amount, {n('count(*)')} as day_orders from txn group by 1, 2),
        shipped as (select line.transaction_id, txn.channel, cast(line.ingestion_timestamp as date) as ship_date from line join txn on line.order_id = txn.transaction_id)
    select transaction_id, s.channel, ship_date, valid_from, top_amount, day_orders from shipped s asof join rate r on s.channel = r.channel and s.ship_date >= r.valid_from""", "line", "txn"))
def jn_asof_dense(spark, folder):
    """Shipped lines with their channel's figures of the last order day up to shipping: few keys, each with very many versions."""
    txn = transactions(spark, folder)
    daily = txn.groupBy("channel", F.col("transaction_date").alias("valid_from")).agg(
        F.max("amount").cast("double").alias("top_amount"), F.count(F.lit(1)).alias("day_orders")
    )
    orders = txn.select(F.col("transaction_id").alias("order_id"), "channel")
    # Of the latest delivery only its time is asked for: a plain max, and nothing else of the line is shuffled.
    latest = raw_lines(spark, folder).groupBy("transaction_id", "order_id").agg(F.max("ingestion_timestamp").cast("date").alias("ship_date"))
    shipped = latest.join(orders, "order_id").select("transaction_id", "channel", "ship_date")
    return as_of_merge(written(shipped, "shipped"), daily, "channel", "ship_date")


@query("jn_before_after", sql(
    f"""with u as (select customer_id, min(transaction_date) as upgrade_date from txn where channel = '1-URGENT' group by 1)
    select txn.customer_id, case when transaction_date < upgrade_date then 'Before Upgrade' else 'After Upgrade' end as upgrade_period,
    {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend, {avg('amount')} as avg_spend from txn join u on txn.customer_id = u.customer_id group by 1, 2""", "txn"))
def jn_before_after(spark, folder):
    txn = transactions(spark, folder)
    first = txn.where(F.col("channel") == "1-URGENT").groupBy("customer_id").agg(F.min("transaction_date").alias("upgrade_date"))
    return star.before_after(txn, first, "customer_id", "transaction_date")


MONTHS_SQL = "m as (select unnest(range(date '1995-01-01', date '2001-09-01', interval 1 month))::date as month)"


def _months(spark, folder):
    """Months of the feed as a literal calendar; only its first and last day come to the driver."""
    span = transactions(spark, folder).agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last")).first()
    return reshape.months_from(span["first"], span["last"])


@query("jn_cross_spine", sql(f"with {MONTHS_SQL} select customer_id, month from cust, m", "cust"))
def jn_cross_spine(spark, folder):
    return reshape.entity_months(table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id")), "customer_id", _months(spark, folder))


@query("jn_cross_snapshot", sql(
    f"""with b as (select count(*) as c, sum(amount) as s from txn where transaction_date < date '2000-01-01'), a as (select count(*) as c, sum(amount) as s from txn)
    select {n('b.c')} as before_count, {n('a.c')} as after_count, {n('a.c - b.c')} as delta_count, {d('b.s')} as before_amount, {d('a.s')} as after_amount, {d('a.s - b.s')} as delta_amount from a, b""", "txn"))
def jn_cross_snapshot(spark, folder):
    """The one-row figures of two snapshots beside each other; the earlier one is a condition in the pass that gives the later."""
    early = F.col("transaction_date") < F.lit(dt.date(2000, 1, 1))
    both = transactions(spark, folder).agg(
        F.count_if(early).alias("before_count"), F.count(F.lit(1)).alias("after_count"),
        F.sum(F.when(early, F.col("amount"))).alias("before_amount"), F.sum("amount").alias("after_amount"),
    )
    return both.withColumns({
        "delta_count": F.col("after_count") - F.col("before_count"), "delta_amount": F.col("after_amount") - F.col("before_amount"),
    })


@query("jn_full_counts", sql(
    f"""with a as (select customer_segment, state, count(*) as count_a from cust where card_type = 'Premium' group by 1, 2),
    b as (select customer_segment, state, count(*) as count_b from cust where credit_limit < 1000 group by 1, 2)
    select a.customer_segment as customer_segment_a, b.customer_segment as customer_segment_b, a.state as state_a, b.state as state_b, count_a, count_b
    from a full join b on a.customer_segment = b.customer_segment and a.state = b.state""", "cust"))
def jn_full_counts(spark, folder):
    who = customers(spark, folder)
    return setops.group_counts(who.where(F.col("card_type") == "Premium"), who.where(F.col("credit_limit") < 1000), ["customer_segment", "state"])


@query("jn_relationships_where", sql(
    "select txn.customer_id as id from txn where amount > 490000 and not exists (select 1 from cust where cust.customer_id = txn.customer_id and card_type = 'Premium')",
    "txn", "cust"))
def jn_relationships_where(spark, folder):
    child = transactions(spark, folder).where(F.col("amount") > 490000).select(F.col("customer_id").alias("id"))
    parent = customers(spark, folder).where(F.col("card_type") == "Premium").select(F.col("customer_id").alias("id"))
    return child.where(F.col("id").isNotNull()).join(parent, "id", "left_anti")


@query("jn_natural", sql("select transaction_id, order_id, cast(amount as double) as amount, part_id, merchant_id, ingestion_timestamp from line", "line"))
def jn_natural(spark, folder):
    """The default deduplication joins the first row back over all common columns; here the row itself is carried."""
    return deduplicate(
        raw_lines(spark, folder), ["transaction_id"],
        [("ingestion_timestamp", "desc"), ("amount", "desc"), ("part_id", "desc"), ("merchant_id", "desc")],
    )


# ---- windows ----


@query("win_dedupe_latest", sql(
    "select transaction_id, order_id, cast(amount as double) as amount, part_id, merchant_id, ingestion_timestamp from line", "line"))
def win_dedupe_latest(spark, folder):
    return lines(spark, folder)


@query("win_deduplicate", """select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by value desc, event_id) as rn from events) where rn = 1""")
def win_deduplicate(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "value")
    return deduplicate(events, ["user_id", "event_type"], [("value", "desc"), ("event_id", "asc")])


@query("win_latest_per_group", "select event_type, ts, event_id, user_id, value from (select *, row_number() over (partition by event_type order by ts desc, event_id desc) as rn from events) where rn = 1")
def win_latest_per_group(spark, folder):
    runs = table(spark, folder, "events").select("event_type", "ts", "event_id", "user_id", "value")
    return latest_per_key(runs, ["event_type"], ["ts", "event_id"])


@query("win_sequence_key", "select cast(row_number() over (order by p_brand) as bigint) as brand_key, p_brand from (select distinct p_brand from part)")
def win_sequence_key(spark, folder):
    # A dimension key over distinct names: the distinct set is small by nature.
    brands = table(spark, folder, "part").select("p_brand").distinct()
    return brands.withColumn("brand_key", F.row_number().over(Window.orderBy("p_brand")))


@query("win_global_row_id", sql(
    "select 'TXN' || lpad(cast(row_number() over (order by transaction_date, customer_id, transaction_id) as varchar), 11, '0') as row_id, transaction_id from txn", "txn"))
def win_global_row_id(spark, folder):
    numbered = W.global_row_number(
        transactions(spark, folder).select("transaction_id", "customer_id", "transaction_date"),
        "transaction_date", "customer_id", "transaction_id", "row_no",
    )
    return numbered.select(F.concat(F.lit("TXN"), F.lpad(F.col("row_no").cast("string"), 11, "0")).alias("row_id"), "transaction_id")


@query("win_mom_change", sql(
    f"""with g as (select {month_of('transaction_date')} as month, count(*) as c, count(distinct customer_id) as u, sum(amount) as s from txn group by 1)
    select month, {n('c')} as txn_count, {n('u')} as unique_customers, {d('s')} as total_spend, cast(s as double) / c as avg_amount,
    {n('lag(c) over (order by month)')} as prev_month_txns,
    {rnd("(c - lag(c) over (order by month))::double * 100 / nullif(cast(lag(c) over (order by month) as double), 0)")} as txn_count_pct_change from g""", "txn"))
def win_mom_change(spark, folder):
    return W.month_over_month(monthly_totals(transactions(spark, folder)), "month", "txn_count", "prev_month_txns")


INTERVALS_SQL = """select id, label, update_timestamp as start_time,
    coalesce(lead(update_timestamp) over (partition by id order by update_timestamp), timestamp '9999-12-31 00:00:00') as end_time,
    case when lead(update_timestamp) over (partition by id order by update_timestamp) is null then 1 else 0 end::bigint as current_flag
    from chg where action = 'INSERT'"""


@query("win_scd_intervals", sql(INTERVALS_SQL, "chg"))
def win_scd_intervals(spark, folder):
    rows = changes(spark, folder).where(F.col("action") == "INSERT").select("id", "label", "update_timestamp")
    near = neighbour(rows, ["id"], "update_timestamp", "_next")
    open_end = at_time(dt.datetime(9999, 12, 31))
    return near.select(
        "id", "label", F.col("update_timestamp").alias("start_time"), F.coalesce("_next", open_end).alias("end_time"),
        F.col("_next").isNull().cast("int").alias("current_flag"),
    )


VERSIONS_SQL = f"""v as (select customer_id, {month_of('transaction_date')} as valid_from from txn group by 1, 2),
    w as (select customer_id, valid_from, case when month(valid_from) = 6 then lead(valid_from) over (partition by customer_id order by valid_from) - 11
        else lead(valid_from) over (partition by customer_id order by valid_from) - 1 end::date as valid_to from v)"""


def _versions(spark, folder):
    """Customer versions by active month; versions that start in June end ten days too early."""
    starts = transactions(spark, folder).select("customer_id", F.trunc("transaction_date", "month").alias("valid_from")).distinct()
    near = neighbour(starts, ["customer_id"], "valid_from", "_next")
    short = F.when(F.month("valid_from") == 6, 11).otherwise(1)
    return near.select("customer_id", "valid_from", F.date_sub("_next", short).alias("valid_to"))


@query("win_scd_gaps", sql(
    f"""with {VERSIONS_SQL}, x as (select *, lead(valid_from) over (partition by customer_id order by valid_from) as next_valid_from from w)
    select customer_id, valid_from, valid_to, next_valid_from, {days('valid_to', 'next_valid_from')} - 1 as gap_days from x
    where next_valid_from is not null and valid_to != next_valid_from - 1""", "txn"))
def win_scd_gaps(spark, folder):
    return scd_gaps(_versions(spark, folder), "customer_id")


@query("win_ranges_exclusive", """with r as (select user_id, ts as lower_bound, ts + interval 4 hour as upper_bound, lead(ts) over (partition by user_id order by ts) as next_lower_bound from events)
    select * from r where not coalesce(upper_bound < next_lower_bound, next_lower_bound is null)""")
def win_ranges_exclusive(spark, folder):
    """Sessions of four hours per user that do not leave a gap before the next one."""
    sessions = table(spark, folder, "events").select(
        "user_id", F.col("ts").alias("lower_bound"), (F.col("ts") + F.expr("interval 4 hours")).alias("upper_bound")
    )
    return mutually_exclusive_ranges(sessions, "lower_bound", "upper_bound", ["user_id"], gaps="required")


@query("win_sequential", """with r as (select event_type, event_id, lag(event_id) over (partition by event_type order by event_id) as previous_value from events)
    select * from r where not (event_id = previous_value + 1)""")
def win_sequential(spark, folder):
    ids = table(spark, folder, "events").select("event_type", "event_id")
    return sequential_values(ids, "event_id", ["event_type"], 1)


# ---- sort, limit, sets ----


@query("srt_topk", sql(
    f"""select customer_id, {n('count(*)')} as txn_count, {avg('amount')} as avg_amount, {d('sum(amount)')} as total_spend, min(transaction_date) as first_txn,
    max(transaction_date) as last_txn from txn group by 1 order by sum(amount) desc, customer_id limit 10""", "txn"))
def srt_topk(spark, folder):
    totals = per_customer(transactions(spark, folder)).groupBy("customer_id").agg(
        *merged("txn_count", "avg_amount", "total_spend", "first_txn", "last_txn")
    )
    return totals.orderBy(F.desc("total_spend"), "customer_id").limit(10)


@query("set_union_all", f"""select 'orders' as source, {n('count(*)')} as row_count, {n('count(*) filter (o_custkey is null)')} as null_keys from orders
    union all select 'customer', {n('count(*)')}, {n('count(*) filter (c_custkey is null)')} from customer
    union all select 'lineitem', {n('count(*)')}, {n('count(*) filter (l_orderkey is null)')} from lineitem""")
def set_union_all(spark, folder):
    parts = [("orders", "o_custkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey")]
    rows = [
        table(spark, folder, t).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(k).isNull()).alias("null_keys"))
        .withColumn("source", F.lit(t))
        for t, k in parts
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("set_union_distinct", sql("select id, label from chg where action = 'INSERT' union select id, label from chg where is_update union select id, label from chg where action = 'DELETE'", "chg"))
def set_union_distinct(spark, folder):
    rows = changes(spark, folder)
    picked = [rows.where(F.col("action") == "INSERT"), rows.where("is_update"), rows.where(F.col("action") == "DELETE")]
    a, b, c = [p.select("id", "label") for p in picked]
    return a.union(b).union(c).distinct()


@query("set_union_relations", """select 'customer' as source_relation, c_custkey as id, c_name as name, cast(c_acctbal as decimal(12,1))::double as balance, c_mktsegment as segment from customer
    union all select 'supplier', s_suppkey, s_name, cast(s_acctbal as decimal(12,1))::double, null from supplier""")
def set_union_relations(spark, folder):
    who = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
    )
    sellers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
    return setops.union_relations({"customer": who, "supplier": sellers}, exclude=["nation"], override={"balance": "decimal(12,1)"})


@query("set_except_both", """with a as (select l_orderkey, l_returnflag from lineitem where l_linestatus = 'O'), b as (select l_orderkey, l_returnflag from lineitem where l_quantity > 25)
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b) union all select 'b_minus_a', * from (select * from b except select * from a)""")
def set_except_both(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    a, b = items.where(F.col("l_linestatus") == "O"), items.where(F.col("l_quantity") > 25)
    return setops.except_both(a, b, ["l_orderkey", "l_returnflag"])


@query("set_cardinality_diff", f"""with a as (select c_nationkey::bigint as value, {n('count(*)')} as num_rows from customer group by 1), b as (select s_nationkey::bigint as value, {n('count(*)')} as num_rows from supplier group by 1)
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b) union all select 'b_minus_a', * from (select * from b except select * from a)""")
def set_cardinality_diff(spark, folder):
    return setops.cardinality_diff(table(spark, folder, "customer"), "c_nationkey", table(spark, folder, "supplier"), "s_nationkey")


@query("set_distinct", "select distinct o_orderpriority, o_orderstatus from orders")
def set_distinct(spark, folder):
    return table(spark, folder, "orders").select("o_orderpriority", "o_orderstatus").distinct()


# ---- reshape ----


@query("agg_pivot", f"""select o_custkey, {n("sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end)")} as n_1urgent, {n("sum(case when o_orderpriority = '5-LOW' then 1 else 0 end)")} as n_5low,
    {d("sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) else 0 end)")} as spend_f from orders group by 1""")
def agg_pivot(spark, folder):
    counts = reshape.pivot_columns("o_orderpriority", ["1-URGENT", "5-LOW"], prefix="n ", slug=True)
    counts = [c.alias(a) for c, a in zip(counts, ["n_1urgent", "n_5low"])]
    spend = reshape.pivot_columns("o_orderstatus", ["F"], then=F.col("o_totalprice").cast(K.MONEY), prefix="spend_", slug=True)
    return table(spark, folder, "orders").groupBy("o_custkey").agg(*counts, *spend)


@query("agg_column_values", "select o_orderpriority as value from orders where o_orderstatus = 'F' group by 1 order by count(*) desc, 1 limit 3")
def agg_column_values(spark, folder):
    return reshape.column_values(table(spark, folder, "orders"), "o_orderpriority", limit=3, where=F.col("o_orderstatus") == "F")


@query("shp_unpivot", """select p_partkey, field_name, value from (select p_partkey, cast(p_size as varchar) as p_size, p_brand, case when p_size > 25 then 'true' else 'false' end as is_big from part)
    unpivot include nulls (value for field_name in (p_size, p_brand, is_big))""")
def shp_unpivot(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_brand", "p_name", (F.col("p_size") > 25).alias("is_big"))
    return reshape.unpivot(parts, exclude=["p_partkey"], remove=["p_name"])


@query("shp_series", "select cast(unnest(range(1, (select count(*) from orders) + 1)) as bigint) as generated_number")
def shp_series(spark, folder):
    return reshape.series(spark, table(spark, folder, "orders").count())


@query("shp_date_spine", "select unnest(range((select min(cast(o_orderdate as date)) from orders), (select max(cast(o_orderdate as date)) from orders), interval 1 day))::date as date_day")
def shp_date_spine(spark, folder):
    span = transactions(spark, folder).agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    return reshape.spine_of(span, "INTERVAL 1 DAY", "date_day")


@query("shp_date_spine_parts", " union all ".join(
    f"""select '{part}' as part, s as moment from (select unnest(range((select min(cast(o_orderdate as date)) from orders)::timestamp, (select max(cast(o_orderdate as date)) from orders)::timestamp, interval {step})) as s)"""
    for part, step in (("hour", "1 hour"), ("week", "7 day"), ("month", "1 month"), ("quarter", "3 month"), ("year", "1 year"))))
def shp_date_spine_parts(spark, folder):
    """Spines of several parts over the days of the orders; the two bounds are read first."""
    first, last = transactions(spark, folder).agg(F.min("transaction_date"), F.max("transaction_date")).first()
    out = None
    for part in ("hour", "week", "month", "quarter", "year"):
        own = reshape.date_spine(spark, part, first, last).select(F.lit(part).alias("part"), F.col(f"date_{part}").cast("timestamp_ntz").alias("moment"))
        out = own if out is None else out.unionByName(own)
    return out


@query("shp_dim_date", sql(f"""with days as (select unnest(range((select min(transaction_date) from txn), (select max(transaction_date) from txn) + 1, interval 1 day))::date as d)
    select d as date_day, {n("strftime(d, '%Y%m%d')")} as date_key, {n('year(d)')} as year, {n('quarter(d)')} as quarter, 'Q' || quarter(d) || ' ' || year(d) as quarter_name,
    {n('month(d)')} as month, strftime(d, '%b') as month_name, strftime(d, '%b %Y') as month_year, strftime(d, '%Y-%m') as year_month, {n('weekofyear(d)')} as week_of_year,
    {n('weekofyear(d)')} as week_iso, {n('day(d)')} as day_of_month, {n('dayofweek(d)')} as day_of_week, strftime(d, '%a') as day_name, {n('dayofyear(d)')} as day_of_year,
    dayofweek(d) in (0, 6) as is_weekend, dayofweek(d) between 1 and 5 as is_weekday, d = {AS_OF_SQL} as is_today, d = {AS_OF_SQL} - 1 as is_yesterday, d = {AS_OF_SQL} + 1 as is_tomorrow,
    day(d) = 1 as is_first_day_of_month, d = last_day(d) as is_last_day_of_month, {n('year(d)')} as fiscal_year, {n('quarter(d)')} as fiscal_quarter from days""", "txn"))
def shp_dim_date(spark, folder):
    span = transactions(spark, folder).agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    return star.calendar_between(span, AS_OF)


@query("shp_monthly_panel", sql(
    f"""with {MONTHS_SQL} select cust.customer_id, m.month, coalesce(monthly.transaction_count, 0) as transaction_count, {d('coalesce(monthly.total_spend, 0)')} as total_spend
    from cust cross join m left join monthly on monthly.customer_id = cust.customer_id and monthly.month = m.month""", "cust", "monthly"))
def shp_monthly_panel(spark, folder):
    active = monthly_spending(transactions(spark, folder)).select("customer_id", "month", "transaction_count", "total_spend")
    return reshape.monthly_panel(active, customers(spark, folder), _months(spark, folder), "customer_id", ["transaction_count", "total_spend"])


@query("shp_expand_rows", f"""with e as (select l_orderkey, unnest(range(0, cast(l_quantity as bigint))) as seq from lineitem where l_quantity >= 1)
    select l_orderkey, {n('count(*)')} as units, {n('sum(seq)')} as seq_total from e group by 1""")
def shp_expand_rows(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    units = reshape.expand_rows(items, F.col("l_quantity"))
    return units.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("units"), F.sum("seq").alias("seq_total"))


# ---- column functions ----


@query("fn_surrogate_key", """select c_custkey, md5(cast(c_custkey as varchar) || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '_dbt_utils_surrogate_key_null_')) as key_marked,
    md5(cast(c_custkey as varchar) || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '')) as key_blank from customer""")
def fn_surrogate_key(spark, folder):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, folder, "customer").select(
        "c_custkey", K.surrogate_key("c_custkey", segment).alias("key_marked"),
        K.surrogate_key("c_custkey", segment, null_as_empty=True).alias("key_blank"),
    )


@query("fn_safe_math", """select event_id, coalesce(case when event_type != 'view' then value end, 0) + coalesce(value, 0) as added, coalesce(case when event_type != 'view' then value end, 0) - coalesce(value, 0) as subtracted,
    value / nullif(case when event_type = 'error' then 0.0::double else value + 1 end, 0) as divided from events""")
def fn_safe_math(spark, folder):
    part = F.when(F.col("event_type") != "view", F.col("value"))
    below = F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value") + 1)
    return table(spark, folder, "events").select(
        "event_id", K.safe_add(part, "value").alias("added"), K.safe_subtract(part, "value").alias("subtracted"),
        K.safe_divide("value", below).alias("divided"),
    )


@query("fn_width_bucket", f"""select bucket, {n('count(*)')} as orders from (select case when o_totalprice < 100000 then 0 when o_totalprice >= 400000 then 11
    else cast(floor(10 * (o_totalprice - 100000) / 300000) as bigint) + 1 end as bucket from orders) group by 1""")
def fn_width_bucket(spark, folder):
    bucket = K.width_bucket("o_totalprice", 100000, 400000, 10).alias("bucket")
    return table(spark, folder, "orders").groupBy(bucket).agg(F.count(F.lit(1)).alias("orders"))


@query("fn_haversine", """with p as (select vec_id, embedding[1]::double * 90 as lat1, embedding[2]::double * 180 as lon1, embedding[3]::double * 90 as lat2, embedding[4]::double * 180 as lon2 from embeddings),
    k as (select vec_id, 2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))) as mi from p)
    select vec_id, round(mi, 5) as miles, round(mi * 1.60934, 5) as km from k""")
def fn_haversine(spark, folder):
    at = [F.element_at("embedding", i).cast("double") for i in (1, 2, 3, 4)]
    points = (at[0] * 90, at[1] * 180, at[2] * 90, at[3] * 180)
    return table(spark, folder, "embeddings").select(
        "vec_id", F.round(K.haversine_distance(*points), 5).alias("miles"), F.round(K.haversine_distance(*points, unit="km"), 5).alias("km")
    )


HOST_SQL = "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)"


@query("fn_url", f"""with p as (select page_id, replace(replace(url, 'http://', ''), 'https://', '') as bare, url from pages)
    select page_id, {HOST_SQL} as host, split_part(right(bare, length(bare) - coalesce(nullif(position('/' in bare), 0), position('?' in bare) - 1)), '?', 1) as path,
    nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') as page, nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') as ref from p""")
def fn_url(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", X.url_host("url").alias("host"), X.url_path("url").alias("path"), X.url_parameter("url", "page").alias("page"),
        X.url_parameter("url", "ref").alias("ref"),
    )


@query("fn_url_rollup", f"select {HOST_SQL} as host, {n('count(*)')} as pages, {n('count(distinct url)')} as urls from pages group by 1")
def fn_url_rollup(spark, folder):
    return table(spark, folder, "pages").groupBy(X.url_host("url").alias("host")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_distinct("url").alias("urls")
    )


@query("fn_string", """select c_custkey, c_name || '/' || c_mktsegment as joined, concat(c_mktsegment, '-', c_custkey) as concatenated, upper(substr(c_name, 1, 4)) as head, lpad(cast(c_custkey as varchar), 8, '0') as padded,
    rtrim(c_mktsegment || '   ') as trimmed, left(c_mktsegment, 3) as short, repeat('=', 5) as line, regexp_replace(c_name, '#0+', '-', 'g') as plain, contains(c_name, '77') as lucky, trim(lower(c_mktsegment)) as low from customer""")
def fn_string(spark, folder):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey", F.concat(name, F.lit("/"), seg).alias("joined"), F.concat(seg, F.lit("-"), "c_custkey").alias("concatenated"),
        F.upper(F.substring(name, 1, 4)).alias("head"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"),
        F.rtrim(F.concat(seg, F.lit("   "))).alias("trimmed"), F.left(seg, F.lit(3)).alias("short"), F.repeat(F.lit("="), 5).alias("line"),
        F.regexp_replace(name, "#0+", "-").alias("plain"), name.contains("77").alias("lucky"), F.trim(F.lower(seg)).alias("low"),
    )


@query("fn_date", sql(
    f"""select transaction_id, {months('transaction_date', AS_OF_SQL)} as months_ago, {days('transaction_date', AS_OF_SQL)} as days_ago,
    {n(f"date_diff('second', cast(transaction_date as timestamp), cast({AS_OF_SQL} as timestamp))")} as seconds_ago, {month_of('transaction_date')} as month_start, last_day(transaction_date) as month_end,
    cast(transaction_date + interval 1 month as date) as next_month, cast(transaction_date + 30 as date) as plus_30, {n('quarter(transaction_date)')} as quarter, {n('weekofyear(transaction_date)')} as week,
    {n('dayofweek(transaction_date)')} as dow, {n('dayofyear(transaction_date)')} as doy, strftime(transaction_date, '%b') as month_name, strftime(transaction_date, '%a') as day_name,
    strftime(transaction_date, '%Y%m%d') as compact from txn""", "txn"))
def fn_date(spark, folder):
    day = F.col("transaction_date")
    return transactions(spark, folder).select(
        "transaction_id", months_between_boundaries(day, on(AS_OF)).alias("months_ago"), F.datediff(on(AS_OF), day).alias("days_ago"),
        F.expr(f"timestampdiff(SECOND, cast(transaction_date as timestamp_ntz), timestamp_ntz '{AS_OF} 00:00:00')").alias("seconds_ago"),
        F.trunc(day, "month").alias("month_start"), F.last_day(day).alias("month_end"), F.add_months(day, 1).alias("next_month"),
        F.date_add(day, 30).alias("plus_30"), F.quarter(day).alias("quarter"), F.weekofyear(day).alias("week"),
        (F.dayofweek(day) - 1).alias("dow"), F.dayofyear(day).alias("doy"), F.date_format(day, "MMM").alias("month_name"),
        F.date_format(day, "EEE").alias("day_name"), F.date_format(day, "yyyyMMdd").alias("compact"),
    )


@query("fn_math", """select p_partkey, greatest(p_retailprice, p_size * 30.0::double) as highest, least(p_retailprice, p_size * 30.0::double) as lowest, ceil(p_retailprice / 7)::bigint as up, (p_partkey % 7)::bigint as remainder,
    pow(p_size::double, 2) as squared, abs(p_size - 25)::bigint as distance, trunc(p_retailprice / 3)::bigint as whole, nullif(p_size, 10)::bigint as not_ten, coalesce(nullif(p_size, 10), -1)::bigint as or_minus,
    if(p_size > 25, 'big', 'small') as size_class, round(p_retailprice / 8, 0) as rounded from part""")
def fn_math(spark, folder):
    price, size = F.col("p_retailprice"), F.col("p_size")
    return table(spark, folder, "part").select(
        "p_partkey", F.greatest(price, size * F.lit(30.0)).alias("highest"), F.least(price, size * F.lit(30.0)).alias("lowest"),
        F.ceil(price / 7).alias("up"), (F.col("p_partkey") % 7).alias("remainder"), F.pow(size.cast("double"), F.lit(2.0)).alias("squared"),
        F.abs(size - 25).alias("distance"), (price / 3).cast("bigint").alias("whole"), F.nullif(size, F.lit(10)).alias("not_ten"),
        F.coalesce(F.nullif(size, F.lit(10)), F.lit(-1)).alias("or_minus"), F.when(size > 25, "big").otherwise("small").alias("size_class"),
        F.round(price / 8, 0).alias("rounded"),
    )


@query("fn_cast", """select o_orderkey, cast(o_totalprice as decimal(15,1))::double as rounded_price, try_cast(o_orderpriority as date) as not_a_date, cast(strftime(o_orderdate, '%Y-%m-%d') as date) as a_date,
    try_cast(left(o_orderpriority, 1) as bigint) as priority_number, o_orderdate as stamp from orders""")
def fn_cast(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(15,1)").alias("rounded_price"), F.try_to_date("o_orderpriority").alias("not_a_date"),
        F.to_date(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd").alias("a_date"),
        F.left("o_orderpriority", F.lit(1)).try_cast("bigint").alias("priority_number"),
        F.to_timestamp_ntz(F.date_format("o_orderdate", "yyyyMMdd-HHmmss"), F.lit("yyyyMMdd-HHmmss")).alias("stamp"),
    )


@query("fn_semi", """select event_id, cast(json_extract(props, '$.k') as bigint) as k, ['low', 'mid', 'high'][cast(cast(json_extract(props, '$.k') as bigint) // 34 as bigint) + 1] as level,
    case when event_type = 'purchase' then value end as purchase_value from events""")
def fn_semi(spark, folder):
    data = F.parse_json("props")
    k = F.variant_get(data, "$.k", "bigint")
    levels = F.array(F.lit("low"), F.lit("mid"), F.lit("high"))
    packed = F.create_map(F.col("event_type"), F.col("value"))
    return table(spark, folder, "events").select(
        "event_id", k.alias("k"), F.element_at(levels, F.floor(k / 34).cast("int") + 1).alias("level"),
        F.try_element_at(packed, F.lit("purchase")).alias("purchase_value"),
    )


BYTES_SQL = "case when b > pow(1024, 3) then cast(cast(trunc(b / pow(1024, 3)) as bigint) as varchar) || 'GB' when b > pow(1024, 2) then cast(cast(trunc(b / pow(1024, 2)) as bigint) as varchar) || 'MB' when b > 1024 then cast(cast(trunc(b / 1024) as bigint) as varchar) || 'KB' else cast(cast(b as bigint) as varchar) end"
TIME_SQL = "case when s // 3600 > 0 then (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' when s // 60 > 0 then (s // 60) || 'm ' || (s % 60) || 's' when s > 0 then s || 's' else ms || 'ms' end"


@query("fn_format", f"""with f as (select doc_id, cast(n_chars * n_chars as double) as b, n_chars * 113 as ms, cast(n_chars * 113 // 1000 as bigint) as s, n_chars * 997 as c, source from documents)
    select doc_id, {BYTES_SQL} as bytes, {TIME_SQL} as elapsed, case when c >= 1000000000 then printf('%.1f', {rnd('c / 1000000000.0::double', 1)}) || ' Billion' when c >= 1000000 then printf('%.1f', {rnd('c / 1000000.0::double', 1)}) || ' Million'
    when c >= 1000 then printf('%.1f', {rnd('c / 1000.0::double', 1)}) || ' K' else cast(c as varchar) end as amount, case when c >= 1000000 then 8.0::double else 0.0::double end as credits from f""")
def fn_format(spark, folder):
    size = F.col("n_chars")
    return table(spark, folder, "documents").select(
        "doc_id", X.format_bytes(size * size).alias("bytes"), X.format_millis(size * 113).alias("elapsed"), X.format_count(size * 997).alias("amount"),
        X.credits_per_hour(F.when(size * 997 >= 1000000, "Large").otherwise("Unknown")).alias("credits"),
    )


@query("fn_readable_columns", f"""select c_custkey as "Customer Id", case when c_acctbal < 0 and {rnd('c_acctbal / 100', 1)} = 0 then '-0.0' else printf('%.1f', {rnd('c_acctbal / 100', 1)}) end || '%' as "Discount Percent",
    case when abs(c_acctbal) >= 1000 then '$' || format('{{:,}}', cast({rnd('c_acctbal', 0)} as bigint)) else '$' || printf('%.2f', c_acctbal) end as "Average Spend",
    format('{{:,}}', c_custkey * 7) as "Number Orders", '1995-03-01' as "Open Date" from customer""")
def fn_readable_columns(spark, folder):
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), (F.col("c_acctbal") / 100).alias("discount_pct"), F.col("c_acctbal").alias("avg_spend"),
        (F.col("c_custkey") * 7).alias("num_orders"), F.lit(dt.date(1995, 3, 1)).alias("open_date"),
    )
    return X.readable(rows)
