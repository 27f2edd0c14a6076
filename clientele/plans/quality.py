"""Data-quality checks, check suites, telemetry and observability."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clientele.functions.dates import at_time
from clientele.operators import quality as Q
from clientele.operators import suites as S
from clientele.operators import telemetry as T
from clientele.operators.dedupe import latest_per_key
from clientele.plans import inputs
from clientele.plans.catalog import query
from clientele.plans.oracle import AS_OF as AS_OF_SQL
from clientele.plans.oracle import avg, d, days, month_of, months, n, pct, rnd, sql
from clientele.plans.tables import VERSIONS_SQL, _versions
from clientele.session import scratch
from clientele.sources.roles import AS_OF, EVENTS_AS_OF, customers, raw_lines, table, transactions

# ---- generic checks ----


@query("dq_accepted_range", "select o_orderkey, o_totalprice from orders where not o_totalprice >= 5000 or not o_totalprice <= 490000")
def dq_accepted_range(spark, folder):
    return Q.accepted_range(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 5000.0, 490000.0)


@query("dq_not_accepted_values", "select distinct o_orderpriority as value_field from orders where o_orderpriority in ('4-NOT SPECIFIED', 'UNKNOWN')")
def dq_not_accepted_values(spark, folder):
    return Q.not_accepted_values(table(spark, folder, "orders"), "o_orderpriority", ["4-NOT SPECIFIED", "UNKNOWN"])


@query("dq_accepted_values", f"select o_orderstatus as value_field, {n('count(*)')} as n_records from orders where o_orderstatus not in ('F', 'O') group by 1")
def dq_accepted_values(spark, folder):
    return Q.accepted_values(table(spark, folder, "orders"), "o_orderstatus", ["F", "O"])


@query("dq_not_null", sql("select customer_id, customer_segment, decline_type from cust where decline_type is null", "cust"))
def dq_not_null(spark, folder):
    return Q.not_null(customers(spark, folder).select("customer_id", "customer_segment", "decline_type"), "decline_type")


@query("dq_unique", sql(f"select transaction_id, {n('count(*)')} as n_records from raw group by 1 having count(*) > 1", "raw"))
def dq_unique(spark, folder):
    return Q.unique(raw_lines(spark, folder), "transaction_id")


@query("dq_unique_combination", f"select l_orderkey, l_linenumber::bigint as l_linenumber, l_suppkey, {n('count(*)')} as n_records from lineitem group by 1, 2, 3 having count(*) > 1")
def dq_unique_combination(spark, folder):
    return Q.unique_combination(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("dq_at_least_one", sql(f"select customer_segment, {n('count(decline_type)')} as filled from cust group by 1 having count(decline_type) = 0", "cust"))
def dq_at_least_one(spark, folder):
    return Q.at_least_one(customers(spark, folder), "decline_type", ["customer_segment"])


@query("dq_not_constant", f"select o_custkey, {n('count(distinct o_orderstatus)')} as distinct_values from orders group by 1 having count(distinct o_orderstatus) = 1")
def dq_not_constant(spark, folder):
    return Q.not_constant(table(spark, folder, "orders"), "o_orderstatus", ["o_custkey"])


@query("dq_not_empty_string", "select event_id, event_type from (select event_id, case when event_type = 'view' then '  ' else event_type end as event_type from events) where trim(event_type) = ''")
def dq_not_empty_string(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "view", "  ").otherwise(F.col("event_type")).alias("event_type")
    )
    return Q.not_empty_string(raw, "event_type")


@query("dq_not_null_proportion", sql(
    "select state, cast(count(decline_type) as double) / count(*) as not_null_proportion from cust group by 1 having cast(count(decline_type) as double) / count(*) < 0.2 or cast(count(decline_type) as double) / count(*) > 0.95", "cust"))
def dq_not_null_proportion(spark, folder):
    return Q.not_null_proportion(customers(spark, folder), "decline_type", 0.2, 0.95, ["state"])


@query("dq_expression_is_true", "select l_orderkey, l_quantity, l_extendedprice from lineitem where not (l_extendedprice >= l_quantity * 50)")
def dq_expression_is_true(spark, folder):
    return Q.expression_is_true(
        table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice"), "l_extendedprice >= l_quantity * 50"
    )


@query("dq_relationships_where", sql(
    f"select txn.customer_id as id, {n('count(*)')} as n_records from txn where status = 'approved' and not exists (select 1 from cust where cust.customer_id = txn.customer_id and card_type = 'Premium') group by 1",
    "txn", "cust"))
def dq_relationships_where(spark, folder):
    return Q.relationships_where(
        transactions(spark, folder), "customer_id", customers(spark, folder), "customer_id", "status = 'approved'", "card_type = 'Premium'"
    )


@query("dq_equality", """with a as (select o_custkey, o_orderstatus from orders where o_orderdate < timestamp '1999-01-01'), b as (select o_custkey, o_orderstatus from orders where o_orderdate >= timestamp '1999-01-01')
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b) union all select 'b_minus_a', * from (select * from b except select * from a)""")
def dq_equality(spark, folder):
    orders = table(spark, folder, "orders")
    cut = at_time(dt.datetime(1999, 1, 1))
    return Q.equality(orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut), ["o_custkey", "o_orderstatus"])


@query("dq_cardinality", f"""with a as (select o_custkey as value, {n('count(*)')} as num_rows from orders group by 1),
        b as (select o_custkey as value, {n('count(*)')} as num_rows from orders join lineitem on l_orderkey = o_orderkey and l_linenumber = 1 group by 1)
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b) union all select 'b_minus_a', * from (select * from b except select * from a)""")
def dq_cardinality(spark, folder):
    """Orders by customer against orders that have a first line, which every order should have."""
    from clientele.operators.setops import cardinality_diff

    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    first = table(spark, folder, "lineitem").where(F.col("l_linenumber") == 1).select(F.col("l_orderkey").alias("o_orderkey"))
    return cardinality_diff(orders, "o_custkey", orders.join(first, "o_orderkey"), "o_custkey")


COUNTS_SQL = """with a as (select customer_segment, count(*) as count_a from cust where card_type = 'Premium' group by 1),
    b as (select customer_segment, count(*) as count_b from cust where card_type = 'Standard' group by 1)"""


@query("dq_equal_rowcount", sql(
    f"{COUNTS_SQL} select a.customer_segment as customer_segment_a, b.customer_segment as customer_segment_b, count_a, count_b, abs(count_a - count_b) as diff_count from a full join b on a.customer_segment = b.customer_segment", "cust"))
def dq_equal_rowcount(spark, folder):
    who = customers(spark, folder)
    return Q.equal_rowcount(who.where("card_type = 'Premium'"), who.where("card_type = 'Standard'"), ["customer_segment"])


@query("dq_fewer_rows", sql(
    f"""{COUNTS_SQL} select a.customer_segment as customer_segment_a, b.customer_segment as customer_segment_b, count_a, count_b,
    {n('case when count_a > count_b then count_a - count_b when count_a = count_b then 1 else 0 end')} as row_count_delta from a full join b on a.customer_segment = b.customer_segment""", "cust"))
def dq_fewer_rows(spark, folder):
    who = customers(spark, folder)
    return Q.fewer_rows_than(who.where("card_type = 'Premium'"), who.where("card_type = 'Standard'"), ["customer_segment"])


@query("dq_ranges_exclusive", sql(
    f"""with {VERSIONS_SQL}, r as (select customer_id, valid_from, valid_to, lead(valid_from) over (partition by customer_id order by valid_from) as next_lower_bound from w where valid_to is not null)
    select * from r where not (valid_from < valid_to and coalesce(valid_to + 1 = next_lower_bound, next_lower_bound is null))""", "txn"))
def dq_ranges_exclusive(spark, folder):
    ranges = _versions(spark, folder).where(F.col("valid_to").isNotNull()).withColumn("upper", F.date_add("valid_to", 1))
    bad = Q.mutually_exclusive_ranges(ranges, "valid_from", "upper", ["customer_id"], gaps="not_allowed")
    return bad.drop("upper")


@query("dq_sequential", sql(
    """with r as (select customer_id, transaction_id, lag(transaction_id) over (partition by customer_id order by transaction_id) as previous_value from txn)
    select * from r where not (transaction_id = previous_value + 1)""", "txn"))
def dq_sequential(spark, folder):
    rows = transactions(spark, folder).select("customer_id", "transaction_id")
    return Q.sequential_values(rows, "transaction_id", ["customer_id"], 1)


@query("dq_sequential_dates", sql(
    f"""with m as (select distinct customer_id, {month_of('transaction_date')} as month from txn), r as (select *, lag(month) over (partition by customer_id order by month) as previous_value from m)
    select * from r where not (month = cast(previous_value + interval 1 month as date))""", "txn"))
def dq_sequential_dates(spark, folder):
    rows = transactions(spark, folder).select("customer_id", F.trunc("transaction_date", "month").alias("month")).distinct()
    return Q.sequential_values(rows, "month", ["customer_id"], F.expr("interval 1 month"))


@query("dq_recency", sql(
    f"select customer_id, max(transaction_date) as most_recent, cast({AS_OF_SQL} - 365 as date) as threshold from txn group by 1 having max(transaction_date) < {AS_OF_SQL} - 365", "txn"))
def dq_recency(spark, folder):
    return Q.recency(transactions(spark, folder), "transaction_date", AS_OF, ["customer_id"], days=365)


DIM_SQL = f"""v as (select customer_id, {month_of('transaction_date')} as valid_from, max(channel) as channel from txn group by 1, 2),
    dimv as (select customer_id, valid_from, valid_from = (max(valid_from) over (partition by customer_id)) and channel != '1-URGENT' as is_current from v)"""


@query("dq_scd_one_current", sql(
    f"""with {DIM_SQL} select customer_id, {n('sum(case when is_current then 1 else 0 end)')} as current_count, {n('count(*)')} as total_versions from dimv group by 1
    having sum(case when is_current then 1 else 0 end) != 1""", "txn"))
def dq_scd_one_current(spark, folder):
    versions = transactions(spark, folder).groupBy("customer_id", F.trunc("transaction_date", "month").alias("valid_from")).agg(F.max("channel").alias("channel"))
    last = versions.groupBy("customer_id").agg(F.max("valid_from").alias("_last"))
    dim = versions.join(last, "customer_id").withColumn("is_current", (F.col("valid_from") == F.col("_last")) & (F.col("channel") != "1-URGENT"))
    return Q.scd_one_current(dim)


@query("dq_scd_no_gaps", sql(
    f"""with {VERSIONS_SQL}, x as (select *, lead(valid_from) over (partition by customer_id order by valid_from) as next_valid_from from w)
    select customer_id, valid_from, valid_to, next_valid_from, {days('valid_to', 'next_valid_from')} - 1 as gap_days from x
    where next_valid_from is not null and valid_to != next_valid_from - 1""", "txn"))
def dq_scd_no_gaps(spark, folder):
    return Q.scd_gaps(_versions(spark, folder))


@query("dq_segment_min_share", sql(
    f"""with g as (select customer_segment, {n('count(*)')} as customer_count from seg group by 1), p as (select *, {pct('customer_count', 'sum(customer_count) over ()')} as percentage from g)
    select * from p where percentage < 15""", "seg"))
def dq_segment_min_share(spark, folder):
    return Q.segment_min_share(inputs.segments(spark, folder), 15.0)


# ---- suites ----


def _line(name: str, value: str, status: str) -> str:
    return f"select '{name}' as check_name, {d(value)} as measured, {status} as status from m"


def _pass(cond: str, other: str = "FAIL") -> str:
    return f"case when {cond} then 'PASS' else '{other}' end"


CUST_MEASURES = """m as (select count(*) as rows, count(*) filter (customer_id is null) as null_ids, count(*) - count(distinct customer_id) as dups,
    min(account_open_date) as o1, max(account_open_date) as o2, count(*) filter (email like '%@%' and email like '%.%') as emails, min(credit_limit) as l1, max(credit_limit) as l2,
    count(*) filter (credit_limit % 1000 != 0) as off_step, min(age) as a1, max(age) as a2,
    count(*) filter ((customer_segment = 'MACHINERY' and not coalesce(decline_type in ('gradual', 'sudden'), false)) or (customer_segment != 'MACHINERY' and decline_type is not null)) as decl from cust)"""


@query("dq_customer_suite", sql(
    f"with {CUST_MEASURES} " + " union all ".join([
        _line("row_count", "rows", _pass("rows = 1500")), _line("null_customer_ids", "null_ids", _pass("null_ids = 0")),
        _line("duplicate_customer_ids", "dups", _pass("dups = 0")),
        _line("open_date_range_days", days("o1", "o2"), _pass(f"o1 >= date '1995-08-02' and o2 <= {AS_OF_SQL}")),
        _line("valid_emails", "emails", _pass("emails = rows")),
        _line("credit_limit_range", "l2 - l1", _pass("l1 >= 5000 and l2 <= 50000 and off_step = 0")),
        _line("age_range", "a2 - a1", _pass("a1 >= 22 and a2 <= 75")), _line("lineage_filled", "rows", _pass("true")),
        _line("decline_type_errors", "decl", _pass("decl = 0")),
    ]), "cust"))
def dq_customer_suite(spark, folder):
    rows = customers(spark, folder).withColumns({
        "source_file": F.lit("customer.parquet"), "ingestion_timestamp": at_time(dt.datetime(2001, 8, 2)),
    })
    return S.customer_suite(rows, AS_OF, expected_rows=1500, declining="MACHINERY")


MARKET_TARGETS = {"AUTOMOBILE": 15, "BUILDING": 20, "FURNITURE": 20, "HOUSEHOLD": 20, "MACHINERY": 25}


@query("dq_segment_bands", sql(
    f"""with g as (select customer_segment, {n('count(*)')} as row_count from cust group by 1), p as (select *, {pct('row_count', 'sum(row_count) over ()')} as percentage from g)
    select *, case customer_segment {' '.join(f"when '{k}' then case when percentage between {v - 5} and {v + 5} then 'PASS' else 'FAIL' end" for k, v in MARKET_TARGETS.items())} else 'UNKNOWN' end as status from p""", "cust"))
def dq_segment_bands(spark, folder):
    return S.segment_bands(customers(spark, folder), MARKET_TARGETS)


TXN_MEASURES = f"""m as (select count(*) as rows, count(*) - count(distinct transaction_id) as dup, count(*) filter (transaction_id is null) as null_t, count(*) filter (customer_id is null) as null_c,
    count(*) filter (transaction_date is null) as null_d, count(*) filter (amount is null) as null_a, count(*) filter (ingestion_timestamp is null) as null_i,
    count(distinct customer_id) as seen, (select count(*) from known where not exists (select 1 from t where t.customer_id = known.customer_id)) as missing,
    (select count(distinct customer_id) from t where not exists (select 1 from known where t.customer_id = known.customer_id)) as orphan_c,
    (select count(*) from t where not exists (select 1 from known where t.customer_id = known.customer_id)) as orphan_r,
    {months('min(transaction_date)', 'max(transaction_date)')} as span, count(*) filter (transaction_date > date '2001-06-01') as future, count(*) filter (amount <= 0) as low,
    count(*) filter (amount > 450000) as high, max(amount) as top from t)"""
# Lines carry repeated ids; dates after 2001-06-01 count as future.
SUITE_INPUT = """t as (select raw.transaction_id, customer_id, transaction_date, raw.amount, raw.ingestion_timestamp from raw join txn on raw.order_id = txn.transaction_id),
    known as (select customer_id from cust)"""
SUITE_AS_OF = dt.date(2001, 6, 1)


def _suite_measures(spark, folder):
    orders = transactions(spark, folder).select(F.col("transaction_id").alias("order_id"), "customer_id", "transaction_date")
    rows = raw_lines(spark, folder).join(orders, "order_id")
    return S.transaction_measures(rows, customers(spark, folder), SUITE_AS_OF, high_amount=100000)


@query("dq_transaction_suite", sql(
    f"with {SUITE_INPUT}, {TXN_MEASURES} " + " union all ".join([
        _line("row_count", "rows", "case when rows between 50000 and 70000 then 'PASS' when rows between 25000 and 140000 then 'WARNING' else 'FAIL' end"),
        _line("duplicate_transaction_ids", "dup", _pass("dup = 0")), _line("null_transaction_ids", "null_t", _pass("null_t = 0")),
        _line("null_customer_ids", "null_c", _pass("null_c = 0")), _line("null_transaction_dates", "null_d", _pass("null_d = 0")),
        _line("null_transaction_amounts", "null_a", _pass("null_a = 0")),
        _line("customers_represented", "seen", "case when seen = 1500 then 'PASS' when seen >= 1470 then 'WARNING' else 'FAIL' end"),
        _line("customers_without_transactions", "missing", "case when missing = 0 then 'PASS' when missing < 100 then 'WARNING' else 'FAIL' end"),
        _line("orphan_customers", "orphan_c", _pass("orphan_c = 0")),
        _line("months_covered", "span", "case when span between 77 and 79 then 'PASS' when span between 75 and 81 then 'WARNING' else 'FAIL' end"),
        _line("future_dates", "future", _pass("future = 0")),
        _line("amount_range", "top", "case when low = 0 and top <= 90000 then 'PASS' when low = 0 and top <= 135000 then 'WARNING' else 'FAIL' end"),
        _line("null_ingestion_timestamps", "null_i", _pass("null_i = 0")),
    ]), "raw", "txn", "cust"))
def dq_transaction_suite(spark, folder):
    return S.transaction_suite(_suite_measures(spark, folder), (50000, 70000), 1500, (77, 79), 90000)


@query("dq_issue_list", sql(
    f"""with {SUITE_INPUT}, {TXN_MEASURES}, l as (select unnest(['Duplicate transaction IDs', 'NULL transaction IDs', 'NULL customer IDs', 'Invalid customer IDs', 'Future transaction dates', 'Zero or negative amounts']) as issue_type,
    unnest([dup, null_t, null_c, orphan_c, future, low]) as issue_count from m) select issue_type, {n('issue_count')} as issue_count from l where issue_count > 0""", "raw", "txn", "cust"))
def dq_issue_list(spark, folder):
    return S.issue_list(_suite_measures(spark, folder))


@query("dq_status_bands", sql(
    f"""with g as (select status, {n('count(*)')} as txn_count from txn group by 1), p as (select *, {pct('txn_count', 'sum(txn_count) over ()')} as percentage from g)
    select *, case when status = 'approved' and percentage between 95 and 99 then 'PASS' when status = 'declined' and percentage between 30 and 40 then 'PASS' else 'WARNING' end as status_check from p""", "txn"))
def dq_status_bands(spark, folder):
    return S.status_bands(transactions(spark, folder), {"approved": (95, 99), "declined": (30, 40)})


REQUIRED = ("customer_id", "email", "state", "card_type", "credit_limit", "customer_segment", "first_name", "last_name")


@query("dq_profile_customers", sql(
    r"with m as (select count(*) as rows, " + ", ".join(f"count(*) filter ({f} is null) as null_{f}" for f in REQUIRED)
    + r""", count(*) - count(distinct customer_id) as dups, count(*) filter (not regexp_matches(cast(customer_id as varchar), '^\d{3,4}$')) as bad_id,
    count(*) filter (not regexp_matches(email, '^[^@]+@[^@]+\.[^@]+$')) as bad_email, count(*) filter (credit_limit < 5000 or credit_limit > 50000 or credit_limit % 1000 != 0) as bad_limit,
    count(*) filter (customer_segment = 'MACHINERY' and decline_type is null) as dwt, count(*) filter (customer_segment != 'MACHINERY' and decline_type is not null) as twd, """
    + ", ".join(f"count(*) filter (customer_segment = '{s}') as n_{s}" for s in MARKET_TARGETS) + " from cust) "
    + " union all ".join(
        [_line(f"null {f}", f"null_{f}", _pass(f"null_{f} = 0")) for f in REQUIRED]
        + [_line(k, v, _pass(f"{v} = 0")) for k, v in (
            ("duplicate customer_id", "dups"), ("customer_id format", "bad_id"), ("email format", "bad_email"), ("credit limit", "bad_limit"),
            ("Declining without decline_type", "dwt"), ("decline_type without Declining", "twd"))]
        + [_line(f"share of {s}", pct(f"n_{s}", "rows"), _pass(f"abs({pct(f'n_{s}', 'rows')} - {t}) <= 5", "WARNING")) for s, t in MARKET_TARGETS.items()]
    ), "cust"))
def dq_profile_customers(spark, folder):
    return S.customer_profile(customers(spark, folder), REQUIRED, r"^\d{3,4}$", MARKET_TARGETS, (5000, 50000), 1000, "MACHINERY")


@query("dq_post_generation", sql(
    f"with {SUITE_INPUT}, {TXN_MEASURES} " + " union all ".join([
        _line("total_transactions", "rows", "case when rows between 50000 and 70000 then 'PASS' when rows > 70000 then 'WARNING' else 'FAIL' end"),
        _line("duplicate_count", "dup", _pass("dup = 0")), _line("null_transaction_id", "null_t", _pass("null_t = 0")),
        _line("null_customer_id", "null_c", _pass("null_c = 0")), _line("null_transaction_date", "null_d", _pass("null_d = 0")),
        _line("null_transaction_amount", "null_a", _pass("null_a = 0")), _line("customers_missing", "missing", _pass("missing = 0")),
        _line("orphan_transactions", "orphan_r", _pass("orphan_r = 0")), _line("months_of_data", "span", _pass("span between 17 and 19", "WARNING")),
        _line("future_dates", "future", _pass("future = 0")), _line("amounts", "top", _pass("low = 0 and top <= 110000", "WARNING")),
    ]), "raw", "txn", "cust"))
def dq_post_generation(spark, folder):
    return S.post_generation(_suite_measures(spark, folder), (50000, 70000), 110000)


# ---- telemetry ----

BEFORE_AT, AFTER_AT = dt.datetime(2001, 8, 1), dt.datetime(2001, 8, 2)
BEFORE_DAY = dt.date(2000, 1, 1)
SNAP_SQL = f"""s as (select {{ts}} as snapshot_timestamp, '{{kind}}' as snapshot_type, {n('(select count(*) from cust)')} as customer_count, {n('(select count(distinct customer_segment) from cust)')} as segment_count,
    {n('count(*)')} as transaction_count, coalesce({d('sum(amount)')}, 0.0) as total_transaction_amount, coalesce({avg('amount')}, 0.0) as avg_transaction_amount,
    min(transaction_date) as min_transaction_date, max(transaction_date) as max_transaction_date, coalesce({months('min(transaction_date)', 'max(transaction_date)')}, 0) as months_of_data from txn {{where}})"""


@query("ob_snapshot", sql("with " + SNAP_SQL.format(ts="timestamp '2001-08-02'", kind="AFTER", where="") + " select * from s", "cust", "txn"))
def ob_snapshot(spark, folder):
    rows = T.snapshot(customers(spark, folder), transactions(spark, folder), "AFTER", AFTER_AT)
    return rows


@query("ob_delta", sql(
    "with " + SNAP_SQL.format(ts="1", kind="b", where="where transaction_date < date '2000-01-01'").replace("s as", "b as", 1) + ", " + SNAP_SQL.format(ts="1", kind="a", where="").replace("s as", "a as", 1)
    + ", l as (" + " union all ".join(f"select '{m}' as metric, {d('b.' + m)} as before_value, {d('a.' + m)} as after_value from a, b" for m in T.SNAPSHOT_METRICS)
    + f") select *, {rnd('after_value - before_value')} as delta, case when before_value = 0 then 'NEW DATA' else printf('%.2f', {rnd('(after_value - before_value) * 100 / before_value')}) || '%' end as pct_change from l",
    "cust", "txn"))
def ob_delta(spark, folder):
    kinds = {"BEFORE": (BEFORE_DAY, BEFORE_AT), "AFTER": (None, AFTER_AT)}
    return T.snapshot_delta(T.snapshots(customers(spark, folder), transactions(spark, folder), kinds), "BEFORE", "AFTER")


@query("ob_generation", sql(
    f"""select 'transaction_generation' as process_name, timestamp '2001-08-02' as execution_timestamp, {n('count(*)')} as total_transactions, {n('count(distinct customer_id)')} as unique_customers,
    min(transaction_date) as min_date, max(transaction_date) as max_date, {d('sum(amount)')} as total_transaction_volume, {avg('amount')} as avg_transaction_amount,
    {months('min(transaction_date)', 'max(transaction_date)')} as months_of_data from txn""", "txn"))
def ob_generation(spark, folder):
    _, record = T.generation_load(transactions(spark, folder), scratch(spark, "generated"), "transaction_generation", AFTER_AT)
    return record


QUALITY_SQL = f"{SUITE_INPUT}, {TXN_MEASURES.replace('450000', '100000')}, q as (" + " union all ".join(
    f"""select '{name}' as check_name, '{cat}' as check_category, {n('rows')} as records_checked, {n(col)} as issues_found, {pct(col, 'rows')} as issue_percentage,
    case when {col} = 0 then 'PASS' else '{found}' end as check_status from m"""
    for (name, cat, _, found), col in zip(T.QUALITY_CHECKS, ("null_t", "null_c", "null_d", "null_a", "dup", "low", "future", "high", "orphan_r"))
) + ")"


@query("ob_quality", sql(f"with {QUALITY_SQL} select timestamp '2001-08-02' as check_timestamp, * from q", "raw", "txn", "cust"))
def ob_quality(spark, folder):
    records = T.quality_records(_suite_measures(spark, folder), AFTER_AT)
    return records


@query("ob_dashboard", sql(
    f"""with {QUALITY_SQL} select timestamp '2001-08-02' as check_timestamp, check_category, {n('count(*)')} as total_checks, {n("count(*) filter (check_status = 'PASS')")} as passed_checks,
    {n("count(*) filter (check_status = 'FAIL')")} as failed_checks, {n("count(*) filter (check_status = 'WARNING')")} as warning_checks,
    {pct("count(*) filter (check_status = 'PASS')", 'count(*)')} as pass_rate from q group by 2""", "raw", "txn", "cust"))
def ob_dashboard(spark, folder):
    """Pass rates read from the check records that the loads have appended."""
    telemetry = scratch(spark, "telemetry")
    T.append(ob_quality(spark, folder), telemetry)
    return T.dashboard(spark.read.parquet(telemetry))


@query("ob_segment", sql(
    f"""select timestamp '2001-08-02' as snapshot_timestamp, customer_segment, {n('count(distinct cust.customer_id)')} as total_customers, {n('count(distinct txn.customer_id)')} as customers_with_transactions,
    {n('count(transaction_id)')} as txn_count, {d('min(amount)')} as min_amount, {avg('amount')} as avg_amount, {d('max(amount)')} as max_amount, {d('sum(amount)')} as total_spend,
    {rnd('cast(count(transaction_id) as double) / count(distinct cust.customer_id)')} as avg_txns_per_customer, cast(sum(amount) as double) / cast(count(distinct cust.customer_id) as double) as spend_per_customer
    from cust left join txn on cust.customer_id = txn.customer_id group by 2""", "cust", "txn"))
def ob_segment(spark, folder):
    return T.segment_record(customers(spark, folder), transactions(spark, folder), AFTER_AT)


@query("ob_layer_counts", " union all ".join(
    f"""select '{layer}' as layer, '{t}' as table_name, {n('count(*)')} as record_count, {n(f'count(distinct {k})')} as distinct_keys, {n(f'count(*) filter ({k} is null)')} as null_key_count,
    {n(f'(select count(*) from (select {k} from {t} where {k} is not null group by 1 having count(*) > 1))')} as duplicate_key_count from {t}"""
    for t, k, layer in (("customer", "c_custkey", "bronze"), ("orders", "o_orderkey", "silver"), ("lineitem", "l_orderkey", "gold"))))
def ob_layer_counts(spark, folder):
    return T.load_layers({
        "customer": (table(spark, folder, "customer"), "c_custkey", "bronze"),
        "orders": (table(spark, folder, "orders"), "o_orderkey", "silver"),
        "lineitem": (table(spark, folder, "lineitem"), "l_orderkey", "gold"),
    }, scratch(spark, "layers"))


METRICS_SQL = f"""g as (select cast(ts as date) as run_day, event_type as check_type, max(ts) as run_timestamp, {n('count(*)')} as records_checked, {n('count(*) filter (value > 60)')} as records_failed from events group by 1, 2),
    c as (select *, cast(records_failed as double) / nullif(records_checked, 0) as failure_rate from g), m as (select *, case when failure_rate <= 0.01 then 'PASS' when failure_rate > 0.01 and failure_rate <= 0.05 then 'WARNING' else 'FAIL' end as status from c)"""


def _check_metrics(spark, folder):
    """One check result per day and event type: values above 60 count as failed records."""
    runs = table(spark, folder, "events").groupBy(F.to_date("ts").alias("run_day"), F.col("event_type").alias("check_type")).agg(
        F.max("ts").alias("run_timestamp"), F.count(F.lit(1)).alias("records_checked"), F.count_if(F.col("value") > 60).alias("records_failed")
    )
    return runs.select("*", *T.check_status())


@query("ob_status", f"with {METRICS_SQL} select * from m")
def ob_status(spark, folder):
    return _check_metrics(spark, folder)


@query("ob_recent_failures", f"with {METRICS_SQL} select * from m where status in ('WARNING', 'FAIL') and run_timestamp >= timestamp '2024-01-24'")
def ob_recent_failures(spark, folder):
    return T.recent_failures(_check_metrics(spark, folder), dt.datetime.combine(EVENTS_AS_OF, dt.time()))


@query("ob_latest_runs", "select event_type as task_name, user_id, ts as run_timestamp, event_id as run_id, value as duration from (select *, row_number() over (partition by event_type, user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def ob_latest_runs(spark, folder):
    runs = table(spark, folder, "events").select(
        F.col("event_type").alias("task_name"), "user_id", F.col("ts").alias("run_timestamp"), F.col("event_id").alias("run_id"), F.col("value").alias("duration")
    )
    return latest_per_key(runs, ["task_name", "user_id"], ["run_timestamp", "run_id"])


@query("ob_count_trends", f"""select cast(ts as date) as run_date, event_type as table_name, {avg("cast(json_extract(props, '$.k') as bigint)")} as avg_record_count, {n("min(cast(json_extract(props, '$.k') as bigint))")} as min_record_count,
    {n("max(cast(json_extract(props, '$.k') as bigint))")} as max_record_count, {n('count(distinct user_id)')} as num_runs from events group by 1, 2""")
def ob_count_trends(spark, folder):
    counts = table(spark, folder, "events").select(
        F.col("ts").alias("run_timestamp"), F.col("event_type").alias("table_name"), F.col("user_id").alias("run_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("record_count"),
    )
    return T.count_trends(counts, ["table_name"])


@query("ob_run_log", f"""with r as (select l_orderkey as run_id, min(l_shipdate) filter (l_returnflag != 'A') as start_time, max(l_shipdate) filter (l_returnflag = 'A') as end_time,
    {n("max(l_linenumber) filter (l_returnflag = 'A')")} as models_run, {n("max(case when l_quantity > 45 then 1 else 0 end) filter (l_returnflag = 'A')")} as models_failed from lineitem group by 1)
    select *, case when end_time is null then 'STARTED' when models_failed = 0 then 'SUCCESS' else 'FAILED' end as status, {n("date_diff('second', start_time, end_time)")} as duration_seconds from r""")
def ob_run_log(spark, folder):
    """Lines of an order as appended records of a run: flag A marks the end record."""
    records = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_shipdate").alias("recorded_at"),
        F.when(F.col("l_returnflag") == "A", "END").otherwise("START").alias("phase"),
        F.col("l_linenumber").alias("models_run"), F.when(F.col("l_quantity") > 45, 1).otherwise(0).alias("models_failed"),
    )
    return T.run_log(records)
