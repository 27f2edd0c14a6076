"""Sources, sinks, layouts, incremental loads and streams.

Files are written from the given tables into the shared scratch folder and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.columns import MONEY
from clientele.functions.dates import at_time, months_before
from clientele.operators.customer import monthly_spending
from clientele.operators.dedupe import latest_per_key
from clientele.plans.catalog import query
from clientele.plans.changes import CHANGE_ORDER, FACT_SQL, fact_changes, order_target
from clientele.plans.customer import AUDIENCE_SQL
from clientele.plans.oracle import avg, d, month_of, n, rnd, sql
from clientele.session import fresh_table, scratch
from clientele.sources import files, sinks
from clientele.sources.roles import customers, raw_lines, table, transactions
from clientele.streaming import feeds

# ---- sources ----

CSV_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("transaction_date", T.TimestampNTZType()), T.StructField("amount", MONEY),
    T.StructField("channel", T.StringType()), T.StructField("status", T.StringType()),
])


def _csv_files(spark, folder):
    """Orders as gzipped CSV with padded values and NULL texts."""
    path = scratch(spark, "orders-csv")
    table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", "NULL").otherwise(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("channel"),
        F.when(F.col("o_orderstatus") == "P", "null").otherwise(F.col("o_orderstatus")).alias("status"),
    ).write.option("header", True).option("quoteAll", True).option("compression", "gzip").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("src_csv_positional", f"""select o_orderkey as transaction_id, o_custkey as customer_id, o_orderdate as transaction_date, o_totalprice as amount,
    nullif(o_orderpriority, '5-LOW') as channel, nullif(o_orderstatus, 'P') as status, true as has_source, true as has_row_number from orders""")
def src_csv_positional(spark, folder):
    loaded = files.read_csv_positional(spark, _csv_files(spark, folder), CSV_SCHEMA, pattern="*.csv.gz", row_number=True)
    return loaded.withColumns({
        "has_source": F.col("source_file").contains(".csv"), "has_row_number": F.col("file_row_number") >= 1,
    }).drop("source_file", "file_row_number")


@query("src_parquet_named", "select c_custkey::varchar as customer_id, c_name as full_name, cast(c_acctbal as decimal(10,2))::double as credit_limit, c_nationkey::bigint as nation, true as has_source from customer")
def src_parquet_named(spark, folder):
    loaded = files.read_parquet_named(spark, f"{folder}/customer.parquet", {
        "customer_id": ("c_custkey", "string"), "full_name": ("c_name", "string"), "credit_limit": ("c_acctbal", "decimal(10,2)"),
        "nation": ("c_nationkey", "int"),
    })
    return loaded.withColumn("has_source", F.col("source_file").endswith(".parquet")).drop("source_file")


@query("src_load_once", f"select event_type, {n('count(*)')} as loaded_rows, {n('count(distinct event_id)')} as distinct_rows from events group by 1")
def src_load_once(spark, folder):
    target, checkpoint = scratch(spark, "landing"), scratch(spark, "landing-checkpoint")
    schema = table(spark, folder, "events").schema
    for _ in range(2):  # the second run finds no new file
        files.load_once(spark, feeds.location(folder, "events"), schema, target, checkpoint, "*.parquet")
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.count_distinct("event_id").alias("distinct_rows")
    )


@query("src_fail_fast", """select event_id, case when event_type = 'error' then null else value end as value, user_id, case when event_type = 'error' then event_id || ',n/a,' || user_id end as rejected from events""")
def src_fail_fast(spark, folder):
    """Continue-on-error load: lines with a value that does not fit are kept aside as they stand in the file."""
    path = scratch(spark, "events-csv")
    table(spark, folder, "events").select(
        F.col("event_id").cast("string"), F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.col("user_id").cast("string"),
    ).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("user_id", T.LongType())])
    return files.read_csv_quarantine(spark, path, schema)


@query("src_quarantine_lines", """with o as (select *, o_orderkey % 10 as k, o_orderkey || ',' || o_custkey || ',' as head from orders)
    select o_orderkey as order_id, case when k != 1 then o_custkey end as customer_id, case when k != 1 then o_orderpriority end as priority,
    case k when 1 then o_orderkey || '' when 2 then head || '"' || o_orderpriority when 3 then head || o_orderpriority || ',surplus' end as rejected from o""")
def src_quarantine_lines(spark, folder):
    """Lines with too few fields, with too many, or with a quote that stays open keep their text; all others are loaded."""
    path = scratch(spark, "orders-lines")
    kind = F.col("o_orderkey") % 10
    plain = F.concat_ws(",", "o_orderkey", "o_custkey")
    line = (
        F.when(kind == 1, F.col("o_orderkey").cast("string")).when(kind == 2, F.concat(plain, F.lit(',"'), "o_orderpriority"))
        .when(kind == 3, F.concat(plain, F.lit(","), "o_orderpriority", F.lit(",surplus"))).otherwise(F.concat(plain, F.lit(","), "o_orderpriority"))
    )
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()), T.StructField("priority", T.StringType())])
    return files.read_csv_quarantine(spark, path, schema, header=False)


@query("src_abort_on_error", f"""select 'clean' as load, 'loaded' as outcome, {n('count(*)')} as n_rows from events union all
    select 'broken', case when count(*) filter (event_type = 'error') > 0 then 'aborted' else 'loaded' end, {n("case when count(*) filter (event_type = 'error') > 0 then 0 else count(*) end")} from events""")
def src_abort_on_error(spark, folder):
    """Abort-on-error load: one value that does not fit ends the load, and nothing of it is kept."""
    events = table(spark, folder, "events")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    value = F.col("value").cast("string")
    out = None
    for name, shown in (("clean", value), ("broken", F.when(F.col("event_type") == "error", "n/a").otherwise(value))):
        source = scratch(spark, f"{name}-csv")
        events.select(F.col("event_id").cast("string"), shown.alias("value")).write.option("header", True).csv(source)
        loaded = files.load_or_abort(spark, source, schema, scratch(spark, f"{name}-loaded"))
        rows = events.where(F.lit(False)) if loaded is None else loaded
        row = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("load"), F.lit("aborted" if loaded is None else "loaded").alias("outcome"), "n_rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


def _padded(*cells: tuple[str, int]):
    return F.concat(*[F.rpad(F.coalesce(c if not isinstance(c, str) else F.col(c), F.lit("")), size, " ") for c, size in cells])


def _feed_lines(spark, folder):
    """Suppliers as company, orders as financial and parts as security records of the fixed-width feed."""
    head = (F.lit(""), 7)
    company = table(spark, folder, "supplier").select(_padded(
        head, (F.lit("20010802-101500"), 15), (F.lit("CMP"), 3), (F.col("s_name"), 60), (F.col("s_suppkey").cast("string"), 10), (F.lit("ACTV"), 4),
        (F.lit("HR"), 2), (F.lit("AAA"), 4), (F.when(F.col("s_acctbal") < 0, "unknown").otherwise("19630101"), 8), (F.lit("Main Street"), 80),
        (F.lit(""), 80), (F.lit("12345"), 12), (F.lit("Town"), 25), (F.col("s_nationkey").cast("string"), 20), (F.lit("Land"), 24), (F.lit("Chief"), 46), (F.lit("Seller"), 150),
    ).alias("value"))
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    financial = table(spark, folder, "orders").select(_padded(
        head, (F.date_format("o_orderdate", "yyyyMMdd-HHmmss"), 15), (F.lit("FIN"), 3), (F.date_format("o_orderdate", "yyyy"), 4), (F.quarter("o_orderdate").cast("string"), 1),
        (F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyyMMdd"), 8), (F.date_format("o_orderdate", "yyyyMMdd"), 8), (price, 17), (price, 17),
        (F.lit("1.25"), 12), (F.lit("1.20"), 12), (F.lit("0.30"), 12), (F.lit("100.00"), 17), (price, 17), (F.lit("5.50"), 17),
        (F.col("o_custkey").cast("string"), 13), (F.lit("10"), 13), (F.col("o_orderkey").cast("string"), 10),
    ).alias("value"))
    security = table(spark, folder, "part").select(_padded(
        head, (F.lit("20010802-120000"), 15), (F.lit("SEC"), 3), (F.concat(F.lit("P"), F.col("p_partkey").cast("string")), 15), (F.lit("COMMON"), 6), (F.lit("ACTV"), 4), (F.col("p_name"), 70),
        (F.lit("NYSE"), 6), (F.col("p_size").cast("string"), 13), (F.lit("19990104"), 8), (F.lit("19990105"), 8), (F.col("p_retailprice").cast("decimal(10,2)").cast("string"), 12), (F.col("p_brand"), 10),
    ).alias("value"))
    return company.unionByName(financial).unionByName(security)


def _feed(spark, folder):
    path = scratch(spark, "feed")
    _feed_lines(spark, folder).write.text(path)
    return path


@query("src_fixed_width", f"""select 'FIN' as rec_type, strftime(o_orderdate, '%Y') as year, quarter(o_orderdate)::varchar as quarter, {n('count(*)')} as n_records, {d('sum(cast(o_totalprice as decimal(18,2)))')} as total_revenue from orders group by 2, 3
    union all select 'CMP', null, null, {n('count(*)')}, null from supplier union all select 'SEC', null, null, {n('count(*)')}, null from part""")
def src_fixed_width(spark, folder):
    feed = files.read_fixed_width(spark, _feed(spark, folder))
    is_fin = F.col("rec_type") == "FIN"
    return feed.groupBy("rec_type", F.when(is_fin, F.col("year")).alias("year"), F.when(is_fin, F.col("quarter")).alias("quarter")).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.when(is_fin, F.col("revenue").try_cast(MONEY))).alias("total_revenue")
    )


@query("src_path_partition", f"select '1997' as year, quarter(o_orderdate)::varchar as quarter, {d('sum(cast(o_totalprice as decimal(18,2)))')} as total_revenue from orders where year(o_orderdate) = 1997 and quarter(o_orderdate) = 2 group by 2")
def src_path_partition(spark, folder):
    """The feed rewritten once into year / quarter folders; the filter then reads one folder."""
    path = scratch(spark, "feed-by-quarter")
    fin = files.split_records(files.read_fixed_width(spark, _feed(spark, folder)))["FIN"]
    sinks.write_partitioned(fin.withColumns({"year": F.col("year").cast("int"), "quarter": F.col("quarter").cast("int")}), path, "year", more=["quarter"])
    one = spark.read.parquet(path).where((F.col("year") == 1997) & (F.col("quarter") == 2))
    return one.groupBy(F.col("year").cast("string").alias("year"), F.col("quarter").cast("string").alias("quarter")).agg(F.sum("revenue").alias("total_revenue"))


@query("src_record_split", f"""select 'CMP' as rec_type, s_suppkey::varchar as id, s_name as label, cast(timestamp '2001-08-02 10:15:00' as timestamp) as pts, case when s_acctbal < 0 then null else date '1963-01-01' end as day, null::double as amount, 'ACTV' as status from supplier
    union all select 'FIN', o_orderkey::varchar, quarter(o_orderdate)::varchar, o_orderdate, cast(o_orderdate as date), o_totalprice, null from orders
    union all select 'SEC', 'P' || p_partkey, p_name, timestamp '2001-08-02 12:00:00', date '1999-01-04', p_retailprice, 'ACTV' from part""")
def src_record_split(spark, folder):
    parts = files.split_records(files.read_fixed_width(spark, _feed(spark, folder)))
    company = parts["CMP"].select("rec_type", F.col("cik").alias("id"), F.col("company_name").alias("label"), "pts", F.col("founding_date").alias("day"), F.lit(None).cast("double").alias("amount"), "status")
    financial = parts["FIN"].select("rec_type", F.col("co_name_or_cik").alias("id"), F.col("quarter").cast("string").alias("label"), "pts", F.col("posting_date").alias("day"), F.col("revenue").cast("double").alias("amount"), F.lit(None).cast("string").alias("status"))
    security = parts["SEC"].select("rec_type", F.col("symbol").alias("id"), F.col("name").alias("label"), "pts", F.col("first_trade_date").alias("day"), F.col("dividend").cast("double").alias("amount"), "status")
    return company.unionByName(financial).unionByName(security)


@query("src_variant_paths", "select o_orderkey, year(o_orderdate)::bigint as year, o_totalprice as price, o_orderpriority as priority, o_orderstatus as status from orders")
def src_variant_paths(spark, folder):
    """Orders kept as one semi-structured column, read through a view of typed paths."""
    path = scratch(spark, "raw-history")
    files.variant_column(table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))).write.parquet(path)
    return files.variant_paths(spark.read.parquet(path), {
        "o_orderkey": ("$.o_orderkey", "bigint"), "year": ("$.year", "int"), "price": ("$.o_totalprice", "double"),
        "priority": ("$.o_orderpriority", "string"), "status": ("$.o_orderstatus", "string"),
    })


# ---- sinks ----


@query("snk_parquet_unload", f"select l_returnflag, l_linestatus, {n('count(*)')} as n_rows, {d('sum(cast(l_quantity as decimal(18,2)))')} as quantity from lineitem group by 1, 2")
def snk_parquet_unload(spark, folder):
    path = scratch(spark, "unload")
    totals = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_quantity").cast(MONEY)).alias("quantity")
    )
    sinks.unload_parquet(totals, path)
    return spark.read.parquet(path)


@query("snk_csv_export", sql(
    f"""select customer_id::varchar as "Customer Id", full_name as "Full Name", printf('%.1f', {rnd('churn_risk_score', 1)}) || '%' as "Churn Risk Score", case when lifetime_value >= 1000 then '$' || format('{{:,}}', cast({rnd('lifetime_value', 0)} as bigint)) else '$' || printf('%.2f', lifetime_value) end as "Lifetime Value",
    strftime(last_transaction_date, '%Y-%m-%d') as "Last Transaction Date" from profile where {AUDIENCE_SQL}""", "profile"))
def snk_csv_export(spark, folder):
    from clientele.plans.customer import _audience

    path = scratch(spark, "audience-csv")
    columns = ("customer_id", "full_name", "churn_risk_score", "lifetime_value", "last_transaction_date")
    sinks.export_csv(_audience(spark, folder).select(*columns), path)
    return spark.read.option("header", True).csv(path)


@query("snk_table_overwrite", f"select o_orderpriority, {n('count(*)')} as n_orders from orders group by 1")
def snk_table_overwrite(spark, folder):
    path = scratch(spark, "rebuilt")
    orders = table(spark, folder, "orders")
    sinks.rebuild(orders.where(F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders")), path)
    return sinks.rebuild(orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders")), path)


@query("snk_validated_commit", f"select 'orders' as load, 'published' as outcome, {n('count(*)')} as n_rows from orders union all select 'lineitem', 'rejected', 0::bigint")
def snk_validated_commit(spark, folder):
    """Orders pass the checks and are published; lines repeat their key and are rejected."""
    good, bad = fresh_table(spark, "published"), fresh_table(spark, "rejected")
    orders, items = transactions(spark, folder), table(spark, folder, "lineitem")
    found = sinks.publish_validated(orders, good, "transaction_id", ["transaction_id", "customer_id"], expected_rows=orders.count())
    outcome = "published"
    try:
        sinks.publish_validated(items, bad, "l_orderkey", ["l_orderkey"], expected_rows=items.count())
    except sinks.ValidationFailed:
        outcome = "rejected"
    published = sinks.read_published(spark, good).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("orders").alias("load"), F.lit("published" if found["repeated_keys"] == 0 else "rejected").alias("outcome"), "n_rows"
    )
    return published.unionByName(spark.range(1).select(F.lit("lineitem").alias("load"), F.lit(outcome).alias("outcome"), F.lit(0).cast("bigint").alias("n_rows")))


# ---- layouts ----


@query("lay_sorted_copy", f"select o_orderkey, o_custkey, o_totalprice from orders where o_orderdate = timestamp '1998-05-28'")
def lay_sorted_copy(spark, folder):
    copy = sinks.sorted_copy(table(spark, folder, "orders"), scratch(spark, "orders-by-date"), ["o_orderdate", "o_custkey"])
    day = at_time(dt.datetime(1998, 5, 28))
    return copy.where(F.col("o_orderdate") == day).select("o_orderkey", "o_custkey", "o_totalprice")


@query("lay_projection_copy", f"select l_partkey as page_id, {n('count(*)')} as n_rows, {avg('cast(l_extendedprice as decimal(18,2))')} as avg_value from lineitem where l_partkey = 100 group by 1")
def lay_projection_copy(spark, folder):
    copy = sinks.narrow_copy(
        table(spark, folder, "lineitem"), scratch(spark, "by-part"), ["l_shipdate", "l_partkey", "l_extendedprice"], "l_partkey"
    )
    price = F.col("l_extendedprice").cast(MONEY)
    return copy.where(F.col("l_partkey") == 100).groupBy(F.col("l_partkey").alias("page_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.sum(price).cast("double") / F.count(price).cast("double")).alias("avg_value")
    )


@query("lay_bucketed_join", sql(
    f"""select cust.customer_id, card_type, state, {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend from txn join cust using (customer_id) group by 1, 2, 3""", "txn", "cust"))
def lay_bucketed_join(spark, folder):
    """Orders and customers as copies dealt by customer: their join and the grouping by customer run without a shuffle."""
    return bucketed_join(spark, folder, buckets=16)


def bucketed_join(spark, folder, buckets):
    txn = transactions(spark, folder).select("customer_id", "transaction_id", "amount")
    who = customers(spark, folder).select("customer_id", "card_type", "state")
    facts = sinks.bucketed_copy(txn, fresh_table(spark, "orders_by_customer"), "customer_id", buckets)
    dims = sinks.bucketed_copy(who, fresh_table(spark, "customers_by_customer"), "customer_id", buckets)
    return facts.join(dims.hint("merge"), "customer_id").groupBy("customer_id", "card_type", "state").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_spend")
    )


# ---- incremental loads ----


@query("inc_high_watermark", sql(
    """select transaction_id, customer_id, cast(amount as double) as amount from txn where ingestion_timestamp > (select max(ingestion_timestamp) from txn where status = 'approved' and transaction_date < date '2001-01-01')""", "txn"))
def inc_high_watermark(spark, folder):
    source = transactions(spark, folder)
    loaded = source.where((F.col("status") == "approved") & (F.col("transaction_date") < F.lit(dt.date(2001, 1, 1))))
    return sinks.above_watermark(source, loaded, "ingestion_timestamp").select("transaction_id", "customer_id", "amount")


@query("inc_lookback_merge", sql(
    f"select customer_id, month, {d('total_spend')} as total_spend, transaction_count from monthly", "monthly"))
def inc_lookback_merge(spark, folder):
    """A monthly table with a stale tail, repaired by recomputing the last two months and what came after."""
    name = fresh_table(spark, "monthly")
    columns = ("customer_id", "total_spend", "transaction_count", "month")
    txn, day = transactions(spark, folder), F.col("transaction_date")
    known = txn.where((day < F.lit(dt.date(2001, 4, 1))) | ((day < F.lit(dt.date(2001, 7, 1))) & (F.col("channel") != "1-URGENT")))
    stale = sinks.create_partitioned(monthly_spending(known).select(*columns), name, "month")
    last = stale.agg(F.max("month")).first()[0]
    since = months_before(last, 2)
    recent = monthly_spending(txn.where(day >= F.lit(since))).select(*columns)
    # Months of the window that get no row any more are emptied.
    window = spark.table(name).where(F.col("month") >= F.lit(since)).select("month")
    sinks.overwrite_partitions(recent, name, "month", touched=window)
    return spark.table(name).select(*columns)


@query("inc_upsert_partitions", sql(
    f"""select coalesce(b.transaction_id, t.transaction_id) as transaction_id, {d('coalesce(b.amount, t.amount)')} as amount, coalesce(b.channel, t.channel) as channel
    from (select * from txn where transaction_date < date '2001-06-15') t full join (select transaction_id, amount + 5 as amount, 'late' as channel from txn where transaction_date >= date '2001-05-10') b on t.transaction_id = b.transaction_id""", "txn"))
def inc_upsert_partitions(spark, folder):
    name = fresh_table(spark, "orders_by_month")
    txn, day = transactions(spark, folder).withColumn("month", F.trunc("transaction_date", "month")), F.col("transaction_date")
    columns = ("transaction_id", "amount", "channel", "month")
    sinks.create_partitioned(txn.where(day < F.lit(dt.date(2001, 6, 15))).select(*columns), name, "month")
    batch = txn.where(day >= F.lit(dt.date(2001, 5, 10))).select(
        "transaction_id", (F.col("amount") + 5).cast(MONEY).alias("amount"), F.lit("late").alias("channel"), "month", "ingestion_timestamp"
    )
    sinks.upsert_table(spark, name, batch, ["transaction_id"], ["ingestion_timestamp"], "month")
    return spark.table(name).select("transaction_id", "amount", "channel")


# ---- streams ----

@query("stm_append_stage", f"select event_type, {n('count(*)')} as n_rows, {d('sum(cast(value as decimal(18,2)))')} as total from events group by 1")
def stm_append_stage(spark, folder):
    target, checkpoint = scratch(spark, "stage"), scratch(spark, "stage-checkpoint")
    stream = feeds.file_stream(spark, feeds.location(folder, "events"), table(spark, folder, "events").schema)
    feeds.append_landing(stream, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("value").cast(MONEY)).alias("total")
    )


@query("stm_fact_upsert", sql(f"with {FACT_SQL} select * from applied", "txn"))
def stm_fact_upsert(spark, folder):
    """The change batch delivered as files in about four micro-batches, stored as deltas; the job folds the first three into the
    table, the rest is merged on read."""
    arriving, deltas, checkpoint = scratch(spark, "changes"), scratch(spark, "deltas"), scratch(spark, "deltas-checkpoint")
    batch = fact_changes(spark, folder)
    batch.write.parquet(arriving)
    files_each = max(1, -(-len(spark.read.parquet(arriving).inputFiles()) // 4))
    stream = feeds.file_stream(spark, arriving, batch.schema, files_per_batch=files_each)
    feeds.collect_changes(stream, deltas, checkpoint, ["transaction_id"], CHANGE_ORDER).awaitTermination()
    merge = (["transaction_id"], CHANGE_ORDER, ["amount", "transaction_date", "status"], "action")
    kept = spark.read.parquet(deltas)
    table_ = feeds.compact_deltas(feeds.Compacted(order_target(spark, folder)), kept.where("batch_id < 3"), scratch(spark, "compacted"), *merge)
    return feeds.state_of(table_, kept, *merge)


@query("stm_late_months", sql(f"select {month_of('transaction_date')} as month, {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend from txn group by 1", "txn"))
def stm_late_months(spark, folder):
    """The feed is not in time order: totals are kept per batch and added up, so no row is too late and no state grows."""
    target, checkpoint = scratch(spark, "months"), scratch(spark, "months-checkpoint")
    stream = feeds.file_stream(spark, feeds.location(folder, "orders"), table(spark, folder, "orders").schema)

    def totals(batch):
        return batch.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
            F.count(F.lit(1)).alias("txn_count"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("total_spend")
        )

    feeds.keep_partials(stream, target, checkpoint, totals).awaitTermination()
    return spark.read.parquet(target).groupBy("month").agg(F.sum("txn_count").alias("txn_count"), F.sum("total_spend").alias("total_spend"))


@query("stm_dedupe_keyed", "select distinct l_orderkey * 10 + l_linenumber as transaction_id from lineitem")
def stm_dedupe_keyed(spark, folder):
    """Deltas of one row per key and batch, merged on read: re-deliveries may come at any time without a growing state."""
    deltas, checkpoint = scratch(spark, "deduped"), scratch(spark, "deduped-checkpoint")
    stream = feeds.file_stream(spark, feeds.location(folder, "lineitem"), table(spark, folder, "lineitem").schema)
    keyed = stream.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"), "l_shipdate")
    feeds.collect_changes(keyed, deltas, checkpoint, ["transaction_id"], ["l_shipdate"]).awaitTermination()
    return latest_per_key(spark.read.parquet(deltas), ["transaction_id"], ["l_shipdate", "batch_id"]).select("transaction_id")


def _deliver(spark, parts, run):
    """Each part of a feed is written to the same folder and then drained by a stream that starts again from its checkpoint."""
    arriving = scratch(spark, "arriving")
    for part in parts:
        part.write.mode("append").parquet(arriving)
        run(feeds.file_stream(spark, arriving, part.schema))


@query("stm_late_months_state", sql(
    f"""with t as (select *, date_trunc('month', transaction_date) as m, transaction_id % 10 = 0 as is_late from txn),
        w as (select max(m) - interval 62 day as closed from t where not is_late)
    select cast(m as date) as month, {n('count(*)')} as txn_count, {d('sum(amount)')} as total_spend from t, w where not is_late or m > closed group by 1""", "txn"))
def stm_late_months_state(spark, folder):
    """Months in the state store: a tenth of the orders is delivered at the end. Of those, the ones of a month that the watermark
    has closed, 62 days before the last month seen, are too late and left out; the others still change their month."""
    target, checkpoint = scratch(spark, "months"), scratch(spark, "months-checkpoint")
    feed = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast(MONEY).alias("amount"))
    late, early = F.col("o_orderkey") % 10 == 0, F.col("o_orderdate") < at_time(dt.datetime(2000, 1, 1))

    def run(stream):
        feeds.keep_updates(feeds.monthly_totals_stream(stream, "o_orderdate", "amount"), target, checkpoint).awaitTermination()

    _deliver(spark, [feed.where(~late & early), feed.where(~late & ~early), feed.where(late)], run)
    return latest_per_key(spark.read.parquet(target), ["month"], ["batch_id"]).select(
        F.col("month").cast("date").alias("month"), "txn_count", "total_spend"
    )


@query("stm_latest_delivery", sql("select transaction_id, ingestion_timestamp, cast(amount as double) as amount from line", "line"))
def stm_latest_delivery(spark, folder):
    """The latest delivery of every line with a state that holds open months only: lines are delivered in three parts by time."""
    target, checkpoint = scratch(spark, "latest"), scratch(spark, "latest-checkpoint")
    feed = raw_lines(spark, folder).select("transaction_id", "ingestion_timestamp", "amount", "part_id", "merchant_id")
    at, bounds = F.col("ingestion_timestamp"), [at_time(dt.datetime(y, 1, 1)) for y in (1997, 1999)]
    order = ["ingestion_timestamp", "amount", "part_id", "merchant_id"]

    def run(stream):
        latest = feeds.latest_delivery_stream(stream, ["transaction_id"], "ingestion_timestamp", order)
        feeds.keep_updates(latest, target, checkpoint).awaitTermination()

    _deliver(spark, [feed.where(at < bounds[0]), feed.where((at >= bounds[0]) & (at < bounds[1])), feed.where(at >= bounds[1])], run)
    return latest_per_key(spark.read.parquet(target), ["transaction_id"], [*order, "batch_id"]).select("transaction_id", "ingestion_timestamp", "amount")
