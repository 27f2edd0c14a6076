"""Fused check suites: one aggregate per table feeds all checks of a suite."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import pct
from clientele.functions.dates import months_between_boundaries
from clientele.operators.setops import beside
from clientele.operators.windows import share_of_total

# Target share and accepted band (percent) of each declared segment.
SEGMENT_TARGETS = {
    "High-Value Travelers": 15, "Stable Mid-Spenders": 40, "Budget-Conscious": 25, "Declining": 10, "New & Growing": 10,
}
SEGMENT_BAND = 5


def report(row: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """One line per check (name, measured value, status) from a one-row table of measures."""
    lines = F.array(*[
        F.struct(F.lit(name).alias("check_name"), value.cast("double").alias("measured"), status.alias("status"))
        for name, value, status in checks
    ])
    return row.select(F.inline(lines))


def passed(condition: Column, otherwise: str = "FAIL") -> Column:
    return F.when(condition, "PASS").otherwise(otherwise)


def banded_status(good: Column, tolerable: Column) -> Column:
    return F.when(good, "PASS").when(tolerable, "WARNING").otherwise("FAIL")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, rows without key, distinct keys, surplus rows and number of repeated keys."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    named = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(~named, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count(key).alias("distinct_keys"),
        F.count(F.when(named & (F.col("_n") > 1), True)).alias("repeated_keys"),
    ).withColumn("surplus_rows", F.col("total_rows") - F.col("distinct_keys"))


def customer_suite(
    customers: DataFrame, as_of: dt.date, expected_rows: int, limits: tuple[float, float] = (5000, 50000),
    step: float = 1000, ages: tuple[int, int] = (22, 75), declining: str = "Declining",
) -> DataFrame:
    """Load checks of the customer table: count, keys, dates, email, limit, age, lineage, decline logic."""
    c = F.col
    sudden = c("decline_type").isin("gradual", "sudden")
    decline_ok = F.when(c("customer_segment") == declining, F.coalesce(sudden, F.lit(False))).otherwise(c("decline_type").isNull())
    measures = beside(duplicates(customers, "customer_id"), customers.agg(
        F.min("account_open_date").alias("first_open"), F.max("account_open_date").alias("last_open"),
        F.count_if(c("email").like("%@%") & c("email").like("%.%")).alias("valid_email"),
        F.min("credit_limit").alias("min_limit"), F.max("credit_limit").alias("max_limit"),
        F.count_if(c("credit_limit") % step != 0).alias("off_step"),
        F.min("age").alias("min_age"), F.max("age").alias("max_age"),
        F.count_if(c("source_file").isNotNull() & c("ingestion_timestamp").isNotNull()).alias("with_lineage"),
        F.count_if(~decline_ok).alias("decline_errors"),
    ))
    oldest = F.lit(dt.date(as_of.year - 6, as_of.month, as_of.day))
    total = c("total_rows")
    return report(measures, [
        ("row_count", total, passed(total == expected_rows)),
        ("null_customer_ids", c("null_keys"), passed(c("null_keys") == 0)),
        ("duplicate_customer_ids", c("repeated_keys"), passed(c("repeated_keys") == 0)),
        ("open_date_range_days", F.datediff("last_open", "first_open"),
         passed((c("first_open") >= oldest) & (c("last_open") <= F.lit(as_of)))),
        ("valid_emails", c("valid_email"), passed(c("valid_email") == total)),
        ("credit_limit_range", c("max_limit") - c("min_limit"),
         passed((c("min_limit") >= limits[0]) & (c("max_limit") <= limits[1]) & (c("off_step") == 0))),
        ("age_range", c("max_age") - c("min_age"), passed((c("min_age") >= ages[0]) & (c("max_age") <= ages[1]))),
        ("lineage_filled", c("with_lineage"), passed(c("with_lineage") == total)),
        ("decline_type_errors", c("decline_errors"), passed(c("decline_errors") == 0)),
    ])


def segment_bands(customers: DataFrame, targets: Mapping[str, float] = SEGMENT_TARGETS, band: float = SEGMENT_BAND) -> DataFrame:
    """Share of every declared segment against its target band."""
    counts = customers.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("row_count"))
    shares = share_of_total(counts, "row_count", "percentage")
    status = F.lit("UNKNOWN")
    for segment, target in targets.items():
        inside = F.col("percentage").between(target - band, target + band)
        status = F.when(F.col("customer_segment") == segment, passed(inside)).otherwise(status)
    return shares.withColumn("status", status)


def transaction_measures(
    transactions: DataFrame, customers: DataFrame, as_of: dt.date, high_amount: float = 10_000
) -> DataFrame:
    """The measures of the transaction checks as one row, from one pass over transactions and customers.

    Every transaction counts for its customer and for its id; customers take part in the same grouping as rows without a
    transaction. So orphans, coverage and repeated ids come from one shuffle, to which a customer with very many
    transactions sends one row per task.
    """
    c, zero = F.col, F.lit(0)
    names = {"customer_id": transactions.schema["customer_id"].dataType, "transaction_id": transactions.schema["transaction_id"].dataType}
    none = {k: F.lit(None).cast(t).alias(k) for k, t in names.items()}
    sides = F.array(
        F.struct(F.lit("customer").alias("side"), c("customer_id"), none["transaction_id"]),
        F.struct(F.lit("transaction").alias("side"), none["customer_id"], c("transaction_id")),
    )
    measured = ("transaction_date", "amount", "ingestion_timestamp")
    rows = transactions.select(*measured, F.inline(sides), F.lit(1).alias("is_row"))
    listed = customers.select(
        *[F.lit(None).cast(transactions.schema[m].dataType).alias(m) for m in measured], F.lit("customer").alias("side"),
        c("customer_id").cast(names["customer_id"]).alias("customer_id"), none["transaction_id"], F.lit(0).alias("is_row"),
    )
    row = (c("is_row") == 1) & (c("side") == "customer")
    groups = rows.unionByName(listed).groupBy("side", "customer_id", "transaction_id").agg(
        F.sum("is_row").alias("n"), F.sum(1 - c("is_row")).alias("listed"),
        F.count_if(row & c("transaction_date").isNull()).alias("null_dates"),
        F.count_if(row & c("amount").isNull()).alias("null_amounts"),
        F.count_if(row & c("ingestion_timestamp").isNull()).alias("null_ingestion"),
        F.count_if(row & (c("transaction_date") > F.lit(as_of))).alias("future"),
        F.count_if(row & (c("amount") <= 0)).alias("not_positive"),
        F.count_if(row & (c("amount") > high_amount)).alias("high_amounts"),
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"), F.sum(F.when(row, c("amount"))).alias("amount"),
        F.min("transaction_date").alias("first_day"), F.max("transaction_date").alias("last_day"),
    )
    of_customer, named = c("side") == "customer", c("customer_id").isNotNull()
    has, known = of_customer & (c("n") > 0), named & (c("listed") > 0)
    of_id = c("side") == "transaction"
    return groups.agg(
        F.coalesce(F.sum(F.when(of_customer, c("n"))), zero).alias("rows"),
        F.coalesce(F.sum(F.when(of_customer & ~named, c("n"))), zero).alias("null_customers"),
        *[F.coalesce(F.sum(x), zero).alias(x) for x in ("null_dates", "null_amounts", "null_ingestion", "future", "not_positive", "high_amounts")],
        F.count_if(has & named).alias("customers_seen"),
        F.coalesce(F.sum(F.when(of_customer & ((c("n") == 0) | ~named), c("listed"))), zero).alias("customers_missing"),
        F.count_if(has & named & ~known).alias("orphan_customers"),
        F.coalesce(F.sum(F.when(has & ~known, c("n"))), zero).alias("orphan_rows"),
        F.min("min_amount").alias("min_amount"), F.max("max_amount").alias("max_amount"),
        F.sum("amount").alias("total_amount"),
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        F.coalesce(F.sum(F.when(of_id, c("n") - c("transaction_id").isNotNull().cast("int"))), zero).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(of_id & c("transaction_id").isNull(), c("n"))), zero).alias("null_transactions"),
    )


def transaction_suite(
    measures: DataFrame, rows: tuple[int, int], customers_expected: int, months: tuple[int, int], high_amount: float
) -> DataFrame:
    """Load checks of the transaction table over :func:`transaction_measures`."""
    c = F.col
    span = months_between_boundaries("first_day", "last_day")
    n = c("rows")
    return report(measures, [
        ("row_count", n, banded_status(n.between(*rows), n.between(rows[0] // 2, rows[1] * 2))),
        ("duplicate_transaction_ids", c("duplicate_rows"), passed(c("duplicate_rows") == 0)),
        ("null_transaction_ids", c("null_transactions"), passed(c("null_transactions") == 0)),
        ("null_customer_ids", c("null_customers"), passed(c("null_customers") == 0)),
        ("null_transaction_dates", c("null_dates"), passed(c("null_dates") == 0)),
        ("null_transaction_amounts", c("null_amounts"), passed(c("null_amounts") == 0)),
        ("customers_represented", c("customers_seen"),
         banded_status(c("customers_seen") == customers_expected, c("customers_seen") >= 0.98 * customers_expected)),
        ("customers_without_transactions", c("customers_missing"),
         banded_status(c("customers_missing") == 0, c("customers_missing") < 100)),
        ("orphan_customers", c("orphan_customers"), passed(c("orphan_customers") == 0)),
        ("months_covered", span, banded_status(span.between(*months), span.between(months[0] - 2, months[1] + 2))),
        ("future_dates", c("future"), passed(c("future") == 0)),
        ("amount_range", c("max_amount"), banded_status(
            (c("not_positive") == 0) & (c("max_amount") <= high_amount),
            (c("not_positive") == 0) & (c("max_amount") <= 1.5 * high_amount))),
        ("null_ingestion_timestamps", c("null_ingestion"), passed(c("null_ingestion") == 0)),
    ])


def issue_list(measures: DataFrame) -> DataFrame:
    """Only the checks that found something."""
    found = {
        "Duplicate transaction IDs": "duplicate_rows", "NULL transaction IDs": "null_transactions",
        "NULL customer IDs": "null_customers", "Invalid customer IDs": "orphan_customers",
        "Future transaction dates": "future", "Zero or negative amounts": "not_positive",
    }
    lines = F.array(*[
        F.struct(F.lit(k).alias("issue_type"), F.col(v).cast("bigint").alias("issue_count")) for k, v in found.items()
    ])
    return measures.select(F.inline(lines)).where(F.col("issue_count") > 0)


def status_bands(transactions: DataFrame, bands: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Share of every status against its band."""
    counts = transactions.groupBy("status").agg(F.count(F.lit(1)).alias("txn_count"))
    shares = share_of_total(counts, "txn_count", "percentage")
    verdict = F.lit("WARNING")
    for status, band in bands.items():
        inside = (F.col("status") == status) & F.col("percentage").between(*band)
        verdict = F.when(inside, "PASS").otherwise(verdict)
    return shares.withColumn("status_check", verdict)


def customer_profile(
    customers: DataFrame, required: Sequence[str], id_pattern: str, targets: Mapping[str, float],
    limits: tuple[float, float], step: float, declining: str,
) -> DataFrame:
    """File validation before a load: errors by kind, as one fused aggregate. Shares deviate by more than 5 points."""
    c = F.col
    segment_n = {s: F.count_if(c("customer_segment") == s) for s in targets}
    decl = c("customer_segment") == declining
    row = beside(duplicates(customers, "customer_id").select("surplus_rows"), customers.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(c(f).isNull()).alias(f"null_{f}") for f in required],
        F.count_if(~c("customer_id").cast("string").rlike(id_pattern)).alias("bad_id"),
        F.count_if(~c("email").rlike(r"^[^@]+@[^@]+\.[^@]+$")).alias("bad_email"),
        F.count_if((c("credit_limit") < limits[0]) | (c("credit_limit") > limits[1]) | (c("credit_limit") % step != 0)).alias("bad_limit"),
        F.count_if(decl & c("decline_type").isNull()).alias("declining_without_type"),
        F.count_if(~decl & c("decline_type").isNotNull()).alias("type_without_declining"),
        *[n.alias(f"n_{i}") for i, n in enumerate(segment_n.values())],
    ))
    errors = [(f"null {f}", c(f"null_{f}")) for f in required] + [
        ("duplicate customer_id", c("surplus_rows")), ("customer_id format", c("bad_id")), ("email format", c("bad_email")),
        ("credit limit", c("bad_limit")), ("Declining without decline_type", c("declining_without_type")),
        ("decline_type without Declining", c("type_without_declining")),
    ]
    out = [(k, v, passed(v == 0)) for k, v in errors]
    for i, (segment, target) in enumerate(targets.items()):
        share = pct(c(f"n_{i}"), "rows")
        out.append((f"share of {segment}", share, passed(F.abs(share - target) <= 5, "WARNING")))
    return report(row, out)


def post_generation(measures: DataFrame, rows: tuple[int, int], high_amount: float) -> DataFrame:
    """Checks after a bulk generation or load: volume, uniqueness, coverage, orphans, span, future dates, amounts."""
    c = F.col
    n, span = c("rows"), months_between_boundaries("first_day", "last_day")
    return report(measures, [
        ("total_transactions", n, F.when(n.between(*rows), "PASS").when(n > rows[1], "WARNING").otherwise("FAIL")),
        ("duplicate_count", c("duplicate_rows"), passed(c("duplicate_rows") == 0)),
        ("null_transaction_id", c("null_transactions"), passed(c("null_transactions") == 0)),
        ("null_customer_id", c("null_customers"), passed(c("null_customers") == 0)),
        ("null_transaction_date", c("null_dates"), passed(c("null_dates") == 0)),
        ("null_transaction_amount", c("null_amounts"), passed(c("null_amounts") == 0)),
        ("customers_missing", c("customers_missing"), passed(c("customers_missing") == 0)),
        ("orphan_transactions", c("orphan_rows"), passed(c("orphan_rows") == 0)),
        ("months_of_data", span, passed(span.between(17, 19), "WARNING")),
        ("future_dates", c("future"), passed(c("future") == 0)),
        ("amounts", c("max_amount"), passed((c("not_positive") == 0) & (c("max_amount") <= high_amount), "WARNING")),
    ])
