"""Metric snapshots, deltas, check telemetry and run records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clientele.functions.columns import mean, pct
from clientele.functions.dates import at_time, months_between_boundaries
from clientele.operators.dedupe import latest_per_key
from clientele.operators.reports import segment_activity
from clientele.operators.suites import duplicates

SNAPSHOT_METRICS = ("customer_count", "transaction_count", "total_transaction_amount", "avg_transaction_amount", "months_of_data")


def append(records: DataFrame, path: str) -> None:
    """Add records to an append-only table."""
    records.write.mode("append").parquet(path)


def snapshot(customers: DataFrame, transactions: DataFrame, kind: str, at) -> DataFrame:
    """One row of headline metrics."""
    return snapshots(customers, transactions, {kind: (None, at)})


def snapshots(customers: DataFrame, transactions: DataFrame, kinds: Mapping[str, tuple[dt.date | None, dt.datetime]]) -> DataFrame:
    """One row of headline metrics for each kind of snapshot: the transactions before a date (None: all of them).

    The customer side and the transaction side are one aggregate each, for all snapshots together.
    """
    side = customers.agg(
        F.count(F.lit(1)).alias("customer_count"), F.count_distinct("customer_segment").alias("segment_count")
    )
    day, cells = F.col("transaction_date"), []
    for kind, (before, at) in kinds.items():
        of = F.lit(True) if before is None else day < F.lit(before)
        amount, when = F.when(of, F.col("amount")), F.when(of, day)
        months = months_between_boundaries("_s.min_transaction_date", "_s.max_transaction_date")
        cells.append(F.struct(
            at_time(at).alias("snapshot_timestamp"), F.lit(kind).alias("snapshot_type"),
            F.count_if(of).alias("transaction_count"), F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)).alias("total_transaction_amount"),
            F.coalesce(mean(amount), F.lit(0.0)).alias("avg_transaction_amount"),
            F.min(when).alias("min_transaction_date"), F.max(when).alias("max_transaction_date"),
        ))
    rows = transactions.agg(F.array(*cells).alias("_all")).select(F.explode("_all").alias("_s")).select(
        "_s.*", F.coalesce(months, F.lit(0)).alias("months_of_data")
    )
    # The customer side is one row, put to each of the few snapshots.
    both = rows.withColumn("_one", F.lit(1)).join(side.withColumn("_one", F.lit(1)), "_one")
    return both.select(
        "snapshot_timestamp", "snapshot_type", "customer_count", "segment_count", "transaction_count", "total_transaction_amount",
        "avg_transaction_amount", "min_transaction_date", "max_transaction_date", "months_of_data",
    )


def snapshot_delta(snapshots: DataFrame, before: str, after: str) -> DataFrame:
    """Latest snapshot of each kind; one line per metric with values, difference and change in percent."""
    latest = latest_per_key(snapshots, ["snapshot_type"], ["snapshot_timestamp"])
    cells = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in SNAPSHOT_METRICS
    ])
    long = latest.select("snapshot_type", F.inline(cells))

    def of(kind: str):
        return F.max(F.when(F.col("snapshot_type") == kind, F.col("value")))

    b, a = F.col("before_value"), F.col("after_value")
    change = F.concat(F.format_string("%.2f", F.round((a - b) * 100 / b, 2)), F.lit("%"))
    return long.groupBy("metric").agg(of(before).alias("before_value"), of(after).alias("after_value")).withColumns({
        "delta": F.round(a - b, 2), "pct_change": F.when(b == 0, "NEW DATA").otherwise(change),
    })


def generation_load(transactions: DataFrame, path: str, process: str, at) -> tuple[DataFrame, DataFrame]:
    """Load the transactions to ``path``; returns the table and the volume record of the load.

    Counts, dates and amounts are observed while the rows are written; only the number of customers reads their column again.
    """
    amount, day = F.col("amount"), F.col("transaction_date")
    loaded, seen = observed_load(transactions, path, [
        F.count(F.lit(1)).alias("rows"), F.count(amount).alias("amounts"), F.sum(amount).alias("volume"), F.min(day).alias("first"), F.max(day).alias("last"),
    ])
    average = F.lit(seen["volume"]).cast("double") / F.lit(seen["amounts"]).cast("double") if seen["amounts"] else F.lit(None).cast("double")
    record = loaded.agg(F.count_distinct("customer_id").alias("unique_customers")).select(
        F.lit(process).alias("process_name"), at_time(at).alias("execution_timestamp"),
        F.lit(seen["rows"]).cast("bigint").alias("total_transactions"), "unique_customers",
        F.lit(seen["first"]).cast("date").alias("min_date"), F.lit(seen["last"]).cast("date").alias("max_date"),
        F.lit(seen["volume"]).cast(loaded.agg(F.sum("amount")).schema[0].dataType).alias("total_transaction_volume"),
        average.alias("avg_transaction_amount"),
    ).withColumn("months_of_data", months_between_boundaries("min_date", "max_date"))
    return loaded, record


# Check name, category, measure, status when something is found.
QUALITY_CHECKS = (
    ("NULL_TRANSACTION_ID", "NULL_CHECKS", "null_transactions", "FAIL"),
    ("NULL_CUSTOMER_ID", "NULL_CHECKS", "null_customers", "FAIL"),
    ("NULL_TRANSACTION_DATE", "NULL_CHECKS", "null_dates", "FAIL"),
    ("NULL_TRANSACTION_AMOUNT", "NULL_CHECKS", "null_amounts", "FAIL"),
    ("DUPLICATE_TRANSACTION_IDS", "DUPLICATE_CHECKS", "duplicate_rows", "FAIL"),
    ("INVALID_AMOUNTS", "VALUE_RANGE_CHECKS", "not_positive", "FAIL"),
    ("FUTURE_DATES", "VALUE_RANGE_CHECKS", "future", "FAIL"),
    ("SUSPICIOUSLY_HIGH_AMOUNTS", "VALUE_RANGE_CHECKS", "high_amounts", "WARNING"),
    ("ORPHAN_TRANSACTIONS", "REFERENTIAL_INTEGRITY", "orphan_rows", "FAIL"),
)


def quality_records(measures: DataFrame, at) -> DataFrame:
    """Nine check records from the one-row measures of a table."""
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("check_name"), F.lit(category).alias("check_category"), F.col("rows").alias("records_checked"),
            F.col(m).cast("bigint").alias("issues_found"), pct(m, "rows").alias("issue_percentage"),
            F.when(F.col(m) == 0, "PASS").otherwise(found).alias("check_status"),
        )
        for name, category, m, found in QUALITY_CHECKS
    ])
    return measures.select(at_time(at).alias("check_timestamp"), F.inline(lines))


def segment_record(customers: DataFrame, transactions: DataFrame, at) -> DataFrame:
    return segment_activity(customers, transactions).select(at_time(at).alias("snapshot_timestamp"), "*")


def dashboard(records: DataFrame) -> DataFrame:
    """Pass rate per check time and category."""
    def n(status: str):
        return F.count_if(F.col("check_status") == status)

    return records.groupBy("check_timestamp", "check_category").agg(
        F.count(F.lit(1)).alias("total_checks"), n("PASS").alias("passed_checks"), n("FAIL").alias("failed_checks"),
        n("WARNING").alias("warning_checks"),
    ).withColumn("pass_rate", pct("passed_checks", "total_checks"))


def layer_counts(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows, distinct, missing and repeated keys per table; ``tables`` maps a name to (df, key, layer)."""
    out = None
    for name, (df, key, layer) in tables.items():
        row = duplicates(df, key).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.col("total_rows").alias("record_count"),
            "distinct_keys", F.col("null_keys").alias("null_key_count"), F.col("repeated_keys").alias("duplicate_key_count"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def observed_load(df: DataFrame, path: str, metrics: Sequence[Column]) -> tuple[DataFrame, dict]:
    """Write ``df`` to ``path``; returns the table and the ``metrics`` (named aggregates) of its rows, taken while they are written.

    A task that is repeated counts once: the metrics of a written partition are those of its first finished task.
    """
    seen = Observation()
    df.observe(seen, *metrics).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def load_layers(tables: Mapping[str, tuple[DataFrame, str, str]], path: str) -> DataFrame:
    """Load the tables below ``path``; the record of :func:`layer_counts` for each, without reading the table again.

    Rows and missing keys are observed during the load. Only the uniqueness of the key needs its column once more.
    """
    out = None
    for name, (df, key, layer) in tables.items():
        loaded, seen = observed_load(df, f"{path}/{name}", [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys")])
        per_key = loaded.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        row = per_key.agg(F.count(F.lit(1)).alias("distinct_keys"), F.count_if(F.col("_n") > 1).alias("duplicate_key_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.lit(seen["rows"]).cast("bigint").alias("record_count"),
            "distinct_keys", F.lit(seen["null_keys"]).cast("bigint").alias("null_key_count"), "duplicate_key_count",
        )
        out = row if out is None else out.unionByName(row)
    return out


def check_status(checked: str = "records_checked", failed: str = "records_failed", threshold: float = 0.01) -> list:
    """Failure rate and its band: pass up to the threshold, warning up to 5 percent."""
    rate = F.col(failed).cast("double") / F.nullif(F.col(checked).cast("double"), F.lit(0.0))
    status = F.when(rate <= threshold, "PASS").when((rate > threshold) & (rate <= 0.05), "WARNING").otherwise("FAIL")
    return [rate.alias("failure_rate"), status.alias("status")]


def recent_failures(metrics: DataFrame, at: dt.datetime, days: int = 7) -> DataFrame:
    since = at_time(at - dt.timedelta(days=days))
    return metrics.where(F.col("status").isin("WARNING", "FAIL") & (F.col("run_timestamp") >= since))


def count_trends(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, least and greatest record count and number of runs per day."""
    day = F.to_date("run_timestamp").alias("run_date")
    return counts.groupBy(day, *keys).agg(
        mean("record_count").alias("avg_record_count"), F.min("record_count").alias("min_record_count"),
        F.max("record_count").alias("max_record_count"), F.count_distinct("run_id").alias("num_runs"),
    )


def run_log(records: DataFrame) -> DataFrame:
    """Reduce appended start and end records to one row per run.

    Records: run_id, recorded_at, phase ('START' or 'END'), models_run, models_failed.
    """
    at, end = F.col("recorded_at"), F.col("phase") == "END"
    failed = F.max(F.when(end, F.col("models_failed")))
    return records.groupBy("run_id").agg(
        F.min(F.when(~end, at)).alias("start_time"), F.max(F.when(end, at)).alias("end_time"),
        F.max(F.when(end, F.col("models_run"))).alias("models_run"), failed.alias("models_failed"),
    ).withColumns({
        "status": F.when(F.col("end_time").isNull(), "STARTED").when(F.col("models_failed") == 0, "SUCCESS").otherwise("FAILED"),
        "duration_seconds": F.expr("timestampdiff(SECOND, start_time, end_time)"),
    })
