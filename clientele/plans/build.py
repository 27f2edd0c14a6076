"""Build of all tables into one folder: every table is written once, later tables read the written ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators import customer as C
from clientele.operators import star
from clientele.operators.telemetry import append
from clientele.sources.roles import AS_OF, category, customers, fact, table
from clientele.sources.sinks import rebuild, write_partitioned

NO_SCORES = "customer_id long, churn_risk_score double, predicted_churn boolean"


def build(
    spark: SparkSession, folder: str, out: str, as_of: dt.date = AS_OF, rules: C.SegmentRules = C.SegmentRules(),
    predictions: DataFrame | None = None, run_id: str = "build",
) -> dict[str, DataFrame]:
    """Dimensions, fact, summary, segments, metrics, profile and monthly mart below ``out``.

    The fact is the only large table: it is written by month, in date order inside the files, and read once for the
    summary and once for the monthly mart. Start and end of the run are appended to ``out``/run_log.
    """
    made: dict[str, DataFrame] = {}

    def log(phase: str) -> None:
        row = spark.range(1).select(
            F.lit(run_id).alias("run_id"), F.current_timestamp().cast("timestamp_ntz").alias("recorded_at"), F.lit(phase).alias("phase"),
            F.lit(len(made)).alias("models_run"), F.lit(0).alias("models_failed"),
        )
        append(row, f"{out}/run_log")

    def keep(name: str, df: DataFrame, write: Callable[[DataFrame, str], DataFrame] = rebuild) -> DataFrame:
        made[name] = write(df, f"{out}/{name}")
        return made[name]

    def by_month(df: DataFrame, path: str) -> DataFrame:
        write_partitioned(df, path, "month", mode="overwrite", sort_by=[c for c in ("transaction_date",) if c in df.columns])
        return spark.read.parquet(path)

    log("START")
    dim = keep("dim_customer", star.initial_dimension(customers(spark, folder)))
    cats = keep("dim_merchant_category", star.dim_category(table(spark, folder, "part").select(category().alias("c")), "c"))
    facts = star.fact_transactions(fact(spark, folder), dim, cats)
    fct = keep("fct_transactions", facts.withColumn("month", F.trunc("transaction_date", "month")), by_month)
    # Every fact row finds its day: the calendar runs from the first to the last day of the fact.
    span = fct.agg(F.min(F.to_date("transaction_date")).alias("first"), F.max(F.to_date("transaction_date")).alias("last"))
    keep("dim_date", star.calendar_between(span.where("first is not null"), as_of))

    current = dim.where("is_current")
    named = fct.join(cats.select(F.col("category_key").alias("merchant_category_key"), "category_name"), "merchant_category_key")
    per_key = C.customer_summary(named, as_of, key="customer_key")
    summary = keep("customer_summary", per_key.join(current.select("customer_key", "customer_id"), "customer_key"))
    segments = keep("customer_segments", C.assign_segments(summary, rules))
    keep("metric_customer_ltv", C.ltv_metric(summary, segments))
    keep("metric_avg_transaction_value", C.atv_metric(summary, segments))
    scores = predictions if predictions is not None else spark.createDataFrame([], NO_SCORES)
    profile = keep("customer_360_profile", C.profile(current.drop("customer_key"), segments, scores, as_of))
    monthly = C.monthly_spending(fct.join(current.select("customer_key", "customer_id"), "customer_key"))
    who = profile.select("customer_id", "full_name", "customer_segment", "card_type", "state", "city")
    keep("monthly_customer_spending", monthly.join(who, "customer_id", "left"), by_month)
    log("END")
    return made
