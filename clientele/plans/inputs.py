"""Shared inputs of the registered queries: role tables composed once, reference dates fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.dates import days_between, on
from clientele.operators import customer as C
from clientele.plans.oracle import SCALED
from clientele.sources.roles import AS_OF, customers, fact, table


def summary(spark: SparkSession, folder: str, median: bool = False) -> DataFrame:
    return C.customer_summary(fact(spark, folder), AS_OF, median=median, feed=table(spark, folder, "lineitem"))


def segments(spark: SparkSession, folder: str, median: bool = False) -> DataFrame:
    return C.assign_segments(summary(spark, folder, median), SCALED)


def scores_from(segs: DataFrame) -> DataFrame:
    """Churn scores for the queries that read a scored table and are checked by SQL: idle days over 4, at most 100.

    The trained model is used by the ``ml_`` queries; its floating-point scores cannot be recomputed in SQL.
    """
    idle = days_between("last_transaction_date", on(AS_OF)).cast("double") / 4.0
    return segs.where(F.col("total_transactions") >= 5).select(
        "customer_id", F.least(idle, F.lit(100.0)).alias("churn_risk_score"), (idle >= 50.0).alias("predicted_churn")
    )


def scored_segments(spark: SparkSession, folder: str, median: bool = False) -> tuple[DataFrame, DataFrame]:
    segs = segments(spark, folder, median)
    return segs, scores_from(segs)


def with_scores(segs: DataFrame) -> DataFrame:
    """Segments with the scores of :func:`scores_from` beside them; customers that are not scored have NULLs."""
    idle = days_between("last_transaction_date", on(AS_OF)).cast("double") / 4.0
    scored = F.col("total_transactions") >= 5
    return segs.withColumns({
        "churn_risk_score": F.when(scored, F.least(idle, F.lit(100.0))),
        "predicted_churn": F.when(scored, idle >= 50.0),
    })


def profile(spark: SparkSession, folder: str, median: bool = False) -> DataFrame:
    who = customers(spark, folder).drop("customer_segment", "decline_type")
    return C.profile_row(who.join(with_scores(segments(spark, folder, median)), "customer_id"), AS_OF)
