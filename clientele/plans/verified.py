"""Questions with a verified query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientele.plans.catalog import QUERIES

VERIFIED = {
    "Who are the top 10 customers by lifetime value?": "vq_top_ltv",
    "Which customers are at high risk of churning?": "vq_high_risk",
    "Give me a summary of customer segments": "agg_segment_summary",
    "What are the total transactions by month?": "agg_monthly_volume",
    "How much are customers spending by category?": "agg_category_spend",
    "Show me customers in the Declining segment with details": "vq_declining",
    "How are premium card customers performing compared to standard?": "agg_card_perf",
    "Which states have the most customers?": "agg_state_top",
    "Compare spending between two states": "agg_state_compare",
    "Compare customer metrics across multiple states": "agg_state_multi",
    "Show me customer segments by state": "agg_state_segment",
}


def answer(spark: SparkSession, folder: str, question: str) -> DataFrame:
    return QUERIES[VERIFIED[question]](spark, folder)
