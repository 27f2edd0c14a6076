"""Metric layer: measures with a default aggregation over declared tables and many-to-one joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import stable_mean

AGGREGATIONS = {"sum": F.sum, "avg": stable_mean, "count": F.count, "count_distinct": F.count_distinct, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Logical:
    """Dimensions of a logical table and its measures: name -> (column, aggregation)."""

    dimensions: Sequence[str]
    measures: Mapping[str, tuple[str, str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Relation:
    """Many-to-one left join from ``left`` to ``right``."""

    left: str
    right: str
    left_column: str
    right_column: str


# Measures and their default aggregation.
MODEL = {
    "customer_profile": Logical(
        ("customer_id", "full_name", "email", "age", "state", "city", "employment_status", "card_type", "customer_segment",
         "spending_profile", "recency_status", "churn_risk_category", "spending_consistency"),
        {
            "lifetime_value": ("lifetime_value", "sum"),
            "avg_transaction_value": ("avg_transaction_value", "avg"),
            "total_transactions": ("total_transactions", "sum"),
            "credit_limit": ("credit_limit", "avg"),
            "days_since_last_transaction": ("days_since_last_transaction", "avg"),
            "spend_last_90_days": ("spend_last_90_days", "sum"),
            "spend_change_pct": ("spend_change_pct", "avg"),
            "churn_risk_score": ("churn_risk_score", "avg"),
            "credit_utilization_pct": ("credit_utilization_pct", "avg"),
            "travel_spend_pct": ("travel_spend_pct", "avg"),
            "necessities_spend_pct": ("necessities_spend_pct", "avg"),
            "customer_count": ("customer_id", "count"),
        },
    ),
    "transactions": Logical(
        ("transaction_id", "customer_id", "category_name", "merchant_id", "channel", "status", "transaction_date"),
        {"transaction_amount": ("amount", "sum"), "transaction_count": ("transaction_id", "count")},
    ),
    "merchant_categories": Logical(("category_name", "category_group", "spending_type")),
    "monthly_spending": Logical(
        ("customer_id", "month"),
        {
            "total_spend": ("total_spend", "sum"),
            "transaction_count": ("transaction_count", "sum"),
            "avg_transaction_value": ("avg_transaction_value", "avg"),
            "customer_count": ("customer_id", "count_distinct"),
        },
    ),
}
RELATIONS = (
    Relation("transactions", "customer_profile", "customer_id", "customer_id"),
    Relation("transactions", "merchant_categories", "category_name", "category_name"),
    Relation("monthly_spending", "customer_profile", "customer_id", "customer_id"),
)


def metric(
    tables: Mapping[str, DataFrame], base: str, measures: Sequence[str], dimensions: Sequence[str],
    model: Mapping[str, Logical] = MODEL, relations: Sequence[Relation] = RELATIONS,
) -> DataFrame:
    """Measures of ``base`` by dimensions of ``base`` or of a table it relates to (written as table.dimension).

    Sums and counts are first reduced to the base columns involved (own dimensions and join keys), so a join sees one
    row per key instead of the base rows. Averages and distinct counts need the rows themselves.
    """
    own = model[base]
    wanted = {m: own.measures[m] for m in measures}
    foreign = [d for d in dimensions if "." in d]
    links = [r for r in relations if r.left == base and any(d.split(".")[0] == r.right for d in foreign)]
    missing = {d.split(".")[0] for d in foreign} - {r.right for r in links}
    unknown = [d for d in dimensions if "." not in d and d not in own.dimensions]
    if missing or unknown:
        raise ValueError(f"no relation from {base} to {sorted(missing)}; unknown dimensions {unknown}")
    local = [d for d in dimensions if "." not in d]
    keys = list(dict.fromkeys([*local, *[r.left_column for r in links]]))
    mergeable = all(agg in ("sum", "count") for _, agg in wanted.values())
    df = tables[base]
    if links and mergeable:
        df = df.groupBy(*keys).agg(*[AGGREGATIONS[agg](c).alias(f"_{m}") for m, (c, agg) in wanted.items()])
        final = [F.sum(f"_{m}").alias(m) for m in wanted]
    else:
        final = [AGGREGATIONS[agg](c).alias(m) for m, (c, agg) in wanted.items()]
    for r in links:
        shown = [d.split(".")[1] for d in foreign if d.split(".")[0] == r.right]
        side = tables[r.right].select(F.col(r.right_column).alias(f"_{r.right}_key"), *[F.col(c).alias(f"{r.right}_{c}") for c in shown])
        df = df.join(side, F.col(r.left_column) == F.col(f"_{r.right}_key"), "left")
    return df.groupBy(*local, *[d.replace(".", "_") for d in foreign]).agg(*final)
