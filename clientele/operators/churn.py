"""Churn: labels, features, training, gate, scoring and the jobs that chain them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.columns import mean, money_mean, pct, stable_mean
from clientele.functions.dates import days_between, months_before, on
from clientele.operators import customer as C
from clientele.operators.suites import banded_status, passed, report
from clientele.operators.selection import percentiles

# Encodings of the banded features.
CONSISTENCY_CODE = {"Consistent": 0, "Moderate": 1, "Variable": 2}
PROFILE_CODE = {"Travel-Focused": 1, "Necessity-Focused": 2}
RECENCY_CODE = {"Active (30 days)": 0, "Recent (60 days)": 1, "At Risk (90 days)": 2, "Inactive (90+ days)": 3}
NO_TRANSACTION_DAYS = 999

# Columns that come from the label itself and must not reach the model.
LEAKING = (
    "churn_reason", "baseline_avg_spend", "recent_avg_spend", "label_days_since_last_txn",
)
CATEGORICAL = ("state", "employment_status")
NUMERIC = (
    "age", "card_type_premium", "credit_limit", "lifetime_value", "avg_transaction_value", "total_transactions",
    "days_since_last_transaction", "spend_change_pct", "travel_spend_pct", "necessities_spend_pct", "avg_monthly_spend",
    "avg_spend_per_transaction", "credit_utilization_pct", "tenure_months", "segment_high_value_travelers",
    "segment_declining", "segment_new_growing", "segment_budget_conscious", "segment_stable", "transactions_per_day",
    "spend_per_day", "spending_consistency_encoded", "recency_status_encoded", "spending_profile_encoded",
    "transaction_value_stddev", "median_transaction_value", "spend_momentum",
)


@dataclass(frozen=True)
class LabelRules:
    """Baseline window in months before the reference date, recent window, inactivity and decline thresholds."""

    baseline_from: int = 18
    baseline_to: int = 6
    baseline_months: int = 6
    recent_months: int = 3
    inactive_days: int = 60
    decline_ratio: float = 0.30


def labels(transactions: DataFrame, as_of: dt.date, rules: LabelRules = LabelRules()) -> DataFrame:
    """Churn label per customer with enough baseline months.

    Both windows come from one scan, reduced to (customer, window, month). The recent spend is the mean of the recent
    months' totals; sums and counts are taken over the transactions once (joining months to transactions would
    multiply them by the number of active months).
    """
    day = F.col("transaction_date")
    start, end = months_before(as_of, rules.baseline_from), months_before(as_of, rules.baseline_to)
    recent_start = months_before(as_of, rules.recent_months)
    in_base = (day >= F.lit(start)) & (day < F.lit(end))
    in_recent = (day >= F.lit(recent_start)) & (day <= F.lit(as_of))
    windowed = transactions.where((F.col("status") == "approved") & (in_base | in_recent))
    monthly = windowed.groupBy("customer_id", F.trunc(day, "month").alias("month")).agg(
        F.sum(F.when(in_base, F.col("amount"))).alias("base"),
        F.sum(F.when(in_recent, F.col("amount"))).alias("recent"),
        F.count(F.when(in_recent, True)).alias("recent_n"),
        F.max(F.when(in_recent, day)).alias("last"),
    )
    per = monthly.groupBy("customer_id").agg(
        F.count("base").alias("baseline_months"),
        mean("base").alias("baseline_avg_spend"),
        F.sum("base").cast("double").alias("baseline_total_spend"),
        F.count("recent").alias("recent_months_active"),
        mean("recent").alias("_recent_avg"),
        F.sum("recent").cast("double").alias("_recent_total"),
        F.sum("recent_n").alias("recent_transaction_count"),
        F.max("last").alias("last_transaction_date"),
    ).where(F.col("baseline_months") >= rules.baseline_months)
    idle = days_between("last_transaction_date", on(as_of))
    base, recent = F.col("baseline_avg_spend"), F.col("_recent_avg")
    none = F.col("last_transaction_date").isNull()
    inactive, declined = idle > rules.inactive_days, recent < base * rules.decline_ratio
    return per.select(
        "customer_id", "baseline_months", "baseline_avg_spend", "baseline_total_spend", "recent_months_active",
        F.coalesce("_recent_avg", F.lit(0.0)).alias("recent_avg_spend"),
        F.coalesce("_recent_total", F.lit(0.0)).alias("recent_total_spend"),
        "recent_transaction_count", "last_transaction_date",
        F.when(none, NO_TRANSACTION_DAYS).otherwise(idle).alias("days_since_last_transaction"),
        F.when((base > 0) & (recent > 0), (recent - base) / base * 100)
        .when(recent.isNull() | (recent == 0), -100.0).otherwise(0.0).alias("spend_change_pct"),
        F.when(none | inactive | declined, True).otherwise(False).alias("churned"),
        F.when(none, "No recent transactions").when(inactive, f"Inactive ({rules.inactive_days}+ days)")
        .when(declined, f"Significant decline (< {rules.decline_ratio:.0%} baseline)").otherwise("Active").alias("churn_reason"),
    )


def _code(c: str, codes: dict[str, int], default: int = 0) -> Column:
    out = None
    for label, value in codes.items():
        out = F.when(F.col(c) == label, value) if out is None else out.when(F.col(c) == label, value)
    return out.otherwise(default)


def features(profile: DataFrame, minimum: int = 5) -> DataFrame:
    """Model features of customers with at least ``minimum`` transactions; one function for training and scoring."""
    c = F.col
    segment = {
        "segment_high_value_travelers": C.TRAVELERS, "segment_declining": C.DECLINING, "segment_new_growing": C.GROWING,
        "segment_budget_conscious": C.BUDGET, "segment_stable": C.STABLE,
    }
    age = c("customer_age_days")
    return profile.where(c("total_transactions") >= minimum).select(
        "customer_id", "age", "state", "city", F.when(c("card_type") == "Premium", 1).otherwise(0).alias("card_type_premium"),
        "credit_limit", "employment_status", "lifetime_value", "avg_transaction_value", "total_transactions",
        "customer_age_days", "days_since_last_transaction", "spend_last_90_days", "spend_prior_90_days", "spend_change_pct",
        "avg_monthly_spend", "transaction_value_stddev", "median_transaction_value",
        _code("spending_consistency", CONSISTENCY_CODE).alias("spending_consistency_encoded"),
        F.coalesce("travel_spend_pct", F.lit(0.0)).alias("travel_spend_pct"),
        F.coalesce("necessities_spend_pct", F.lit(0.0)).alias("necessities_spend_pct"),
        _code("spending_profile", PROFILE_CODE).alias("spending_profile_encoded"),
        *[F.when(c("customer_segment") == label, 1).otherwise(0).alias(name) for name, label in segment.items()],
        "tenure_months",
        F.when(c("total_transactions") > 0, c("lifetime_value") / c("total_transactions")).otherwise(0.0).alias("avg_spend_per_transaction"),
        F.when(c("credit_limit") > 0, c("avg_monthly_spend") / c("credit_limit") * 100).otherwise(0.0).alias("credit_utilization_pct"),
        F.when(age > 0, c("total_transactions") / age).otherwise(0.0).alias("transactions_per_day"),
        F.when(age > 0, c("lifetime_value") / age).otherwise(0.0).alias("spend_per_day"),
        F.when(c("days_since_last_transaction") <= 30, 0).when(c("days_since_last_transaction") <= 60, 1)
        .when(c("days_since_last_transaction") <= 90, 2).otherwise(3).alias("recency_score"),
        _code("recency_status", RECENCY_CODE, 3).alias("recency_status_encoded"),
        F.when(c("spend_prior_90_days") > 0, c("spend_last_90_days") / c("spend_prior_90_days")).otherwise(0.0).alias("spend_momentum"),
    )


def training_data(profile: DataFrame, labelled: DataFrame) -> DataFrame:
    """Features with labels, for customers with a positive baseline."""
    known = labelled.where(F.col("baseline_avg_spend") > 0).select(
        "customer_id", F.col("churned").cast("int").alias("churned"), "churn_reason", "baseline_avg_spend", "recent_avg_spend",
        F.col("days_since_last_transaction").alias("label_days_since_last_txn"),
    )
    return features(profile).join(known, "customer_id")


def held_out(key: str, seed: int, share: float) -> Column:
    """Whether a row belongs to the holdout: by a digest of its key and the seed, which any engine can recompute."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000 < int(share * 1000)


def train(data: DataFrame, seed: int = 7, holdout: float = 0.25, iterations: int = 10) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees on the named features; returns the model and the scored holdout.

    Features are listed by name, so label columns cannot slip in. The split hashes the customer, so it does not depend
    on partitioning or row order and a recomputed task draws the same rows.
    """
    data = data.select("customer_id", *NUMERIC, *CATEGORICAL, F.col("churned").cast("double").alias("label")).na.fill(0.0, list(NUMERIC))
    test = held_out("customer_id", seed, holdout)
    stages = [
        StringIndexer(inputCols=list(CATEGORICAL), outputCols=[f"{c}_ix" for c in CATEGORICAL], handleInvalid="keep", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=[*NUMERIC, *[f"{c}_ix" for c in CATEGORICAL]], outputCol="features", handleInvalid="keep"),
        GBTClassifier(maxIter=iterations, maxDepth=4, maxBins=64, seed=seed),
    ]
    model = Pipeline(stages=stages).fit(data.where(~test))
    return model, model.transform(data.where(test))


def importance(model: PipelineModel, spark) -> DataFrame:
    """Features by importance; the list is as long as the feature list."""
    names = [*NUMERIC, *CATEGORICAL]
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], "feature string, importance double")


def metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts, precision, recall and F1 of the positive class in one aggregate."""
    y, p = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    counts = scored.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")
    )
    tp = F.col("tp").cast("double")
    zero = F.lit(0)
    return counts.withColumns({
        "precision": F.coalesce(tp / F.nullif(F.col("tp") + F.col("fp"), zero), F.lit(0.0)),
        "recall": F.coalesce(tp / F.nullif(F.col("tp") + F.col("fn"), zero), F.lit(0.0)),
        "f1_score": F.coalesce(tp * 2 / F.nullif(F.col("tp") * 2 + F.col("fp") + F.col("fn"), zero), F.lit(0.0)),
    })


def gate(measured: DataFrame, f1: float = 0.50, precision: float = 0.60, recall: float = 0.40) -> DataFrame:
    """Whether a model may score."""
    verdict = (
        F.when(F.col("f1_score") < f1, "FAIL: F1 score too low").when(F.col("precision") < precision, "FAIL: Precision too low")
        .when(F.col("recall") < recall, "FAIL: Recall too low").otherwise("PASS: Model performance acceptable")
    )
    return measured.select(verdict.alias("validation_result"), "f1_score", "precision", "recall")


def score(model: PipelineModel, feats: DataFrame, as_of: dt.date) -> DataFrame:
    """Probability in percent and predicted class for every customer with features."""
    ready = feats.na.fill(0.0, list(NUMERIC))
    return model.transform(ready).select(
        "customer_id", (F.col("prediction") == 1).alias("predicted_churn"),
        (vector_to_array("probability")[1] * 100).alias("churn_risk_score"), on(as_of).alias("prediction_date"),
    )


def score_summary(predictions: DataFrame) -> DataFrame:
    """Count, share, mean, range and exact median of the scores, per risk band and for all customers."""
    band = F.when(F.col("churn_risk_score") >= 70, "High Risk").when(F.col("churn_risk_score") >= 40, "Medium Risk").otherwise("Low Risk")
    rows = predictions.select("churn_risk_score", F.explode(F.array(band, F.lit("All"))).alias("risk_category"))
    spread = rows.groupBy("risk_category").agg(
        F.count(F.lit(1)).alias("customer_count"), money_mean("churn_risk_score").alias("avg_risk_score"),
        F.min("churn_risk_score").alias("min_score"), F.max("churn_risk_score").alias("max_score"),
    )
    medians = percentiles(rows, ["risk_category"], {"churn_risk_score": {"median_score": 0.5}})
    # Every customer counts once in a band and once in 'All', so the total is half the sum.
    whole = F.sum("customer_count").over(Window.partitionBy()) / 2
    return spread.withColumn("pct_of_total", pct("customer_count", whole)).join(medians, "risk_category")


COMPLETENESS = ("age", "credit_limit", "avg_monthly_spend", "tenure_months", "travel_spend_pct", "spend_change_pct")


def validate_training(data: DataFrame, rows: tuple[int, int] = (40000, 1000), smaller: tuple[int, int] = (1000, 100)) -> DataFrame:
    """Checks of the training table from one aggregate: size, balance, gaps, ranges, completeness, class sizes.

    ``rows`` and ``smaller``: table and class sizes that pass, and that still are a warning.
    """
    c = F.col
    row = data.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("churned"), F.lit(0)).alias("churned"),
        F.count_if(c("age").isNull() | c("credit_limit").isNull() | c("avg_monthly_spend").isNull() | c("tenure_months").isNull()).alias("gaps"),
        *[F.count(f).alias(f"filled_{f}") for f in COMPLETENESS],
        *[agg(f).alias(f"{name}_{f}") for f in ("age", "credit_limit", "avg_monthly_spend", "credit_utilization_pct", "tenure_months", "total_transactions")
          for name, agg in (("min", F.min), ("max", F.max))],
    )
    churned, active = c("churned"), c("rows") - c("churned")
    rate = pct("churned", "rows")
    both = lambda n: (churned >= n) & (active >= n)
    return report(row, [
        ("row_count", c("rows"), banded_status(c("rows") >= rows[0], c("rows") >= rows[1])),
        ("churn_rate_pct", rate, passed(rate.between(8, 15), "WARNING")),
        ("rows_with_missing_features", c("gaps"), passed(c("gaps") == 0)),
        ("demographic_ranges", c("max_credit_limit"), passed(
            (c("min_age") >= 18) & (c("max_age") <= 100) & (c("min_credit_limit") >= 5000) & (c("max_credit_limit") <= 50000), "WARNING")),
        ("spending_ranges", c("max_avg_monthly_spend"), passed(
            (c("min_avg_monthly_spend") >= 0) & (c("min_credit_utilization_pct") >= 0) & (c("max_credit_utilization_pct") <= 150), "WARNING")),
        ("activity_ranges", c("max_total_transactions"), passed((c("min_tenure_months") >= 0) & (c("min_total_transactions") >= 5), "WARNING")),
        *[(f"complete {f}", pct(f"filled_{f}", "rows"),
           F.when(c(f"filled_{f}") == c("rows"), "COMPLETE").when(pct(f"filled_{f}", "rows") >= 95, "MOSTLY COMPLETE").otherwise("INCOMPLETE"))
          for f in COMPLETENESS],
        ("smaller_class", F.least(churned, active), banded_status(both(smaller[0]), both(smaller[1]))),
    ])


def class_means(data: DataFrame) -> DataFrame:
    """Feature means of churned and active customers."""
    kind = F.when(F.col("churned") == 1, "Churned").otherwise("Active").alias("customer_type")
    shown = ("age", "credit_limit", "avg_monthly_spend", "lifetime_value", "tenure_months", "days_since_last_transaction", "credit_utilization_pct")
    return data.groupBy(kind).agg(F.count(F.lit(1)).alias("customers"), *[stable_mean(f).alias(f"avg_{f}") for f in shown])


def churn_by_segment(data: DataFrame) -> DataFrame:
    """Churn rate per segment, read back from the one-hot columns."""
    segment = (
        F.when(F.col("segment_high_value_travelers") == 1, C.TRAVELERS).when(F.col("segment_declining") == 1, C.DECLINING)
        .when(F.col("segment_new_growing") == 1, C.GROWING).when(F.col("segment_budget_conscious") == 1, C.BUDGET)
        .when(F.col("segment_stable") == 1, C.STABLE).otherwise("Unknown")
    )
    return data.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("total_count"), F.sum("churned").alias("churned_count")
    ).withColumn("churn_rate_pct", pct("churned_count", "total_count"))


@dataclass
class Retrained:
    model: PipelineModel | None
    verdict: str
    predictions: DataFrame | None


def retrain(
    profile: DataFrame, labelled: DataFrame, as_of: dt.date, rows: tuple[int, int] = (40000, 1000),
    smaller: tuple[int, int] = (1000, 100), seed: int = 7,
) -> Retrained:
    """Validate the training table, train, pass the gate, score. Stops with the reason when a step fails."""
    data = training_data(profile, labelled)
    failed = [r["check_name"] for r in validate_training(data, rows, smaller).where("status = 'FAIL'").collect()]  # a row per check
    if failed:
        return Retrained(None, f"FAIL: training data: {', '.join(sorted(failed))}", None)
    model, held_out = train(data, seed)
    verdict = gate(metrics(held_out)).first()["validation_result"]
    if not verdict.startswith("PASS"):
        return Retrained(None, verdict, None)
    return Retrained(model, verdict, refresh(model, profile, as_of))


def refresh(model: PipelineModel | None, profile: DataFrame, as_of: dt.date) -> DataFrame:
    """Score with an existing model."""
    if model is None:
        raise ValueError("no trained model; run retrain first")
    return score(model, features(profile), as_of)
