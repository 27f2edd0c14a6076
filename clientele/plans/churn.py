"""Churn labels, features, model and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.operators import churn
from clientele.operators.setops import beside
from clientele.plans import inputs
from clientele.plans.catalog import query
from clientele.plans.oracle import AS_OF as AS_OF_SQL
from clientele.plans.oracle import avg, d, days, month_of, n, pct, sql, stable
from clientele.session import checkpointed, scratch
from clientele.sources.roles import AS_OF, transactions

# Windows widened to the sparse orders of the given tables (about ten per customer in six and a half years).
RULES = churn.LabelRules(baseline_from=72, baseline_to=12, baseline_months=3, recent_months=12, inactive_days=300, decline_ratio=0.30)

LABEL_SQL = f"""lm as (select customer_id, {month_of('transaction_date')} as month,
        sum(case when transaction_date >= {AS_OF_SQL} - interval 72 month and transaction_date < {AS_OF_SQL} - interval 12 month then amount end) as base,
        sum(case when transaction_date >= {AS_OF_SQL} - interval 12 month and transaction_date <= {AS_OF_SQL} then amount end) as recent,
        count(case when transaction_date >= {AS_OF_SQL} - interval 12 month and transaction_date <= {AS_OF_SQL} then 1 end) as recent_n,
        max(case when transaction_date >= {AS_OF_SQL} - interval 12 month and transaction_date <= {AS_OF_SQL} then transaction_date end) as last from txn where status = 'approved' group by 1, 2),
    lp as (select customer_id, {n('count(base)')} as baseline_months, {avg('base')} as baseline_avg_spend, {d('sum(base)')} as baseline_total_spend, {n('count(recent)')} as recent_months_active, {avg('recent')} as ravg,
        {d('sum(recent)')} as rsum, {n('sum(recent_n)')} as recent_transaction_count, max(last) as last_transaction_date from lm group by 1 having count(base) >= 3),
    lab as (select customer_id, baseline_months, baseline_avg_spend, baseline_total_spend, recent_months_active, coalesce(ravg, 0) as recent_avg_spend, coalesce(rsum, 0) as recent_total_spend, recent_transaction_count, last_transaction_date,
        case when last_transaction_date is null then 999 else {days('last_transaction_date', AS_OF_SQL)} end as days_since_last_transaction,
        case when baseline_avg_spend > 0 and ravg > 0 then (ravg - baseline_avg_spend) / baseline_avg_spend * 100 when ravg is null or ravg = 0 then -100.0::double else 0.0::double end as spend_change_pct,
        last_transaction_date is null or {days('last_transaction_date', AS_OF_SQL)} > 300 or coalesce(ravg < baseline_avg_spend * 0.3::double, false) as churned,
        case when last_transaction_date is null then 'No recent transactions' when {days('last_transaction_date', AS_OF_SQL)} > 300 then 'Inactive (300+ days)' when ravg < baseline_avg_spend * 0.3::double then 'Significant decline (< 30% baseline)' else 'Active' end as churn_reason from lp)"""
FEATURE_SQL = f"""feat as (select profile.customer_id, age, state, city, case when card_type = 'Premium' then 1 else 0 end::bigint as card_type_premium, credit_limit, employment_status, lifetime_value, avg_transaction_value, total_transactions,
        customer_age_days, profile.days_since_last_transaction, spend_last_90_days, spend_prior_90_days, profile.spend_change_pct, avg_monthly_spend, transaction_value_stddev, median_transaction_value,
        case spending_consistency when 'Moderate' then 1 when 'Variable' then 2 else 0 end::bigint as spending_consistency_encoded, coalesce(travel_spend_pct, 0) as travel_spend_pct, coalesce(necessities_spend_pct, 0) as necessities_spend_pct,
        case spending_profile when 'Travel-Focused' then 1 when 'Necessity-Focused' then 2 else 0 end::bigint as spending_profile_encoded,
        (customer_segment = 'High-Value Travelers')::bigint as segment_high_value_travelers, (customer_segment = 'Declining')::bigint as segment_declining, (customer_segment = 'New & Growing')::bigint as segment_new_growing,
        (customer_segment = 'Budget-Conscious')::bigint as segment_budget_conscious, (customer_segment = 'Stable Mid-Spenders')::bigint as segment_stable, tenure_months,
        case when total_transactions > 0 then lifetime_value / total_transactions else 0.0::double end as avg_spend_per_transaction, case when credit_limit > 0 then avg_monthly_spend / credit_limit * 100 else 0.0::double end as credit_utilization_pct,
        case when customer_age_days > 0 then cast(total_transactions as double) / customer_age_days else 0.0::double end as transactions_per_day, case when customer_age_days > 0 then lifetime_value / customer_age_days else 0.0::double end as spend_per_day,
        case when profile.days_since_last_transaction <= 30 then 0 when profile.days_since_last_transaction <= 60 then 1 when profile.days_since_last_transaction <= 90 then 2 else 3 end::bigint as recency_score,
        case recency_status when 'Active (30 days)' then 0 when 'Recent (60 days)' then 1 when 'At Risk (90 days)' then 2 else 3 end::bigint as recency_status_encoded,
        case when spend_prior_90_days > 0 then spend_last_90_days / spend_prior_90_days else 0.0::double end as spend_momentum, lab.churned::bigint as churned, churn_reason, baseline_avg_spend, recent_avg_spend,
        lab.days_since_last_transaction as label_days_since_last_txn from profile join lab on profile.customer_id = lab.customer_id where baseline_avg_spend > 0 and total_transactions >= 5)"""


def _labels(spark, folder):
    return churn.labels(transactions(spark, folder), AS_OF, RULES)


def _training(spark, folder, median=True):
    return churn.training_data(inputs.profile(spark, folder, median=median), _labels(spark, folder))


@query("ml_labels", sql(f"with {LABEL_SQL} select * from lab", "txn"))
def ml_labels(spark, folder):
    return _labels(spark, folder)


@query("ml_features", sql(f"with {LABEL_SQL}, {FEATURE_SQL} select * from feat", "txn", "profile"))
def ml_features(spark, folder):
    return _training(spark, folder)


@query("ml_validate_data", sql(
    f"""with {LABEL_SQL}, {FEATURE_SQL}, m as (select count(*) as rows, sum(churned) as ch, count(*) - sum(churned) as ac, count(*) filter (age is null or credit_limit is null or avg_monthly_spend is null or tenure_months is null) as gaps,
        {', '.join(f'count({f}) as f_{f}' for f in churn.COMPLETENESS)}, min(age) as a1, max(age) as a2, min(credit_limit) as c1, max(credit_limit) as c2, min(avg_monthly_spend) as s1, max(avg_monthly_spend) as s2,
        min(credit_utilization_pct) as u1, max(credit_utilization_pct) as u2, min(tenure_months) as t1, min(total_transactions) as n1, max(total_transactions) as n2 from feat)
    select 'row_count' as check_name, {d('rows')} as measured, case when rows >= 40000 then 'PASS' when rows >= 1000 then 'WARNING' else 'FAIL' end as status from m
    union all select 'churn_rate_pct', {pct('ch', 'rows')}, case when {pct('ch', 'rows')} between 8 and 15 then 'PASS' else 'WARNING' end from m
    union all select 'rows_with_missing_features', {d('gaps')}, case when gaps = 0 then 'PASS' else 'FAIL' end from m
    union all select 'demographic_ranges', {d('c2')}, case when a1 >= 18 and a2 <= 100 and c1 >= 5000 and c2 <= 50000 then 'PASS' else 'WARNING' end from m
    union all select 'spending_ranges', {d('s2')}, case when s1 >= 0 and u1 >= 0 and u2 <= 150 then 'PASS' else 'WARNING' end from m
    union all select 'activity_ranges', {d('n2')}, case when t1 >= 0 and n1 >= 5 then 'PASS' else 'WARNING' end from m
    union all """ + " union all ".join(
        f"select 'complete {f}', {pct(f'f_{f}', 'rows')}, case when f_{f} = rows then 'COMPLETE' when {pct(f'f_{f}', 'rows')} >= 95 then 'MOSTLY COMPLETE' else 'INCOMPLETE' end from m" for f in churn.COMPLETENESS)
    + f" union all select 'smaller_class', {d('least(ch, ac)')}, case when ch >= 1000 and ac >= 1000 then 'PASS' when ch >= 100 and ac >= 100 then 'WARNING' else 'FAIL' end from m", "txn", "profile"))
def ml_validate_data(spark, folder):
    return churn.validate_training(_training(spark, folder, median=False))


@query("ml_class_means", sql(
    f"""with {LABEL_SQL}, {FEATURE_SQL} select case when churned = 1 then 'Churned' else 'Active' end as customer_type, {n('count(*)')} as customers, """
    + ", ".join(f"{stable(f)} as avg_{f}" for f in ("age", "credit_limit", "avg_monthly_spend", "lifetime_value", "tenure_months", "days_since_last_transaction", "credit_utilization_pct"))
    + " from feat group by 1", "txn", "profile"))
def ml_class_means(spark, folder):
    return churn.class_means(_training(spark, folder, median=False))


@query("ml_churn_by_segment", sql(
    f"""with {LABEL_SQL}, {FEATURE_SQL} select case when segment_high_value_travelers = 1 then 'High-Value Travelers' when segment_declining = 1 then 'Declining' when segment_new_growing = 1 then 'New & Growing'
    when segment_budget_conscious = 1 then 'Budget-Conscious' else 'Stable Mid-Spenders' end as segment, {n('count(*)')} as total_count, {n('sum(churned)')} as churned_count, {pct('sum(churned)', 'count(*)')} as churn_rate_pct from feat group by 1""", "txn", "profile"))
def ml_churn_by_segment(spark, folder):
    return churn.churn_by_segment(_training(spark, folder, median=False))


@query("ml_gate", sql(
    f"""with {LABEL_SQL}, {FEATURE_SQL}, c as (select count(*) filter (churned = 1 and predicted_churn) as tp, count(*) filter (churned = 0 and predicted_churn) as fp, count(*) filter (churned = 1 and not predicted_churn) as fn from feat join pred using (customer_id)),
    m as (select cast(tp as double) / (tp + fp) as precision, cast(tp as double) / (tp + fn) as recall, cast(tp as double) * 2 / (tp * 2 + fp + fn) as f1_score from c)
    select case when f1_score < 0.5 then 'FAIL: F1 score too low' when precision < 0.6 then 'FAIL: Precision too low' when recall < 0.4 then 'FAIL: Recall too low' else 'PASS: Model performance acceptable' end as validation_result, * from m""", "txn", "profile", "pred"))
def ml_gate(spark, folder):
    """Gate applied to the idle-time scores, which SQL can recompute."""
    who = checkpointed(inputs.profile(spark, folder))
    scores = who.where("predicted_churn is not null").select("customer_id", F.col("predicted_churn").cast("int").alias("prediction"))
    truth = churn.training_data(who, _labels(spark, folder)).select("customer_id", F.col("churned").alias("label"))
    return churn.gate(churn.metrics(truth.join(scores, "customer_id")))


@query("ml_score_summary", sql(
    f"""with r as (select churn_risk_score, unnest([case when churn_risk_score >= 70 then 'High Risk' when churn_risk_score >= 40 then 'Medium Risk' else 'Low Risk' end, 'All']) as risk_category from pred)
    select risk_category, {n('count(*)')} as customer_count, {pct('count(*)', '(select count(*) from pred)')} as pct_of_total, {avg('cast(churn_risk_score as decimal(28,2))')} as avg_risk_score,
    min(churn_risk_score) as min_score, max(churn_risk_score) as max_score, quantile_cont(churn_risk_score, 0.5) as median_score from r group by 1""", "pred"))
def ml_score_summary(spark, folder):
    return churn.score_summary(inputs.scores_from(inputs.segments(spark, folder)))


def _prepared(spark, folder):
    """The profile with labels as a checkpoint: the training passes read it many times."""
    return checkpointed(_training(spark, folder))


HELD_SQL = "('0x' || substr(md5(customer_id || ':7'), 1, 8))::ubigint % 1000 < 250"
SCORED_SQL = "(select count(*) from profile where total_transactions >= 5)"


@query("ml_train", sql(
    f"""with {LABEL_SQL}, {FEATURE_SQL} select {n('count(*)')} as rows, {n(f'count(*) filter ({HELD_SQL})')} as holdout_rows, {n(f'count(*) filter ({HELD_SQL} and churned = 1)')} as holdout_churned,
    true as metrics_in_range, true as gate_follows_metrics, true as features_used from feat""", "txn", "profile"))
def ml_train(spark, folder):
    """Sizes of the split and its classes, and whether the measured model is consistent: what does not depend on the fit."""
    data = _prepared(spark, folder)
    model, held = churn.train(data)
    measured = churn.metrics(held)
    counts = measured.select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("holdout_rows"), (F.col("tp") + F.col("fn")).alias("holdout_churned"))
    share = F.col("f1_score").between(0, 1) & F.col("precision").between(0, 1) & F.col("recall").between(0, 1)
    good = (F.col("f1_score") >= 0.5) & (F.col("precision") >= 0.6) & (F.col("recall") >= 0.4)
    checks = churn.gate(measured).select(share.alias("metrics_in_range"), (good == F.col("validation_result").startswith("PASS")).alias("gate_follows_metrics"))
    used = churn.importance(model, spark).agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("features_used"))
    return beside(data.agg(F.count(F.lit(1)).alias("rows")), counts, checks, used)


@query("ml_train_metrics")
def ml_train_metrics(spark, folder):
    """Holdout metrics of a trained model with its most important feature."""
    model, held = churn.train(_prepared(spark, folder))
    measured = churn.metrics(held)
    ranked = churn.importance(model, spark).where(F.col("importance") > 0).agg(F.max_by("feature", "importance").alias("top_feature"), F.count(F.lit(1)).alias("used_features"))
    return beside(churn.gate(measured), measured.select("tp", "fp", "fn", "tn"), ranked)


def _scores(spark, folder):
    who = checkpointed(inputs.profile(spark, folder, median=True))
    model, _ = churn.train(churn.training_data(who, _labels(spark, folder)))
    return model, who


@query("ml_score", sql(f"select customer_id, {AS_OF_SQL} as prediction_date, true as in_range, true as flag_follows_score from profile where total_transactions >= 5", "profile"))
def ml_score(spark, folder):
    """Every customer with features is scored once, from 0 to 100, and predicted to leave exactly above 50."""
    model, who = _scores(spark, folder)
    score = F.col("churn_risk_score")
    return churn.score(model, churn.features(who), AS_OF).select(
        "customer_id", "prediction_date", score.between(0, 100).alias("in_range"), (F.col("predicted_churn") == (score > 50)).alias("flag_follows_score")
    )


@query("ml_score_rows")
def ml_score_rows(spark, folder):
    model, who = _scores(spark, folder)
    return churn.score(model, churn.features(who), AS_OF)


@query("ml_retrain", sql(f"select true as consistent, {n(SCORED_SQL)} as to_score", "profile"))
def ml_retrain(spark, folder):
    """Labels, validation, training, gate and scoring in one job: all customers with features are scored if the verdict is PASS, none
    otherwise."""
    who = checkpointed(inputs.profile(spark, folder, median=True))
    result = churn.retrain(who, _labels(spark, folder), AS_OF, rows=(1000, 50), smaller=(100, 5))
    expected = churn.features(who).agg(F.count(F.lit(1)).alias("to_score"))
    if result.predictions is None:
        return expected.select(F.lit(not result.verdict.startswith("PASS")).alias("consistent"), "to_score")
    done = result.predictions.agg(F.count_distinct("customer_id").alias("scored"))
    passed = F.lit(result.verdict.startswith("PASS"))
    return beside(done, expected).select((passed & (F.col("scored") == F.col("to_score"))).alias("consistent"), "to_score")


@query("ml_refresh", sql(f"select {n(SCORED_SQL)} as customers, true as in_range, true as same_as_before", "profile"))
def ml_refresh(spark, folder):
    """A saved model is loaded again and scores the current profile, as the model in memory does."""
    from pyspark.ml import PipelineModel

    model, who = _scores(spark, folder)
    path = scratch(spark, "churn-model")
    model.write().save(path)
    before = churn.refresh(model, who, AS_OF).select("customer_id", F.col("churn_risk_score").alias("before"))
    after = churn.refresh(PipelineModel.load(path), who, AS_OF).join(before, "customer_id", "full")
    same = F.col("churn_risk_score").eqNullSafe(F.col("before"))
    return after.agg(
        F.count("churn_risk_score").alias("customers"), F.every(F.col("churn_risk_score").between(0, 100)).alias("in_range"), F.every(same).alias("same_as_before")
    )
