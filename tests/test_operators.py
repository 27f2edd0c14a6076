"""Golden rows, edges and invariants of the operators on small hand-made tables."""

import datetime as dt
import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientele.functions import columns as K
from clientele.functions import text as X
from clientele.functions.dates import months_before, months_between_boundaries
from clientele.operators import campaign, cdc, churn, policy, quality, reports, reshape, scd, semantic, setops, suites, telemetry
from clientele.operators import customer as C
from clientele.operators import windows as W
from clientele.operators.dedupe import deduplicate, latest_per_key
from clientele.operators.selection import percentiles

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- columns ----


def test_month_boundaries(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 2, 1)), (D(2023, 12, 31), D(2024, 1, 1)), (D(2024, 3, 1), D(2024, 3, 31))], "a date, b date")
    assert [r[0] for r in df.select(months_between_boundaries("a", "b")).collect()] == [1, 1, 0]
    assert months_before(D(2024, 3, 31), 1) == D(2024, 2, 29)
    assert months_before(D(2024, 1, 15), 13) == D(2022, 12, 15)


def test_surrogate_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(K.surrogate_key("x", "y")).distinct().count() == 2
    assert df.select(K.surrogate_key("x", "y", null_as_empty=True)).distinct().count() == 1


def test_width_bucket_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (9.99,), (10.0,)], "v double")
    assert [r[0] for r in df.select(K.width_bucket("v", 0, 10, 5)).collect()] == [0, 1, 3, 5, 6]


def test_url_parts(spark):
    urls = ["https://a.com/x/y?p=1&q=2", "http://a.com?p=", "a.com", "android-app://app/z"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(X.url_host("u"), X.url_path("u"), X.url_parameter("u", "p")).collect()]
    assert got[0] == ("a.com", "x/y", "1")
    assert got[1][0] == "a.com" and got[1][2] is None
    assert got[2][0] == "a.com" and got[3][0] == "app"


def test_formats(spark):
    df = spark.createDataFrame([(1024.0, 999, 500.0), (1025.0, 1500, 61000.0), (5 * 1024.0**3, 2_340_000, 3_661_000.0)], "b double, n long, ms double")
    got = [tuple(r) for r in df.select(X.format_bytes("b"), X.format_count("n"), X.format_millis("ms")).collect()]
    assert got == [("1024", "999", "500ms"), ("1KB", "1.5 K", "1m 1s"), ("5GB", "2.3 Million", "1h 1m 1s")]


def test_headings():
    assert X.heading("avg_ltv") == "Average Lifetime Value"
    assert X.heading("DAYS_SINCE_LAST_TRANSACTION") == "Days Since Last Transaction"
    assert K.slugify("1 A-b!") == "_1_a_b"


# ---- skew-safe ordering ----


def skewed(spark, n=6000):
    """One key owns a third of the rows, with many equal values."""
    rnd = random.Random(3)
    data = []
    for i in range(n):
        key = 0 if i < n // 3 else rnd.randrange(1, 40)
        data.append((key, i, round(rnd.uniform(-500, 5000), 2) if rnd.random() < 0.7 else 100.0))
    return data, spark.createDataFrame(data, "k long, i long, v double").repartition(8)


def interpolated(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_exact_percentiles_match_brute_force(spark):
    data, df = skewed(spark)
    groups = {}
    for k, _, v in data:
        groups.setdefault(k, []).append(v)
    for most in (300, 10**9):
        got = {r["k"]: r for r in percentiles(df, ["k"], {"v": {"a": 0.25, "b": 0.5, "c": 0.9}}, most=most).collect()}
        assert set(got) == set(groups)
        for k, values in groups.items():
            for name, p in (("a", 0.25), ("b", 0.5), ("c", 0.9)):
                assert got[k][name] == pytest.approx(interpolated(values, p))


def test_percentiles_of_counted_rows(spark):
    df = spark.createDataFrame([("a", float(i % 7), i % 3 + 1) for i in range(60)], "k string, v double, n long")
    plain = df.select("k", "v", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    want = percentiles(plain, ["k"], {"v": {"m": 0.4}}).collect()
    for most in (20, 10**9):
        assert percentiles(df, ["k"], {"v": {"m": 0.4}}, "n", most).collect() == want


def spread(kind):
    r = random.Random(kind)
    return {
        "one cent range": [7 + r.randrange(100) / 10_000 for _ in range(3000)],
        "one value": [5.25] * 2500,
        "two values": [0.0] * 1500 + [1.0] * 1500,
        "over 1e12": [1e12 * r.random() ** 8 * 1e4 + r.randrange(5) for _ in range(3000)],
        "many sizes": [r.choice([-1, 1]) * 10 ** r.uniform(-300, 300) for _ in range(3000)],
        "cluster and far values": [-1e15, 1e18] + [1e-3 * r.random() for _ in range(3000)],
        "next doubles": [math.nextafter(1e16, math.inf, steps=r.randrange(3000)) for _ in range(3000)],
    }[kind]


@pytest.mark.parametrize("kind", ["one cent range", "one value", "two values", "over 1e12", "many sizes", "cluster and far values", "next doubles"])
def test_selection_sizes_itself(spark, kind):
    values = spread(kind)
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None), (None, 3.0)], "k string, v double").repartition(4)
    shares = {"lo": 0.0, "q": 0.25, "m": 0.5, "p": 0.9, "hi": 1.0}
    got = {r["k"]: r.asDict() for r in percentiles(df, ["k"], {"v": shares}, most=100).collect()}
    for name, p in shares.items():
        assert got["a"][name] == pytest.approx(interpolated(values, p), rel=1e-12)
        assert got["b"][name] is None and got[None][name] == 3.0
    whole = percentiles(df.where("k = 'a'"), [], {"v": shares}, most=100).first()
    assert all(whole[n] == got["a"][n] for n in shares)


def test_summary_with_median_reads_the_fact_once(spark):
    """A customer with most of the rows, a NULL amount and a single row: the same numbers as the plain aggregate."""
    r = random.Random(8)
    days = [D(2024, 1, 1) + dt.timedelta(days=r.randrange(300)) for _ in range(600)]
    data = [(1 if i % 3 else i % 20, d, Decimal(r.randrange(1, 90000)) / 100, r.choice(["Travel", "Gas", "Other"])) for i, d in enumerate(days)]
    data += [(1, D(2024, 5, 5), None, "Gas"), (99, D(2024, 5, 5), Decimal("3.50"), "Gas")]
    fact = spark.createDataFrame(data, "customer_id long, transaction_date date, amount decimal(18,2), category_name string")
    for most in (100, 10**9):
        same_as_plain(fact, data, most)


def same_as_plain(fact, data, most):
    got = {x["customer_id"]: x.asDict() for x in C.customer_summary(fact, D(2024, 10, 1), most=most).collect()}
    want = {x["customer_id"]: x.asDict() for x in C.customer_summary(fact, D(2024, 10, 1), median=False).collect()}
    for k, w in want.items():
        amounts = [float(a) for c, _, a, _ in data if c == k and a is not None]
        assert got[k].pop("median_transaction_value") == pytest.approx(statistics.median(amounts), abs=1e-4)
        w.pop("median_transaction_value")
        assert got[k] == w


@pytest.mark.parametrize("ascending", [True, False])
def test_global_rank_matches_brute_force(spark, ascending):
    data, df = skewed(spark)
    values = sorted((v for _, _, v in data), reverse=not ascending)
    want = {}
    for at, v in enumerate(values, 1):
        want.setdefault(v, at)
    for most in (100, 10**9):
        got = W.global_ranks(df, {"r": ("v", ascending), "other": ("i", not ascending)}, most).collect()
        assert len(got) == len(data) and all(r["r"] == want[r["v"]] for r in got)
        assert sorted(r["other"] for r in got) == list(range(1, len(data) + 1))


def test_rows_without_a_value_have_no_rank(spark):
    df = spark.createDataFrame([(i, float(i % 5) if i % 7 else None) for i in range(80)], "i long, v double")
    for most in (10, 10**9):
        got = {r["i"]: r["r"] for r in W.global_ranks(df, {"r": ("v", False)}, most).collect()}
        values = sorted((float(i % 5) for i in range(80) if i % 7), reverse=True)
        assert got == {i: values.index(float(i % 5)) + 1 if i % 7 else None for i in range(80)}


def test_global_row_number_is_a_permutation_in_order(spark):
    rnd = random.Random(5)
    data = [(D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(5)), rnd.randrange(1000), i) for i in range(2000)]
    df = spark.createDataFrame(data, "d date, c long, t long").repartition(7)
    got = {r["t"]: r["n"] for r in W.global_row_number(df, "d", "c", "t", "n", ranges=20).collect()}
    assert [got[t] for _, _, t in sorted(data)] == list(range(1, 2001))


# ---- dedupe ----


def test_latest_per_key_and_mixed_order(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, 9, None), (None, 4, "n")], "k long, t long, s string")
    assert {tuple(r) for r in latest_per_key(df, ["k"], ["t", "s"]).collect()} == {(1, 3, "c"), (2, 9, None), (None, 4, "n")}
    assert {tuple(r) for r in deduplicate(df, ["k"], [("t", "desc"), ("s", "asc")]).collect()} == {(1, 3, "b"), (2, 9, None), (None, 4, "n")}


# ---- segments and summary ----


def segment_row(**kw):
    base = dict(avg_monthly_spend=2000.0, travel_spend_pct=0.0, spend_change_pct=0.0, spend_prior_90_days=0.0, tenure_months=20, necessities_spend_pct=0.0)
    return {**base, **kw, "metric_calculated_date": D(2024, 1, 1)}


def test_segment_edges(spark):
    cases = [
        (segment_row(avg_monthly_spend=5000.0, travel_spend_pct=25.0, spend_change_pct=-90.0, spend_prior_90_days=9000.0), C.TRAVELERS),
        (segment_row(avg_monthly_spend=4999.99, travel_spend_pct=25.0), C.STABLE),
        (segment_row(spend_change_pct=-30.0, spend_prior_90_days=2000.0), C.DECLINING),
        (segment_row(spend_change_pct=-30.0, spend_prior_90_days=1999.0), C.STABLE),
        (segment_row(tenure_months=6, spend_change_pct=50.0), C.GROWING),
        (segment_row(avg_monthly_spend=1499.0, necessities_spend_pct=60.0), C.BUDGET),
        (segment_row(avg_monthly_spend=1500.0, necessities_spend_pct=60.0), C.STABLE),
    ]
    df = spark.createDataFrame([{**c, "i": i} for i, (c, _) in enumerate(cases)])
    got = {r["i"]: r["customer_segment"] for r in C.assign_segments(df).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_summary_windows_and_single_row(spark):
    as_of = D(2024, 7, 1)
    data = [
        (1, as_of - dt.timedelta(days=90), Decimal("100.00"), "Travel"), (1, as_of - dt.timedelta(days=91), Decimal("50.00"), "Grocery"),
        (1, as_of - dt.timedelta(days=181), Decimal("50.00"), "Dining"), (2, as_of, Decimal("10.00"), "Gas"),
    ]
    fact = spark.createDataFrame(data, "customer_id long, transaction_date date, amount decimal(18,2), category_name string")
    got = {r["customer_id"]: r for r in C.customer_summary(fact, as_of).collect()}
    one, two = got[1], got[2]
    assert (one["spend_last_90_days"], one["spend_prior_90_days"], one["spend_change_pct"]) == (100.0, 50.0, 100.0)
    assert (one["travel_spend_pct"], one["necessities_spend_pct"], one["median_transaction_value"]) == (50.0, 25.0, 50.0)
    assert two["transaction_value_stddev"] is None and two["spending_consistency"] == "No Transactions"
    assert two["avg_spend_per_day"] == 0.0 and two["median_transaction_value"] == 10.0


def test_snapshots_at_two_dates_equal_two_runs(spark):
    data = [(c, D(2024, m, 5), Decimal(c * 100 + m), "Travel" if m % 2 else "Gas") for c in range(1, 6) for m in range(1, 7)]
    fact = spark.createDataFrame(data, "customer_id long, transaction_date date, amount decimal(18,2), category_name string")
    days = [D(2024, 4, 1), D(2024, 7, 1)]
    both = C.customer_summary(C.at_dates(fact, days), "as_of")
    for day in days:
        alone = C.customer_summary(fact.where(F.col("transaction_date") < F.lit(day)), day)
        mine = both.where(F.col("as_of") == F.lit(day)).drop("as_of")
        assert sorted(map(tuple, mine.select(alone.columns).collect())) == sorted(map(tuple, alone.collect()))


# ---- campaigns ----


def test_roi_figures(spark):
    targets = spark.createDataFrame([(1000.0,), (3000.0,)] * 50, "lifetime_value double")
    r = campaign.campaign_roi(targets, incentive=50, cost=5, rate=30).first()
    assert (r["num_customers"], r["total_cost"], r["expected_retained_customers"]) == (100, 5500.0, 30)
    assert r["expected_retained_value"] == pytest.approx(12000) and r["roi_pct"] == pytest.approx((12000 - 5500) / 5500 * 100)
    assert campaign.breakeven_rate(targets, 50, 5).first()[0] == 14
    none = targets.where("lifetime_value < 0")
    assert campaign.campaign_roi(none, 50, 5, 30).first()["roi_pct"] == 0.0


def test_audience_ignores_empty_lists(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9)], "s string, v long")
    assert rows(campaign.audience(df, {"s": []}, {}), "s") == [("a",), ("b",)]
    assert rows(campaign.audience(df, {"s": ["a' or '1'='1"]}, {}), "s") == []
    assert rows(campaign.audience(df, {"s": ["a", "b"]}, {"v": 6}), "s") == [("b",)]


# ---- history ----

TRACK = scd.Tracking("id", ("card",), ("email", "note"), blank_aware=("note",), surrogate="sk")
DIM = "sk string, id long, card string, email string, note string, valid_from date, valid_to date, is_current boolean, updated_on date"


def history(spark, data):
    return spark.createDataFrame([(f"k{i}", *r, r[4]) for i, r in enumerate(data)], DIM)


def dimension(spark):
    start = D(2024, 1, 1)
    return history(spark, [
        (1, "S", "a", None, start, None, True), (2, "S", "b", None, start, None, True), (3, "P", "c", "x", start, None, True),
        (4, "S", "d", None, start, None, True), (5, "S", "e", None, start, D(2024, 2, 1), False), (5, "P", "e", None, D(2024, 2, 2), None, True),
    ])


def snapshot(spark):
    return spark.createDataFrame([
        (1, "P", "a", None), (2, "S", "B", None), (3, None, "c", ""), (5, "P", "e", None), (6, "S", "f", None),
    ], "id long, card string, email string, note string")


def test_scd_merge_golden(spark):
    day = D(2024, 6, 1)
    merged = scd.scd2_merge(dimension(spark), snapshot(spark), TRACK, day)
    got = rows(merged.select("id", F.coalesce("card", F.lit("-")).alias("card"), "email", F.col("valid_from").cast("string").alias("f"),
                             F.coalesce(F.col("valid_to").cast("string"), F.lit("-")).alias("t"), "is_current"), "id", "card", "email", "f", "t", "is_current")
    assert got == [
        (1, "P", "a", "2024-06-01", "-", True), (1, "S", "a", "2024-01-01", "2024-05-31", False),
        (2, "S", "B", "2024-01-01", "-", True), (3, "P", "c", "2024-01-01", "-", True), (4, "S", "d", "2024-01-01", "-", True),
        (5, "P", "e", "2024-02-02", "-", True), (5, "S", "e", "2024-01-01", "2024-02-01", False), (6, "S", "f", "2024-06-01", "-", True),
    ]
    assert quality.scd_one_current(merged, "id").count() == 0
    assert quality.scd_gaps(merged, "id").count() == 0


def test_scd_merge_is_idempotent_and_replaces_same_day(spark):
    day = D(2024, 6, 1)
    once = scd.scd2_merge(dimension(spark), snapshot(spark), TRACK, day)
    again = scd.scd2_merge(once, snapshot(spark), TRACK, day)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    back = snapshot(spark).withColumn("card", F.when(F.col("id") == 1, "X").otherwise(F.col("card")))
    third = scd.scd2_merge(once, back, TRACK, day).where("id = 1")
    assert rows(third, "card", "is_current") == [("S", False), ("X", True)]


def test_scd_gap_into_current_version_is_found(spark):
    dim = history(spark, [(1, "S", "a", None, D(2024, 1, 1), D(2024, 2, 1), False), (1, "P", "a", None, D(2024, 2, 5), None, True)])
    found = quality.scd_gaps(dim, "id").collect()
    assert len(found) == 1 and found[0]["gap_days"] == 3


# ---- change capture ----


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


CHANGES = "id long, label string, update_timestamp timestamp_ntz, action string, is_update boolean"
HISTORY = "id long, label string, start_time timestamp_ntz, end_time timestamp_ntz, current_flag int"


def test_cdc_insert_update_delete(spark):
    empty = spark.createDataFrame([], HISTORY)
    inserts = spark.createDataFrame([(1, "a", ts(1), "INSERT", False), (2, "b", ts(1), "INSERT", False)], CHANGES)
    state = cdc.merge_history(empty, cdc.classify(inserts, empty, ["label"], ts(2)), ["label"])
    assert rows(state, "id", "label", "current_flag") == [(1, "a", 1), (2, "b", 1)]

    update = spark.createDataFrame([(1, "a2", ts(3), "INSERT", True), (1, "a", ts(3), "DELETE", True)], CHANGES)
    state = cdc.merge_history(state, cdc.classify(update, state, ["label"], ts(4)), ["label"])
    one = rows(state.where("id = 1"), "label", "start_time", "end_time", "current_flag")
    assert one == [("a", ts(1), ts(3), 0), ("a2", ts(3), cdc.OPEN_END, 1)]

    delete = spark.createDataFrame([(2, "b", ts(5), "DELETE", False)], CHANGES)
    state = cdc.merge_history(state, cdc.classify(delete, state, ["label"], ts(6)), ["label"])
    assert rows(state.where("id = 2"), "end_time", "current_flag") == [(ts(6), 0)]
    again = cdc.merge_history(state, cdc.classify(delete, state, ["label"], ts(6)), ["label"])
    assert sorted(map(str, again.collect())) == sorted(map(str, state.collect()))


def test_upsert_deletes_updates_inserts_once(spark):
    target = spark.createDataFrame([(1, 10, "x"), (2, 20, "x"), (3, 30, "x")], "id long, v long, keep string")
    batch = spark.createDataFrame([
        (1, 11, "INSERT", 1), (1, 12, "INSERT", 2), (2, 0, "DELETE", 1), (4, 40, "INSERT", 1), (5, 0, "DELETE", 1),
    ], "id long, v long, action string, at long")
    once = cdc.upsert(target, batch, ["id"], ["at"], ["v"], "action")
    assert {tuple(r) for r in once.collect()} == {(1, 12, "x"), (3, 30, "x"), (4, 40, None)}
    assert sorted(map(str, cdc.upsert(once, batch, ["id"], ["at"], ["v"], "action").collect())) == sorted(map(str, once.collect()))


# ---- reshape, sets, quality ----


def test_pivot_else_value_and_distinct(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red")], "size string, color string")
    got = df.groupBy("size").agg(*reshape.pivot_columns("color", ["red", "blue"])).orderBy("size").collect()
    assert [tuple(r) for r in got] == [("M", 1, 0), ("S", 2, 1)]


def test_unpivot_keeps_and_drops(spark):
    df = spark.createDataFrame([(1, True, "a", 5)], "id long, flag boolean, name string, n long")
    got = rows(reshape.unpivot(df, exclude=["id"], remove=["name"]), "id", "field_name", "value")
    assert got == [(1, "flag", "true"), (1, "n", "5")]


def test_date_spine_excludes_end(spark):
    got = rows(reshape.date_spine(spark, "day", D(2024, 1, 30), D(2024, 2, 2)), "date_day")
    assert [r[0] for r in got] == [D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1)]
    assert reshape.date_spine(spark, "month", D(2024, 1, 1), D(2024, 1, 1)).count() == 0


def test_column_values_by_frequency(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    assert [r[0] for r in reshape.column_values(df, "x", limit=2).collect()] == ["b", "a"]


def test_union_relations_rejects_both_lists(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        setops.union_relations({"a": df}, include=["id"], exclude=["id"])


def test_except_both_is_distinct(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x long")
    b = spark.createDataFrame([(2,), (3,)], "x long")
    assert {tuple(r) for r in setops.except_both(a, b).collect()} == {("a_minus_b", 1), ("a_minus_b", None), ("b_minus_a", 3)}


def test_ranges_gap_rules(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 12, 15), (2, 3, 3)], "k long, lo long, hi long")
    bad = lambda **kw: rows(quality.mutually_exclusive_ranges(df, "lo", "hi", ["k"], **kw), "k", "lo")
    assert bad() == [(2, 3)]
    assert bad(gaps="not_allowed", zero_length=True) == [(1, 5)]
    assert bad(gaps="required", zero_length=True) == [(1, 0)]
    with pytest.raises(ValueError):
        quality.mutually_exclusive_ranges(df, "lo", "hi", ["k"], gaps="some")


def test_null_rules_of_checks(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None)], "k long, v long")
    assert quality.accepted_range(df, "v", 0, 4).count() == 1
    assert quality.expression_is_true(df, "v > 9").count() == 1
    assert rows(quality.at_least_one(df, "v", ["k"]), "k") == [(2,)]
    assert rows(quality.not_constant(df, "v", ["k"]), "k") == [(1,)]
    assert rows(quality.not_null_proportion(df, "v", 0.4, keys=["k"]), "k") == [(2,)]


def test_relationships_count_orphans(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "c long")
    parent = spark.createDataFrame([(1,)], "p long")
    assert rows(quality.relationships_where(child, "c", parent, "p"), "id", "n_records") == [(7, 2)]


# ---- policies, metric layer, churn ----


def test_masks_by_role(spark):
    df = policy.tag_columns(spark.createDataFrame([("a@b.com", "Ann", 1)], "email string, name string, n long"), {"email": policy.HIGH, "name": policy.CONFIDENTIAL})
    seen = lambda roles: tuple(policy.mask_by_tag(df, roles).first())
    assert seen([]) == (policy.MASKED, policy.MASKED, 1)
    assert seen([policy.CONFIDENTIAL]) == ("*****@b.com", "Ann", 1)
    assert seen([policy.HIGH, policy.CONFIDENTIAL]) == ("a@b.com", "Ann", 1)


def test_row_policy_keeps_rows_single(spark):
    data = spark.createDataFrame([("IL", 1), ("TX", 2), ("NY", 3)], "state string, n long")
    mapping = spark.createDataFrame([("r1", "IL"), ("r2", "IL"), ("r2", "NY")], "role string, state string")
    assert rows(policy.row_policy(data, [(mapping, "state", "state")], ["r1", "r2"]), "n") == [(1,), (3,)]
    assert policy.row_policy(data, [(mapping, "state", "state")], []).count() == 0


def test_metric_rejects_unknown_paths(spark):
    with pytest.raises(ValueError):
        semantic.metric({"monthly_spending": spark.range(1)}, "monthly_spending", ["total_spend"], ["merchant_categories.category_group"])


def test_labels_do_not_multiply_by_months(spark):
    as_of = D(2024, 7, 1)
    data = [(1, D(2023, m, 10), Decimal("100.00"), "approved") for m in range(2, 9)]
    data += [(1, D(2024, 5, 10), Decimal("40.00"), "approved"), (1, D(2024, 6, 10), Decimal("40.00"), "approved"), (1, D(2024, 6, 11), Decimal("20.00"), "approved")]
    data += [(2, D(2023, m, 10), Decimal("100.00"), "approved") for m in range(2, 9)] + [(3, D(2023, 3, 1), Decimal("9.00"), "approved")]
    txn = spark.createDataFrame(data, "customer_id long, transaction_date date, amount decimal(18,2), status string")
    got = {r["customer_id"]: r for r in churn.labels(txn, as_of).collect()}
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one["recent_total_spend"], one["recent_transaction_count"], one["recent_avg_spend"], one["churned"]) == (100.0, 3, 50.0, False)
    assert (two["days_since_last_transaction"], two["churn_reason"], two["spend_change_pct"]) == (999, "No recent transactions", -100.0)


def test_leaking_columns_are_not_features():
    assert not set(churn.LEAKING) & {*churn.NUMERIC, *churn.CATEGORICAL}


def test_gate_and_refresh_without_model(spark):
    scored = spark.createDataFrame([(1.0, 1.0)] * 3 + [(0.0, 0.0)] * 5 + [(1.0, 0.0)], "label double, prediction double")
    m = churn.metrics(scored).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (3, 0, 1, 5) and m["recall"] == 0.75
    assert churn.gate(churn.metrics(scored)).first()["validation_result"].startswith("PASS")
    with pytest.raises(ValueError):
        churn.refresh(None, scored, D(2024, 1, 1))


def test_reports_keep_null_and_all_null_groups(spark):
    rows = [("a", 1.0, 5.0), ("a", 3.0, 7.0), (None, 2.0, 6.0), ("z", None, None)]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    five = {r["k"]: (r["median"], r["max_value"]) for r in reports.five_numbers(df, ["k"], "v").collect()}
    assert five == {"a": (2.0, 3.0), None: (2.0, 2.0), "z": (None, None)}
    usage = {r["k"]: (r["count_queries"], r["median_elapsed"], r["median_volume"]) for r in reports.usage_statistics(df, ["k"], "v", "w").collect()}
    assert usage == {"a": (2, 2.0, 6.0), None: (1, 2.0, 6.0), "z": (1, None, None)}


def test_deduplicate_takes_nulls_last_in_every_direction(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, None), (1, 5, 2)], "k long, t long, s long")
    for first in ("asc", "desc"):
        for second in ("asc", "desc"):
            assert [tuple(r) for r in deduplicate(df, ["k"], [("t", first), ("s", second)]).collect()] == [(1, 5, 2)]
    only = spark.createDataFrame([(1, None, 1)], "k long, t long, s long")
    assert [tuple(r) for r in deduplicate(only, ["k"], [("t", "asc"), ("s", "desc")]).collect()] == [(1, None, 1)]


# ---- suites and loads ----


def test_transaction_measures_in_one_pass(spark):
    """Repeated and missing ids, orphans, customers without transactions and a customer row without an id."""
    day = D(2024, 1, 1)
    data = [(1, 10, day, Decimal("5.00")), (1, 10, day, Decimal("7.00")), (2, 10, None, Decimal("-1.00")), (3, 11, D(2030, 1, 1), None), (None, 12, day, Decimal("99999.00")), (4, None, day, Decimal("1.00"))]
    txn = spark.createDataFrame([(*r, dt.datetime(2024, 1, 2)) for r in data], "transaction_id long, customer_id long, transaction_date date, amount decimal(18,2), ingestion_timestamp timestamp_ntz")
    who = spark.createDataFrame([(10,), (11,), (13,), (14,), (None,)], "customer_id long")
    got = suites.transaction_measures(txn, who, D(2025, 1, 1)).first().asDict()
    assert got == {
        "rows": 6, "null_customers": 1, "null_dates": 1, "null_amounts": 1, "null_ingestion": 0, "future": 1, "not_positive": 1, "high_amounts": 1,
        "customers_seen": 3, "customers_missing": 3, "orphan_customers": 1, "orphan_rows": 2, "min_amount": Decimal("-1.00"), "max_amount": Decimal("99999.00"),
        "total_amount": Decimal("100011.00"), "first_day": day, "last_day": D(2030, 1, 1), "duplicate_rows": 2, "null_transactions": 1,
    }
    empty = suites.transaction_measures(txn.limit(0), who.limit(0), D(2025, 1, 1)).first()
    assert empty["rows"] == 0 and empty["duplicate_rows"] == 0 and empty["customers_missing"] == 0


def test_metrics_are_observed_while_a_table_is_loaded(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (1, None), (None, 3.5), (2, 1.0)], "k long, v double").repartition(3)
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("k").isNull()).alias("no_key"), F.sum("v").alias("total")]
    loaded, seen = telemetry.observed_load(df, str(tmp_path / "a"), metrics)
    assert seen == {"rows": 4, "no_key": 1, "total": 6.5} and loaded.count() == 4
    row = telemetry.load_layers({"t": (df, "k", "bronze"), "none": (df.limit(0), "k", "gold")}, str(tmp_path / "b")).collect()
    assert [tuple(r) for r in row] == [("bronze", "t", 4, 2, 1, 1), ("gold", "none", 0, 0, 0, 0)]
    plain = telemetry.layer_counts({"t": (df, "k", "bronze")}).first()
    assert tuple(plain) == tuple(row[0])


def test_snapshots_of_two_dates_read_the_table_once(spark):
    data = [(D(2024, 1, i % 28 + 1), Decimal(i)) for i in range(60)]
    txn = spark.createDataFrame(data, "transaction_date date, amount decimal(18,2)")
    who = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, customer_segment string")
    at, cut = dt.datetime(2024, 2, 1), D(2024, 1, 10)
    both = {r["snapshot_type"]: r.asDict() for r in telemetry.snapshots(who, txn, {"B": (cut, at), "A": (None, at), "N": (D(2000, 1, 1), at)}).collect()}
    assert both["A"] == telemetry.snapshot(who, txn, "A", at).first().asDict()
    assert both["B"] == telemetry.snapshot(who, txn.where(F.col("transaction_date") < F.lit(cut)), "B", at).first().asDict()
    assert both["N"]["transaction_count"] == 0 and both["N"]["total_transaction_amount"] == 0.0 and both["N"]["min_transaction_date"] is None


def test_holdout_follows_from_the_key(spark):
    import hashlib

    df = spark.range(500).select(F.col("id").alias("customer_id"))
    got = {r[0]: r[1] for r in df.select("customer_id", churn.held_out("customer_id", 7, 0.25)).collect()}
    assert got == {i: int(hashlib.md5(f"{i}:7".encode()).hexdigest()[:8], 16) % 1000 < 250 for i in range(500)}
    assert 80 < sum(got.values()) < 170
