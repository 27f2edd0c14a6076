"""Ordered operators against brute force, with keys that are cut into pieces and with plain windows."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientele.operators import cdc
from clientele.operators import ordered as O
from clientele.operators.joins import dimension_join
from clientele.operators.star import join_as_of

BIG = 10**9


def one_day(spark, seed=9, n=900):
    """A third of the rows belong to one key, all in one day; NULL is a key, too."""
    r = random.Random(seed)
    day = dt.datetime(2024, 3, 1)
    hot = [(0, day + dt.timedelta(seconds=s)) for s in r.sample(range(86_400), n // 3)]
    rest = [(r.choice([1, 2, 3, None]), day + dt.timedelta(hours=h)) for h in r.sample(range(9000), n - n // 3)]
    data = [(k, t, i) for i, (k, t) in enumerate(hot + rest)]
    return data, spark.createDataFrame(data, "k long, t timestamp_ntz, i long").repartition(6)


@pytest.mark.parametrize("most", [7, 50, BIG])
@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour_crosses_pieces(spark, ahead, most):
    data, df = one_day(spark)
    got = {r["i"]: r["x"] for r in O.neighbour(df, ["k"], "t", "x", ahead, most).collect()}
    for k in {k for k, _, _ in data}:
        order = sorted(((t, i) for kk, t, i in data if kk == k), reverse=not ahead)
        for (_, i), after in zip(order, [*order[1:], (None, None)]):
            assert got[i] == after[0]


def test_pieces_are_bounded_and_in_order(spark):
    data, df = one_day(spark)
    pieces = O.in_pieces(df, ["k"], ["t"], 40)
    groups = {}
    for r in pieces.rows.collect():
        groups.setdefault((r["k"], r[O.PIECE]), []).append(r["t"])
    assert sum(map(len, groups.values())) == len(data)
    assert max(map(len, groups.values())) <= 100 and len([g for g in groups if g[0] == 0]) >= 5
    for k in (0, 1, None):
        spans = [(min(v), max(v)) for (kk, _), v in sorted(groups.items(), key=lambda g: g[0][1]) if kk == k]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_rows_of_one_moment_are_cut_too(spark):
    df = spark.range(600).select(F.lit(1).alias("k"), F.lit(5).alias("t"), "id")
    sizes = [r["count"] for r in O.in_pieces(df, ["k"], ["t"], 50).rows.groupBy(O.PIECE).count().collect()]
    assert max(sizes) <= 150 and sum(sizes) == 600
    near = [r["x"] for r in O.neighbour(df, ["k"], "t", "x", most=50).collect()]
    assert Counter(near) == {5: 599, None: 1}


def test_no_key_at_all(spark):
    df = spark.range(300).select(F.col("id").alias("t"))
    for most in (20, BIG):
        got = {r["t"]: r["x"] for r in O.neighbour(df, [], "t", "x", most=most).collect()}
        assert got == {i: i + 1 if i < 299 else None for i in range(300)}


def test_plain_window_needs_one_shuffle_and_no_join(spark):
    _, df = one_day(spark)
    plan = O.neighbour(df, ["k"], "t", "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("most", [10, BIG])
def test_as_of_merge_equals_the_range_join(spark, most):
    r = random.Random(2)
    start = dt.date(2024, 1, 1)
    days = lambda n: sorted(r.sample(range(400), n))
    versions = []
    for key, n in ((1, 150), (2, 40), (3, 1), (4, 0), (5, 8)):
        starts = days(n)
        versions += [(key, start + dt.timedelta(days=a), start + dt.timedelta(days=b - 1) if b else None, f"{key}-{a}") for a, b in zip(starts, [*starts[1:], None])]
    facts = [(i, r.choice([1, 1, 1, 2, 3, 4, 5, None]), start + dt.timedelta(days=r.randrange(-5, 410)) if r.random() > 0.02 else None) for i in range(500)]
    f = spark.createDataFrame(facts, "i long, k long, day date").repartition(5)
    v = spark.createDataFrame(versions, "k long, valid_from date, valid_to date, name string")
    want = join_as_of(f, v, "k", "day").select("i", "k", "day", "valid_from", "valid_to", "name")
    got = O.as_of_merge(f, v, "k", "day", most=most)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert O.as_of_merge(f, v.limit(0), "k", "day", most=most).count() == 0
    with pytest.raises(ValueError):
        O.as_of_merge(f.withColumn("name", F.lit(1)), v, "k", "day")


def crowded_days(spark, n=600):
    """Facts of few keys and days, many on each; some before the first version, some twice, some without key or day."""
    r = random.Random(6)
    start = dt.date(2024, 1, 1)
    rows = [(i, r.choice([1, 1, 1, 2, None]), r.choice([start + dt.timedelta(days=d) for d in (-3, 0, 0, 0, 4, 9)] + [None])) for i in range(n)]
    versions = [(k, start + dt.timedelta(days=d), f"{k}-{d}") for k in (1, 2) for d in range(0, 12, k + 1)]
    facts = spark.createDataFrame(rows + rows[:40], "i long, k long, day date").repartition(5)
    want = Counter()
    for i, k, day in rows + rows[:40]:
        started = [(s, name) for key, s, name in versions if day and key == k and s <= day]
        want.update([(i, k, day, *max(started))] if started else [])
    return facts, spark.createDataFrame(versions, "k long, valid_from date, name string"), want


@pytest.mark.parametrize("most", [3, 40, BIG])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_as_of_merge_of_crowded_days(spark, most, broadcast):
    facts, versions, want = crowded_days(spark)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = O.as_of_merge(facts, versions, "k", "day", most=most)
        assert Counter(map(tuple, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


@pytest.mark.parametrize("most", [250, BIG])
def test_as_of_merge_reads_facts_twice_and_never_sorts_them(spark, most):
    facts, versions, want = crowded_days(spark)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def look(i):
        seen.add(1)
        return True

    # The row number of a fact is looked at in a filter, which every pass over the facts has to take.
    got = O.as_of_merge(facts.where(look("i")), versions, "k", "day", most=most)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, got.collect())) == want
    assert seen.value <= 2 * facts.count()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert O.as_of_merge(facts.limit(0), versions, "k", "day").count() == 0


def test_as_of_query_shuffles_only_what_it_returns(spark):
    from clientele.plans import QUERIES

    plan = QUERIES["jn_asof_dense"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "Exchange hashpartitioning" not in plan


def ts(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def change_data(spark, n=500):
    r = random.Random(4)
    kinds = [("INSERT", False), ("INSERT", True), ("INSERT", True), ("DELETE", False), ("UPDATE", True)]
    # A third of all changes are of id 0. Times are apart within an id, so that the order is unique.
    times = {i: iter(r.sample(range(5000), 400)) for i in range(8)}
    history, batch = [], []
    for i in range(n):
        key = 0 if i % 3 == 0 else r.randrange(1, 8)
        if r.random() < 0.3:
            history.append((key, f"h{i}", ts(next(times[key]))))
        else:
            batch.append((key, f"c{i}", ts(5000 + next(times[key])), *r.choice(kinds if key else kinds[:3])))
    old = cdc.intervals(spark.createDataFrame(history, "id long, label string, start_time timestamp_ntz"), "id", "start_time")
    return old, spark.createDataFrame(batch, "id long, label string, update_timestamp timestamp_ntz, action string, is_update boolean").repartition(5)


def classified(changes, history):
    """The definition, row by row."""
    end = cdc.OPEN_END
    out = set()
    for key in {c["id"] for c in changes}:
        mine = [c for c in changes if c["id"] == key]
        current = [h for h in history if h["id"] == key and h["current_flag"] == 1]
        fresh = sorted((c["update_timestamp"], c["label"]) for c in mine if c["action"] == "INSERT" and not c["is_update"])
        for (t, label), nxt in zip(fresh, [*fresh[1:], None]):
            out.add((key, label, t, nxt[0] if nxt else end, 0 if nxt else 1, "I"))
        updates = [(c["update_timestamp"], c["label"], "I") for c in mine if c["action"] == "INSERT" and c["is_update"]]
        if updates:
            chain = sorted(updates + [(h["start_time"], None, "U") for h in current], key=lambda x: x[0])
            for (t, label, dml), nxt in zip(chain, [*chain[1:], None]):
                out.add((key, label, t, nxt[0] if nxt else end, 0 if nxt else 1, dml))
        if any(c["action"] == "DELETE" and not c["is_update"] for c in mine):
            out |= {(key, None, h["start_time"], ts(99_999), None, "D") for h in current}
    return out


@pytest.mark.parametrize("most", [15, BIG])
def test_changes_with_a_hot_id(spark, most):
    history, changes = change_data(spark)
    got = cdc.classify(changes, history, ["label"], ts(99_999), most)
    rows = [tuple(r) for r in got.select("id", "label", "start_time", "end_time", "current_flag", "dml_type").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == classified(changes.collect(), history.collect())
    merged = cdc.merge_history(history, got, ["label"])
    folded = cdc.apply_changes(changes, history, ["label"], ts(99_999), most)
    assert folded.columns == merged.columns
    assert Counter(map(tuple, folded.collect())) == Counter(map(tuple, merged.collect()))


def test_one_fold_reads_each_side_once(spark):
    from clientele.plans import QUERIES

    for name in ("cdc_classify", "cdc_merge_history"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        assert plan.count("FileScan") == 2 and plan.count("Exchange") <= 3, plan


# ---- joins with heavy keys ----


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [50, BIG])
def test_dimension_join_with_a_heavy_key(spark, how, most):
    r = random.Random(6)
    facts = [(i, 0 if i % 3 == 0 else r.choice([1, 2, 3, 4, None, 99])) for i in range(900)]
    f = spark.createDataFrame(facts, "i long, k long").repartition(6)
    d = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k long, name string")
    want = Counter(map(tuple, f.join(d, "k", how).select("i", "k", "name").collect()))
    assert Counter(map(tuple, dimension_join(f, d, "k", how, most).select("i", "k", "name").collect())) == want
    with pytest.raises(ValueError):
        dimension_join(f, d, "k", "full")


def test_no_task_of_the_join_holds_the_heavy_key(spark):
    """The shuffled rows of a join: with a third of the facts of one key, the largest task has no more than a few times the mean."""
    f = spark.range(90_000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"))
    d = spark.range(-1, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        largest = {}
        for most in (5000, BIG):
            sizes = [x["count"] for x in dimension_join(f, d, "k", most=most).groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 90_000
            largest[most] = max(sizes) / (sum(sizes) / len(sizes))
        assert largest[5000] < 3 and largest[5000] < largest[BIG]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_star_reads_each_dimension_once(spark):
    from clientele.plans import QUERIES

    plan = QUERIES["jn_star"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.count(column) for column in ("c_mktsegment",))
    leaves = [line for line in plan.splitlines() if "Relation [" in line]
    reads = Counter(t for line in leaves for t in ("c_custkey", "n_nationkey", "r_regionkey", "l_orderkey") if f"{t}#" in line)
    assert all(n == 1 for n in reads.values()), plan
