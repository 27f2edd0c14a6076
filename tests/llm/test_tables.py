"""Search, URL rules and sharding against brute force and on odd rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import cross_polytope, reputation, sharding


def brute(rows, every, k):
    out = {}
    for q, x in rows:
        if q % every == 0:
            own = sorted((math.dist(x, y), v) for v, y in rows if v != q)[:k]
            out[q] = [(r, v, d) for r, (d, v) in enumerate(own, 1)]
    return out


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = {}
    for r in cross_polytope.search(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), bucket=4000).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, 100, 10)
    assert got.keys() == want.keys()
    by = dict(rows)
    hits = 0
    for q, found in got.items():
        assert [r for r, *_ in sorted(found)] == list(range(1, 11))
        assert all(s == pytest.approx(math.dist(by[q], by[v]), abs=1e-12) for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for _, v, _ in want[q]})
    assert hits / (10 * len(want)) >= 0.9


@pytest.mark.parametrize("size", ["0.001", "0.01", "0.1"])
def test_recall_at_every_given_size(spark, size):
    """With production parameters, as the registered query runs."""
    df = spark.read.parquet(f"/root/testdata/sf{size}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = {(q, v) for q, own in brute(rows, 100, 10).items() for _, v, _ in own}
    got = {(r.query_id, r.vec_id) for r in cross_polytope.search(df).collect()}
    assert len(got) == len(want) and len(got & want) / len(want) >= 0.9


def test_recall_is_the_same_with_joined_hashes(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    assert cross_polytope.functions_for(len(rows), len(rows[0][1]), 1) == 2
    want = {(q, v) for q, own in brute(rows, 100, 10).items() for _, v, _ in own}
    got = {(r.query_id, r.vec_id) for r in cross_polytope.search(df, bucket=1).collect()}
    assert len(got & want) / len(want) >= 0.9


def test_probes_of_joined_hashes_are_the_best_sums():
    x = np.random.default_rng(4).normal(size=(70, 3))
    h = cross_polytope.Hashes(3, 1, 2, 5)
    turned = [h.turned(x, 0, f) for f in range(2)]
    for n in (1, 5, 30, 100):
        got = h.probes(x, 0, n)
        assert got.shape == (70, min(n, 64)) and (got[:, 0] == h.buckets(x)[:, 0]).all()
        for i in range(70):
            loss = {a * 8 + b: sum((s[i].max() - s[i, j]) ** 2 for s, j in zip(turned, (a, b))) for a in range(8) for b in range(8)}
            assert len(set(got[i].tolist())) == len(got[i])
            assert [loss[j] for j in got[i].tolist()] == pytest.approx(sorted(loss.values())[:n])


def test_one_hash_at_every_size(spark, monkeypatch):
    made = []
    own = cross_polytope.Hashes
    monkeypatch.setattr(cross_polytope, "Hashes", lambda *a: made.append(a) or own(*a))
    monkeypatch.setattr(cross_polytope, "functions_for", lambda *a: 2)
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    cross_polytope.search(df)
    assert [a[2] for a in made] == [1]


def test_joined_hashes_reach_all_by_the_exact_way(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for bucket in (1, 4000):  # many small buckets, few large ones
        got = cross_polytope.search(df, every=10, k=60, tables=1, probes=1, bucket=bucket, block=7).collect()
        want = brute(rows, 10, 60)
        for q in want:
            own = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
            assert own == [(r, v) for r, v, _ in want[q]]


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [0.0, 2.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0]), (8, [1.0]), (100, [-0.0, 2.0])]
    df = spark.createDataFrame([(a, b, 1, 1) for a, b in rows], "vec_id long, embedding array<double>, rank int, rep int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in cross_polytope.search(df, k=3).collect())
    root5 = math.sqrt(5)
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 7, root5), (100, 1, 7, 0.0), (100, 2, 0, root5), (100, 3, 1, root5)]
    assert cross_polytope.search(df.limit(0)).count() == 0
    assert cross_polytope.search(df.where("vec_id = 0")).count() == 0


def test_hot_vector(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(0.6), F.lit(0.8))).otherwise(F.array(F.sin("id"), F.cos("id"))).alias("embedding"))
    got = {}
    for r in cross_polytope.search(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert len(got) == 30
    assert [v for _, v in sorted(got[300])] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]
    assert [v for _, v in sorted(got[0])] == [3, 6, 9, 12, 15, 18, 21, 24, 27, 30]


def test_url_rules(spark):
    urls = [None, "no scheme", "http://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "http://example.org", "http://example.org/", "x://notexample.org/es/", "http://b.com/fr/", "http://b.com/de", "http://b.com/de/a", "http://b.com?q=/de/", "a://b://c.com/de/", "", "http://ÀB.com/fr/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(2, urls[2], "x"), (None, urls[9], "x")], "page_id long, url string, host string")
    got = reputation.judge(pages, spark.createDataFrame([], "page_id long, good int")).collect()
    assert len(got) == len(urls) + 2
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[0] == by[1] == by[12] == ("", "", None, "allow")
    assert by[2] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[3][2:] == ("example.org/en/1", "block") and by[4] == ("example.org", "", None, "allow") and by[5][2:] == ("org/", "allow")
    assert by[6] == ("notexample.org", "/es/", "org/", "allow") and by[7][2:] == ("com/fr/", "allow") and by[8][2:] == (None, "allow")
    assert by[9][2:] == by[None][2:] == ("com/de/", "block") and by[10][:3] == ("b.com", "", None) and by[11][:2] == ("b:", "//c.com/de/")
    assert by[13] == ("Àb.com", "/fr/", "com/fr/", "allow")
    assert reputation.judge(pages.limit(0), spark.createDataFrame([], "page_id long, good int")).count() == 0


def test_bad_hosts_are_blocked_by_their_bound(spark):
    rows = [(i, f"http://h{i % 20}.example.net/x", int(i % 20 >= 5)) for i in range(4000)] + [(9000, "http://new.example.net/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r.page_id: r for r in reputation.judge(df, df.select("page_id", "good")).collect()}
    for i, _, good in rows:
        assert got[i].verdict == ("block" if good == 0 else "allow")
    assert 0 < got[9000].good_rate < 1 and got[9000].n_labelled == 0


def claim_by_turns(shards, slots):
    names, table = sorted(shards), {}
    orders = {n: [(sharding._number(f"offset {n}") % slots + j * (sharding._number(f"step {n}") % (slots - 1) + 1)) % slots for j in range(slots)] for n in names}
    while len(table) < slots:
        for n in names:
            free = next((s for s in orders[n] if s not in table), None)
            if free is not None:
                table[free] = n
    return [shards.index(table[s]) for s in range(slots)]


def test_table_is_filled_by_turns():
    for shards, slots in ((["b", "a", "c"], 31), ([f"s{i}" for i in range(7)], 101), (["x"], 2)):
        assert sharding.fill(shards, slots) == claim_by_turns(shards, slots)
    names = [f"s{i}" for i in range(10)]
    before, after = sharding.fill(names, 1009), sharding.fill(names[:-1], 1009)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    assert sum(a != b for a, b in zip(before, after) if b is not None and a != 9) < 0.15 * 1009
    heavy = Counter(sharding.fill(["a", "b"], 1009, {"a": 3}))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    for wrong in (lambda: sharding.fill([], 31), lambda: sharding.fill(["a"], 30), lambda: sharding.fill(["a", "a"], 31)):
        with pytest.raises(ValueError):
            wrong()


def test_places(spark, tmp_path):
    shards = [f"s{i}" for i in range(5)]
    df = spark.createDataFrame([(i % 50, "t", "x", 1) for i in range(200)] + [(None, None, "x", 1)] * 2, "doc_id long, text string, slot string, shard int")
    rows = sharding.place(df, shards, slots=101).collect()
    assert len(rows) == 202 and len({(r.doc_id, r.slot, r.shard) for r in rows}) == 51
    table = sharding.fill(shards, 101)
    assert all(shards[table[r.slot]] == r.shard for r in rows)
    assert sharding.place(df.limit(0), shards).count() == 0
    sharding.write(df, str(tmp_path / "out"), shards, slots=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 202 and set(df.columns) < set(back.columns)
    want = {r.doc_id: r.shard for r in rows}
    assert all(want[r.doc_id] == r._shard for r in back.collect())
