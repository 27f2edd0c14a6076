"""Document operators against brute force, and on nulls, empties, ties, repeated rows, extra columns and empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import decontaminate, factorization, licenses, lines, order_minhash
from clientele.llm.common import WORD, word_array, words_of

ODD = [
    (None, "a null id", "x"), (1, None, "x"), (2, "", "x"), (3, "...", "x"), (4, "One two three four five six", "x"), (4, "One two three four five six", "x"),
    (5, "word " * 20000, "x"), (6, "É È Ü café 42 naïve", "x"),
]


def odd(spark, clash="n_words"):
    return spark.createDataFrame(ODD, f"doc_id long, text string, {clash} string")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_words_agree(spark):
    df = odd(spark).union(spark.createDataFrame([(9, "?x!Y z-", "x"), (10, "ÀB\x7fc\u00a0d", "x")], odd(spark).schema))
    for r in df.select("text", word_array(F.col("text")).alias("w")).collect():
        want = re.findall(WORD, lowered(r.text))
        assert r.w == want and [w.decode() for w in words_of(r.text)] == want


# --- near duplicates


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_exact_above_the_threshold():
    r = random.Random(2)
    for _ in range(300):
        a = [r.randint(0, 30) for _ in range(r.randint(1, 60))]
        b = [x for x in a if r.random() > 0.08]
        for _ in range(r.randint(0, 4)):
            b.insert(r.randint(0, len(b)), r.randint(0, 30))
        m = lcs(a, b)
        want = m / (len(a) + len(b) - m)
        got = order_minhash.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
        assert got == want if want >= 0.8 else got < 0.8


def test_classes_equal_brute_force(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    shared = [r.choice(vocabulary) for _ in range(40)]
    for base in range(25):
        words = [r.choice(vocabulary) for _ in range(r.randint(60, 200))]
        if base % 3 == 0:
            words[10:10] = shared
        for _ in range(r.randint(1, 5)):
            copy = list(words)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            docs.append(copy)
    docs.append(docs[0][50:] + docs[0][:50])  # the same words in another order
    docs += [docs[1]] * 5
    r.shuffle(docs)
    grams = [order_minhash.kmers([w.encode() for w in d], 5) for d in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if order_minhash.similarity(grams[i], grams[j], 0.8) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(i, " ".join(d), 7) for i, d in enumerate(docs)], "doc_id long, text string, class_id int")
    got = {x.doc_id: x.class_id for x in order_minhash.classes(df).collect()}
    assert got == {i: find(i) for i in range(len(docs))}
    kept = order_minhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted({find(i) for i in range(len(docs))})


def test_copies_among_many_texts_with_a_common_passage(spark):
    r = random.Random(8)
    passage = [f"p{i}" for i in range(170)]
    docs = []
    for i in range(300):
        words = passage + [f"d{i}w{j}" for j in range(30)]
        docs.append(words)
        if i % 5 == 0:  # a copy that is changed outside of the passage
            copy = list(words)
            for _ in range(3):
                copy[r.randrange(170, 200)] = f"n{r.random()}"
            docs.append(copy)
    r.shuffle(docs)
    grams = [order_minhash.kmers([w.encode() for w in d], 5) for d in docs]
    sketches = [set(order_minhash.sketch(g, 16, 3)) for g in grams]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sketches[i] & sketches[j] and order_minhash.similarity(grams[i], grams[j], 0.8) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = {i: find(i) for i in range(len(docs))}
    assert 30 < len(docs) - len(set(want.values())) < 70
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in order_minhash.classes(df).collect()} == want
    assert sorted(x.doc_id for x in order_minhash.keep_first(df).collect()) == sorted(set(want.values()))
    # Blocks of every size compare the same pairs, by ids of any kind.
    rows = [(str(i), len(g), k, str(i), order_minhash.sketch(g, 16, 3)) for i, g in enumerate(grams) for k in order_minhash.sketch(g, 16, 3)]
    entries = spark.createDataFrame(rows, "id string, n int, bucket long, root string, keys array<long>")
    texts = df.select(F.col("doc_id").cast("string").alias("id"), "text")
    pairs = {
        (max(str(i), str(j)), min(str(i), str(j))) for i in range(len(docs)) for j in range(i)
        if sketches[i] & sketches[j] and order_minhash.similarity(grams[i], grams[j], 0.8) >= 0.8
    }
    for block in (1000, 50):
        assert {(x.a, x.b) for x in order_minhash.compared(entries, texts, 5, 0.8, block).collect()} == pairs


def test_common_counts_and_unit_pairs():
    r = np.random.default_rng(3)
    left, right = ([np.unique(r.integers(0, 90, n)).astype(np.uint64) for n in sizes] for sizes in ((5, 60, 200), (1, 0, 70, 300)))
    for width in (7, 1 << 14):
        assert order_minhash.common(left, right, width).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in right] for x in left]


def test_many_pairs_are_verified_as_few(spark):
    texts = [" ".join(f"w{(i * 7 + j) % 50}" for j in range(60)) for i in range(4)]
    texts += [t.replace("w3 ", "x ", 1) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    pairs = spark.createDataFrame([(a, b) for a in range(8) for b in range(a)], "a long, b long")
    want = {(a, b) for a in range(8) for b in range(a) if order_minhash.similarity(*(order_minhash.kmers(words_of(texts[i]), 5) for i in (a, b)), 0.8) >= 0.8}
    for small in (0, 1000):
        assert {(r.a, r.b) for r in order_minhash.verified(pairs, docs, 5, 0.8, small).collect()} == want and want


def test_near_duplicates_odd_rows(spark):
    got = [(x.doc_id, x.class_id) for x in order_minhash.classes(odd(spark, "digest")).collect()]
    assert Counter(got) == Counter([(None, None), (1, 1), (2, 1), (3, 3), (4, 4), (4, 4), (5, 5), (6, 6)])
    kept = order_minhash.keep_first(odd(spark, "id"))
    assert Counter(x.doc_id for x in kept.collect()) == Counter([None, 1, 3, 4, 5, 6])
    assert order_minhash.classes(odd(spark).limit(0)).count() == 0


def test_texts_without_words_are_copies_only_if_equal(spark):
    rows = [(1, "---"), (2, "+++"), (3, "---"), (4, None), (5, ""), (6, " "), (7, "words"), (8, "WORDS!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in order_minhash.classes(df).collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7}


def test_forest_links_the_same_rows_with_few_links():
    r = random.Random(3)
    for _ in range(50):
        pairs = [(i, j) for i in range(30) for j in range(i) if r.random() < 0.3]
        good = {p for p in pairs if r.random() < 0.3}
        looked = []
        found = order_minhash.forest(pairs, lambda i, j: looked.append((i, j)) or (i, j) in good)

        def groups(links):
            sets = {i: {i} for i in range(30)}
            for i, j in links:
                both = sets[i] | sets[j]
                for x in both:
                    sets[x] = both
            return {frozenset(s) for s in sets.values()}

        assert groups(found) == groups(good) and len(found) == 30 - len(groups(good)) and len(looked) <= len(pairs)


def test_contracted_links_and_joined_roots(spark):
    make = lambda rows, fields: spark.createDataFrame(rows, fields)
    roots = make([(1, 1), (2, 1), (5, 5), (6, 5)], "id long, root long")
    links = make([(2, 1), (6, 2), (6, 1), (5, 2), (9, 8), (8, 9)], "a long, b long")
    few = order_minhash.contracted(links, roots)
    assert sorted(map(tuple, few.collect())) == [(5, 1), (9, 8)]
    done = order_minhash.joined(roots, order_minhash.components(few))
    assert sorted(map(tuple, done.collect())) == [(1, 1), (2, 1), (5, 1), (6, 1), (8, 8), (9, 8)]


# --- lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@pytest.mark.parametrize("most, levels, broadcast", [(1, 2, 16 << 20), (1, 3, 16 << 20), (2, 2, 16 << 20), (3, 1, 0)])
def test_lines_equal_brute_force(spark, monkeypatch, most, levels, broadcast):
    monkeypatch.setattr(lines, "BROADCAST", broadcast)
    r = random.Random(most)
    bases = ["".join(r.choice("abcdeé ") for _ in range(r.randint(8, 24))) for _ in range(25)]
    docs = []
    for i in range(40):
        own = []
        for _ in range(r.randint(0, 6)):
            line = list(r.choice(bases))
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4])):
                at, kind = r.randrange(len(line)), r.randrange(3)
                line[at : at + (kind != 1)] = [] if kind == 0 else [r.choice("xyé")]
            own.append("".join(line))
        docs.append((i, "\n".join(own + ["ab"] * r.randint(0, 2))))
    seen, want = [], {}
    for i, text in docs:
        keep = []
        for line in text.split("\n"):
            if len(line) < 8:
                keep.append(line)
                continue
            if all(edits(line, s) > most for s in seen):
                keep.append(line)
            seen.append(line)
        want[i] = "\n".join(keep)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: x.text for x in lines.dedup(df, edits=most, least=8, levels=levels).collect()}
    assert got == want


def test_lines_odd_rows(spark):
    clash = odd(spark, "kept")
    got = lines.dedup(clash, least=5)
    assert got.columns == clash.columns
    assert Counter((x.doc_id, x.text) for x in got.collect()) == Counter((a, b) for a, b, _ in ODD)
    both = spark.createDataFrame([(1, "same line here\nother line"), (2, "same line here"), (None, "same line herE")], "doc_id long, text string")
    # A null id comes first: the other two are within one edit of its line.
    assert {x.doc_id: x.text for x in lines.dedup(both, least=5).collect()} == {None: "same line herE", 1: "other line", 2: ""}
    assert lines.report(clash.limit(0)).count() == 0
    counts = {x.doc_id: (x.n_lines, x.n_kept) for x in lines.report(clash, least=5).collect()}
    assert counts[1] == (0, 0) and counts[2] == (1, 1)


# --- benchmark


def brute_hits(docs, items, width=10):
    out = []
    for key, text in docs:
        words = re.findall(WORD, lowered(text))
        hit, names = set(), set()
        for name, item in items:
            own = re.findall(WORD, lowered(item))
            size = min(width, len(own))
            for a in range(len(own) - size + 1 if own else 0):
                for b in range(len(words) - size + 1):
                    if words[b : b + size] == own[a : a + size]:
                        hit |= set(range(b, b + size))
                        names.add(name)
        out.append((key, len(words), len(hit), len(names)))
    return Counter(out)


def test_containment_equals_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 10, 14, 30, 30])] + [(8, ""), (9, None), (10, "V1 V1 v1")]
    docs = [(None, "v1 v1 v1 v1"), (0, None), (1, ""), (2, "...")]
    for i in range(3, 40):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 80))]
        if i % 2:
            part = (items[r.randrange(8)][1]).split()
            a = r.randint(0, len(part) - 1)
            words[5:5] = part[a : a + 12]
        docs.append((i, " ".join(words)))
    docs.append(docs[7])
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, wid string")
    for block in (16 << 20, 2000):
        got = decontaminate.contamination(df, bench, block_bytes=block).collect()
        assert Counter((x.doc_id, x.n_words, x.n_hit, x.n_items) for x in got) == brute_hits(docs, items)
    clean = decontaminate.clean(df, bench)
    assert clean.columns == df.columns
    bad = {k[0] for k in brute_hits(docs, items) if k[2]}
    assert Counter(x.doc_id for x in clean.collect()) == Counter(k for k, _ in docs if k not in bad)
    assert decontaminate.contamination(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


# --- licences


def test_licences(spark):
    rows = [
        (1, "Released under the MIT License."), (2, "an MIT license, the Apache license and the General Public License"), (3, "mit licenses"),
        (4, "Licensed under CC BY-NC 4.0."), (5, "Redistribution and use in source and binary forms, with or without modification, are permitted"),
        (6, "mit license " * 3000), (7, None), (8, ""), (None, "Apache License"), (9, "MIT mit LICENSE license"),
    ]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, spans int")
    got = {x.doc_id: x for x in licenses.scan(df).collect()}
    phrases = [(p.split(), k) for p, k in licenses.PHRASES]
    for k, t in rows:
        words = re.findall(WORD, lowered(t))
        places = [(i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p)] == p]
        x = got[k]
        assert (x.n_words, x.n_base) == (len(words), len(places))
        assert x.first_word == min((p for p, _ in places), default=None) and x.last_word == max((p for p, _ in places), default=None)
        assert x.base_labels == ",".join(sorted({b for _, b in places})) and 0 <= x.score <= 1
    assert got[4].labels == "cc-by-nc" and got[5].labels == "bsd" and got[7].labels == "" and got[7].score == 0
    assert licenses.scan(df.limit(0)).count() == 0


def test_matching_statistics_equal_brute_force():
    a = licenses.automaton()
    texts = [[w.decode() for w in words_of(t)] for t, _ in (*a.phrases, *a.notices)]
    r = random.Random(4)
    vocabulary = sorted({w for t in texts for w in t})
    for _ in range(60):
        words = [w for _ in range(6) for w in (lambda t, i: t[i : i + r.randint(1, 7)])(r.choice(texts), r.randrange(3))] + [r.choice(vocabulary)]
        r.shuffle(words) if r.random() < 0.2 else None
        at, size = 0, 0
        for i, w in enumerate(words):
            n = a.number[w.encode()]
            while at and n not in a.nodes[at].after:
                at = a.nodes[at].link
                size = a.nodes[at].length
            if n in a.nodes[at].after:
                at, size = a.nodes[at].after[n], size + 1
            best = max(s for s in range(i + 2) if s == 0 or any(words[i + 1 - s : i + 1] == t[j : j + s] for t in texts for j in range(len(t))))
            assert size == best


# --- classifier


def test_linear_time_sum_equals_pairs():
    rng = np.random.default_rng(1)
    m = factorization.Model(0.3, rng.normal(size=20), rng.normal(size=(20, 4)), np.zeros(3), np.ones(3), 17)
    ids, x, stats = np.array([1, 5, 9]), np.array([0.5, 1.0, -0.2]), np.array([0.1, 0.2, 0.3])
    i, v = m.inputs(ids, x, stats)
    total = m.bias + m.weight[i] @ v + sum(m.factor[i[a]] @ m.factor[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a))
    assert m.score(ids, x, stats) == pytest.approx(1 / (1 + np.exp(-total)))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = factorization.train(docs, labels)
    scored = factorization.score(docs, model).where(factorization.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert np.mean([r.predicted == r.quality for r in scored]) >= 0.95
    # Turning every held-out label round changes nothing.
    turned = labels.withColumn("quality", F.when(factorization.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = factorization.train(docs, turned)
    assert (again.weight == model.weight).all()


def test_classifier_odd_rows(spark):
    docs = odd(spark, "score").withColumn("n_chars", F.lit(None).cast("long"))
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for own in (labels, labels.limit(0), labels.where("quality = 0")):
        model = factorization.train(docs, own)
        rows = factorization.score(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    kept = factorization.score(docs, model, keep=tuple(docs.columns), above=0.0)
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert factorization.score(docs.limit(0), model).count() == 0
