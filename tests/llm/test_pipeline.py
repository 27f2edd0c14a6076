"""The pipeline against a plain version of every stage, over documents with odd rows, copies, repeated lines and passages."""

import hashlib
import random
import struct
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as pipeline
from clientele.llm import bpe, factorization, order_minhash
from clientele.llm.common import words_of
from tests.llm.test_documents import brute_hits, edits

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def made_documents():
    r = random.Random(12)
    word = lambda: "".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3)))
    vocabulary = [word() for _ in range(400)]
    item = " ".join(r.choice(vocabulary) for _ in range(14))
    footer = "all rights of this page stay with its many authors"
    docs, labels = [], []

    def add(text, good=None):
        key = len(docs) + 1
        docs.append((key, text, "en", "web", len(text or ""), "x"))
        if good is not None:
            labels.append((key, good, 0))

    for i in range(90):
        if i % 3 == 0:  # junk: few words, many signs
            add(" ".join(r.choice(["!!!", "$$$", "click", "free", "win", "###", "0000"]) for _ in range(r.randint(20, 60))), 0)
            continue
        lines = [" ".join(r.choice(vocabulary) for _ in range(r.randint(6, 12))) for _ in range(r.randint(12, 16))]
        if i % 4 == 1:
            lines.insert(r.randrange(len(lines)), footer if i % 8 == 1 else footer[:-1] + "z")
        if i % 13 == 1:
            lines.append(f"{word()} {item} {word()} {word()}")
        add("\n".join(lines), 1)
    good = [d for d in docs if d[0] % 3 != 1]
    for d in good[:8]:  # near copies: lines broken anew and one word replaced, so that no line is repeated
        words = d[1].split()
        words[len(words) // 2] = "another"
        add("\n".join(" ".join(words[at : at + 17]) for at in range(1, len(words), 17)))
    add("".join(good[9][1]).upper())
    for text in (None, "", " ", "---", "+++", "short"):
        add(text)
    docs.append(docs[1])  # a repeated row
    docs.append((None, "a text of no document, " * 5, "en", "web", None, "x"))
    return docs, labels, [(0, item), (1, None), (2, "")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = made_documents()
    spark.createDataFrame(docs, FIELDS).repartition(4).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def plain_score(model, text, n_chars):
    ids, values, stats = factorization.Features(model.buckets, 1)(text, [n_chars])
    ids, x = model.inputs(ids, values, stats)
    total = model.bias + sum(model.weight[i] * v for i, v in zip(ids, x))
    for a in range(len(ids)):
        for b in range(a):
            total += float(model.factor[ids[a]] @ model.factor[ids[b]]) * x[a] * x[b]
    return 1 / (1 + np.exp(-total))


def plain_lines(docs):
    seen, out = [], []
    done = {}
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        if text is None:
            out.append((key, None))
            continue
        if (key, text) not in done:
            keep = []
            for line in text.split("\n"):
                if len(line) < 20 or all(abs(len(s) - len(line)) > 1 or edits(line, s) > 1 for s in seen):
                    keep.append(line)
                if len(line) >= 20:
                    seen.append(line)
            done[key, text] = "\n".join(keep)
        out.append((key, done[key, text]))
    return out


def plain_copies(docs):
    rows = sorted({d for d in docs if d[0] is not None})
    root = {k: k for k, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    grams = {k: order_minhash.kmers(words_of(t), 5) for k, t in rows}
    for i, (a, s) in enumerate(rows):
        for b, t in rows[:i]:
            same = (s or "") == (t or "") if not len(grams[a]) or not len(grams[b]) else order_minhash.similarity(grams[a], grams[b], 0.8) >= 0.8
            if same and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [d for d in docs if d[0] is None] + [(k, t) for k, t in rows if find(k) == k]


def test_run_equals_the_plain_stages(spark, folder):
    docs, labels, items = made_documents()
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    model = factorization.train(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = [(d[0], d[1]) for d in docs if plain_score(model, d[1], d[4]) >= 0.5]
    assert 60 < len(kept) < len(docs) - 20
    lined = plain_lines(kept)
    assert [t for _, t in lined] != [t for _, t in kept]
    alone = plain_copies(lined)
    assert len(lined) - 12 <= len(alone) <= len(lined) - 7
    hits = brute_hits(alone, items)
    bad = {key for key, _, n_hit, _ in hits if n_hit}
    clean = [d for d in alone if d[0] not in bad]
    assert len(alone) - len(clean) >= 3
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = Counter()
    for key, text in clean:
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want[key, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
