"""Token counts against the libraries, whatever stands in the broadcast table."""

import random
from collections import Counter

import public_tokenizers as P
import pytest
import regex
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clientele.llm import token_counts as T

BYTES, WORDS, MODEL = (P.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = [
    "a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "12", "é", "é", "日本", "　", "\xa0", "\x1c", "\x85", "😀", "²", "Ⅷ", "--", "===", "!!", "ing", "\r\n",
    "​", "ZZ", "_", "the,", " of.", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "<s>", "▁", "﻿", "\x00",
]


def library(path):
    if path.endswith(".model"):
        model = SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t or ""))
    made = Tokenizer.from_file(path)
    return lambda t: len(made.encode(t or "", add_special_tokens=False).ids)


def texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS, MODEL])
@pytest.mark.parametrize("warm", [[], ["the", " the", " of", "<|endoftext|>", "12", "\n"]])
def test_same_counts_as_the_library(path, warm):
    rule = T.tokenizer(path, P.PATTERN)
    lengths, count = T.Lengths(T.frequent(warm, path, P.PATTERN).table(), rule, {}, most=50), library(path)
    for text in texts(1, 3000):
        assert lengths.count(text) == count(text), repr(text)
    assert len(lengths.cache) <= 50


@pytest.mark.parametrize("path", [BYTES, WORDS, MODEL])
def test_long_texts_in_slices(path, monkeypatch):
    monkeypatch.setattr(T, "SLICE", 100)
    lengths, count = T.Lengths({}, T.tokenizer(path, P.PATTERN), {}), library(path)
    for text in ["".join(texts(s, 60)) for s in range(20)] + ["x" * 5000, "one two  three " * 300, " ", "  a"]:
        assert lengths.count(text) == count(text)


def test_compact_table_keeps_its_entries():
    made = {" the": 1, "é😀": 3, "\x00": 1, "日": 2}
    assert T.Frequent.of(made).table() == made
    assert T.Frequent.of({}).table() == {}


def test_frequent_items_are_found_over_all_tasks(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [" ".join(r.choices(words, [1 / (i + 1) for i in range(400)], k=50)) for _ in range(2000)] + [None, ""]
    rows.append("long " * 60_000)  # more than a slice
    df = spark.createDataFrame([(t,) for t in rows], "text string").repartition(13)
    pieces = Counter(p for t in rows for p in regex.findall(P.PATTERN, t or ""))
    got = T.frequent_items(df, "text", P.PATTERN, most=40, tracked=2048)
    assert set(got) == {p for p, _ in pieces.most_common(40)}
    assert T.frequent_items(df.limit(0), "text", P.PATTERN) == []
    assert T.frequent_items(df.where("text is null"), "text", P.PATTERN) == []


@pytest.mark.parametrize("path", [BYTES, MODEL])
def test_rows(spark, path):
    rows = [(i, t, 9) for i, t in enumerate(texts(7, 200))] + [(None, "no key", 1), (3, "twice", 1), (3, "twice", 1), (4, None, 1), (5, "", 1), (6, "very long " * 150_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)
    count = library(path)
    want = Counter((k, len((t or "").encode()), count(t)) for k, t, _ in rows)
    assert Counter(map(tuple, T.count_tokens(df, path, P.PATTERN).collect())) == want
    assert T.count_tokens(df.limit(0), path, P.PATTERN).count() == 0
