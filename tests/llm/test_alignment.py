"""Alignment of two tokenizers: the fragments as a monoid over any byte ranges, the rows against the plain definition."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clientele.llm import alignment as A

BYTES, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def ends(cuts, size):
    return sorted({*(c for c in cuts if 0 < c < size), size})


def plain_groups(a, a_ends, b, b_ends):
    out, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        x, y = a_ends.index(end) + 1, b_ends.index(end) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 40), st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40)), st.sets(st.integers(1, 39)), st.randoms())
def test_fragments_of_any_byte_ranges_compose_in_any_order(size, a_cuts, b_cuts, borders, r):
    a_ends, b_ends = ends(a_cuts, size), ends(b_cuts, size)
    a, b = [100 + i for i in range(len(a_ends))], [500 + i for i in range(len(b_ends))]
    places = [0, *ends(borders, size)]
    parts = []
    for lo, hi in zip(places, places[1:]):
        mine = [(x, e) for x, e in zip(a, a_ends) if lo < e <= hi], [(x, e) for x, e in zip(b, b_ends) if lo < e <= hi]
        parts.append(A.lift(*[np.array([pair[i] for pair in side], np.int64) for side in mine for i in (0, 1)]))
    straight = A.START + reduce(A.Fragment.__add__, parts)
    tree = list(parts)
    while len(tree) > 1:
        at = r.randrange(len(tree) - 1)
        tree[at : at + 2] = [tree[at] + tree[at + 1]]
    assert A.START + tree[0] == straight
    want = plain_groups(a, a_ends, b, b_ends)
    assert straight.groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)
    assert straight.n_a == len(a) and straight.n_b == len(b) and len(straight.links) == 8 * len(want) and straight.tail == ([], [])


class Plain:
    """The definition, text by text."""

    def __init__(self):
        self.first, self.second = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=MODEL)
        self.first.encode_special_tokens = True
        letters = A._byte_letters()
        self.entry = {i: bytes(letters[c] for c in t) for t, i in self.first.get_vocab(with_added_tokens=False).items()}

    def piece(self, i):
        p = self.second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return [], [], []
        a, b = self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text)
        whole = (" " + text).encode()
        parts = [[self.entry[i] for i in a], [self.piece(i) for i in b]]
        if any(b"".join(p) != whole for p in parts):
            return [], [], []
        a_ends, b_ends = ([sum(map(len, p[: i + 1])) for i in range(len(p))] if len(p) < 3000 else np.cumsum([len(t) for t in p]).tolist() for p in parts)
        out, i, j, at = [], 0, 0, {e: k + 1 for k, e in enumerate(b_ends)}
        for k, e in enumerate(a_ends):
            if e in at:
                out.append((a[i : k + 1], b[j : at[e]]))
                i, j = k + 1, at[e]
        return a, b, out

    def rows(self, docs):
        found = [(k, *self.groups(t)) for k, t in docs]
        counts = Counter((x[-1], y[-1]) for *_, groups in found for x, y in groups)
        top = {}
        for (_, y), n in counts.items():
            top[y] = max(top.get(y, 0), n)
        for k, a, b, groups in found:
            pairs = [(x[-1], y[-1]) for x, y in groups]
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            yield (
                k, len(a), len(b), len(groups), len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )


PARTS = ["a", "the", " ", "  ", "\n", "'s", "12", "é", "é", "日本", "　", "\xa0", "😀", "Ⅷ", "--", "ing", "\r\n", " of.", " strange", "<|endoftext|>", "<s>", "<0x41>", "﻿", "\x00", "th", "er"]


@pytest.fixture(scope="module")
def docs():
    r = random.Random(11)
    rows = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(1, 30)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " "), (403, "with ▁ in it"), (404, "a ▁ b"), (None, "no key"), (405, "twice over"), (405, "twice over")]
    rows += [(500, " ".join(r.choice(["the", "house", "ofé", "x1y2", "日本語", "  wide"]) for _ in range(30_000))), (501, "long " * 20_000 + "▁")]
    rows += [(502, "unbroken" * 12_000), (503, ("tail " * 14_000).strip() + "  \n")]
    return rows


@pytest.fixture(scope="module")
def want(docs):
    return Counter(Plain().rows(docs))


@pytest.mark.parametrize("most", [A.TABLE, 40, 0])
def test_rows_equal_the_definition(spark, docs, want, most):
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, a int").repartition(5)
    assert Counter(map(tuple, A.align(df, BYTES, MODEL, most=most).collect())) == want


def test_short_ranges_in_several_levels(spark, docs, want):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(map(tuple, A.align(df, BYTES, MODEL, long=60, length=500).collect())) == want


def test_ranks_give_the_ids_of_the_file():
    pair, library = A.tokenizers(BYTES, MODEL), Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    assert pair.ranked is not None
    r = random.Random(21)
    units = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(3000)] + [" " * 5000 + "x", "a" * 20_000, "\n" * 3000]
    assert pair._first_ids(units) == [e.ids for e in library.encode_batch(units, add_special_tokens=False)]
    other = A.Pair.__new__(A.Pair)
    other.first, other.ranked = library, None
    assert other._first_ids(units[:200]) == pair._first_ids(units[:200])


def test_bounded_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(A, "CACHED", 3)
    pair = A.Pair(BYTES, MODEL)
    big = A.tokenizers(BYTES, MODEL)
    for text in ["one two three four one", "five", "one two " * 50, "x▁y one"]:
        assert list(pair.fragments([A._units(text)])) == list(big.fragments([A._units(text)]))
        assert len(pair.known) <= 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert A.align(df, BYTES, MODEL).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in A.align(only, BYTES, MODEL).collect()} == {(0, 0, 0, 0, 0, 0, "")}
