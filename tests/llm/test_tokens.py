import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import bpe, packing

PATH = P.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "12", "é", "ß", "日本", "\u3000", "\xa0", "\x1c", "\x85", "😀", "ª", "²", "Ⅷ", "--", "===", "!!", "ing", "\r\n", "\u0301", "\u200b", "ZZ", "_", "the,", " of."]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_same_ids_as_the_library(codec, tik):
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 25)))
        assert ids(codec, text) == tik.encode_ordinary(text), repr(text)
        assert codec.decode(codec.encode(text)) == text


@pytest.mark.parametrize("text", ["a" * 30000, "thereatin" * 4000, " " * 3000 + "x", "-" * 5000, "ab" * 3000 + "é" * 3000, "x " * 20000])
def test_long_pieces(codec, tik, text):
    assert ids(codec, text) == tik.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    codec = bpe.codec(PATH, P.PATTERN)
    assert codec.bytes_of(codec.encode(text)) == text.encode()


def test_small_state_cache_gives_the_same(codec):
    small = bpe.Transducer(codec.transducer.ranks, states=5)
    for piece in (b" thereatingly", b"abcdefgh" * 300, "éèê日本".encode()):
        assert small.encode(piece) == codec.transducer.encode(piece)


@given(st.binary(max_size=30), st.integers(1, 7))
@settings(max_examples=300, deadline=None)
def test_utf8_machine_is_incremental(data, step):
    m = bpe.Utf8()
    text = "".join(m.feed(data[i : i + step]) for i in range(0, len(data), step)) + m.feed(b"", final=True)
    assert text == data.decode("utf-8", "replace")


def test_frames(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, "y"), (3, "", "z"), (4, "long " * 50000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.key is None, r.key, r.n_tokens, r.decoded_sha256) for r in bpe.digests(df, PATH, P.PATTERN).collect())
    want = sorted((k is None, k, None, hashlib.sha256((t or "").encode()).hexdigest()) for k, t, _ in rows)
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]
    encoded = bpe.encode(df, PATH, P.PATTERN)
    assert sorted((r.key or 0, r.text) for r in bpe.decode(encoded, PATH, P.PATTERN).collect()) == sorted((k or 0, t or "") for k, t, _ in rows)
    assert bpe.digests(df.limit(0), PATH, P.PATTERN).count() == 0


def test_packing_encodes_as_the_library(codec, tik):
    encode = packing.encoder(PATH, P.PATTERN)
    r = random.Random(6)
    for _ in range(500):
        text = "".join(r.choice([*PARTS, "<|endoftext|>"]) for _ in range(r.randint(0, 25)))
        assert encode(text).tolist() == tik.encode_ordinary(text)
    for text in (" " * 300_000 + "x", "a" * 300_000, "\n" * 100_000, "x" + " \n" * 50_000):
        assert encode(text).tolist() == ids(codec, text)
    assert encode(None).tolist() == encode("").tolist() == []


def test_digests_come_from_the_stream_in_chunks(spark, codec):
    """Characters of several tokens lie across the borders of the chunks."""
    text = "é😀日本 mixed " * 30_000 + "😀" * 70_000
    encoded = codec.encode(text)
    part = encoded[:40_000]
    for step in (4, 40, 4096):
        assert "".join(codec.stream(part[at : at + step] for at in range(0, len(part), step))) == codec.decode(part)
    row = bpe.digests(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, P.PATTERN).first()
    assert (row.n_tokens, row.decoded_sha256) == (len(encoded) // 4, hashlib.sha256(text.encode()).hexdigest())


def brute(sizes, most):
    rows, room = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [(room[r], r) for r in range(len(rows)) if room[r] >= sizes[i]]
        if fit:
            r = min(fit)[1]
        else:
            rows.append([])
            room.append(most)
            r = len(rows) - 1
        rows[r].append(i)
        room[r] -= sizes[i]
    return sorted(room)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_leaves_the_rooms_of_brute_force(sizes):
    rows = packing.best_fit(sizes, 50)
    assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
    assert sorted(50 - sum(sizes[i] for i in r) for r in rows) == brute(sizes, 50)


def test_packing_is_lossless(spark, codec):
    texts = {1: "a b c", 2: "long text " * 400, 3: "", 4: None, 5: "x" * 3000, 6: "short"}
    rows = [*texts.items(), (6, "short")]
    df = spark.createDataFrame([(k, t, 9) for k, t in rows], "doc_id long, text string, n_tokens int").coalesce(1)
    packed = packing.pack(df, PATH, P.PATTERN, length=64, tokens=500, end=50256, pad=50256).collect()
    found = []
    for r in packed:
        data, cu, pos = np.frombuffer(r.ids, "<u2"), r.cu_seqlens, np.frombuffer(r.position_ids, "<u2")
        assert len(data) == 64 and cu[-1] == r.n_tokens and (data[r.n_tokens :] == 50256).all()
        for i, (k, part, off) in enumerate(zip(r["keys"], r.parts, r.offsets)):
            assert pos[cu[i] : cu[i + 1]].tolist() == list(range(cu[i + 1] - cu[i]))
            found.append((k, part, off, data[cu[i] : cu[i + 1]].tolist()))
    assert sum(f[0] == 6 for f in found) == 2
    for k, t in texts.items():
        got = [x for f in sorted(f for f in {(f[0], f[1], tuple(f[3])) for f in found} if f[0] == k) for x in f[2]]
        want = ids(codec, t)
        assert got == (want + [50256] if want else [])
    assert packing.pack(df.limit(0), PATH, P.PATTERN).count() == 0
