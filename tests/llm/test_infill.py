"""Fill-in-middle: boundary sets against plain lists of offsets, the operator against the plain definition."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import infill
from clientele.llm.infill import Array, Bitmap, Boundaries, Recipe, Runs, container

MIXED = "aé日😀"


def offsets_of(text):
    out, at = [], 0
    for c in text:
        out.append(at)
        at += len(c.encode())
    return [*out, at]


def all_of(made):
    return [made.select(i) for i in range(made.size)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(MIXED), max_size=60))
def test_code_points(text):
    assert all_of(Boundaries.of_code_points(text.encode())) == offsets_of(text)


@pytest.mark.parametrize("n", [0, 1, 65534, 65535, 65536, 65537, 131072])
def test_container_borders(n):
    for text in ("x" * n, "x" * max(0, n - 2) + "é", "é" + "x" * max(0, n - 2)):
        assert all_of(Boundaries.of_code_points(text.encode())) == offsets_of(text)


def test_long_mixed_text_uses_every_form():
    r = random.Random(3)
    text = "a" * 70000 + "".join(r.choice("é日") for _ in range(70000)) + "".join("😀" * 300 + "abc" * 5000 + "é" for _ in range(20)) + "😀" * 40000
    made = Boundaries.of_code_points(text.encode())
    want = offsets_of(text)
    assert made.size == len(want)
    for i in [*r.sample(range(len(want)), 3000), 0, len(want) - 1]:
        assert made.select(i) == want[i]
    with pytest.raises(IndexError):
        made.select(len(want))


@pytest.mark.parametrize("offsets, kind", [
    (range(65536), Runs), (range(0, 65536, 2), Bitmap), (range(0, 65536, 20), Array), ([7], Array), ([*range(100, 900), 5000], Runs),
    ([i for i in range(65536) if i % 16], Bitmap),
])
def test_forms_of_containers(offsets, kind):
    offsets = np.array(list(offsets))
    made = container(offsets)
    assert type(made) is kind and made.size == len(offsets)
    assert [made.select(i) for i in range(len(offsets))][:: max(1, len(offsets) // 500)] == offsets[:: max(1, len(offsets) // 500)].tolist()


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("a\né"), max_size=50))
def test_lines_as_units(text):
    made = Boundaries.of_units(text.encode(), re.compile(infill.LINES))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert all_of(made) == list(np.cumsum([0, *[len(x.encode()) for x in lines]]))


def test_units_must_cover_the_text():
    with pytest.raises(ValueError):
        Boundaries.of_units(b"a b", re.compile(rb"\w+"))
    far = b"x" * 200000 + b"\n" + b"y"
    assert all_of(Boundaries.of_units(far, re.compile(infill.LINES))) == [0, 200001, 200002]


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "P", "<M>"), ("ab", "bc", "<M>"), ("", "<S>", "<M>")])
def test_marks_that_overlap_are_refused(marks):
    with pytest.raises(ValueError):
        Recipe(*marks)


def plain(key, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return key, n, "plain", None, None, text, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return key, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}", text
    return key, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}", text


def test_rows_equal_the_definition(spark):
    r = random.Random(5)
    texts = [None, "", "a", "<", "<P", "<<<", "has <M> in it", "x" * 200000, "é😀\n" * 60000, "\x00﻿a"]
    texts += ["".join(r.choice([*MIXED, " ", "<", ">", "P", "S", "M", "\n"]) for _ in range(r.randint(0, 40))) for _ in range(400)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no key", "x"), (5, "<<<", "y"), (5, "<<<", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, draws string")
    made = infill.fill_in_middle(df)
    got = made.withColumn("restored", infill.restore(made["output"], made["form"])).collect()
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(plain(k, t) for k, t, _ in rows)
    assert {g.form for g in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(df.limit(0)).count() == 0


def test_other_units_marks_and_shares(spark):
    df = spark.createDataFrame([(str(i), "one\ntwo\n\nthree", 1) for i in range(200)], "doc_id string, text string, n int")
    recipe = Recipe("[PRE]", "[SUF]", "[MID]", rate=50, suffix_first=100, units=infill.LINES)
    made = infill.fill_in_middle(df, recipe, seed=7)
    got = made.withColumn("restored", infill.restore(made["output"], made["form"], recipe)).collect()
    assert all(g.restored == "one\ntwo\n\nthree" and g.n == 4 for g in got)
    forms = [g.form for g in got]
    assert set(forms) == {"plain", "spm"} and 60 < forms.count("spm") < 140
    assert all(g.prefix_units + g.middle_units <= 4 for g in got if g.form == "spm")
