"""Licence scan with a generalised suffix automaton over the words of licence notices.

All notices are inserted into one suffix automaton over word numbers. A text is streamed through it once; at each word the
automaton gives the longest run ending there that occurs in some notice (the matching statistics). Where a run can't be
extended it is a maximal match; matches of at least ``least`` words are chained, in the order of text and notice, into
covered spans of a notice. A notice that is covered to ``cover`` or more gives its label. Short phrases are notices too:
they count wherever they end inside the current run.

A word outside all notices empties the run, so only runs of known words are streamed; this changes no result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.bpe import _arrow
from clientele.llm.common import words_of

# Phrases that name a licence, and the usual notices, as lowered words.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
)


@dataclass
class Node:
    length: int
    link: int = -1
    after: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (notice, words up to the end of the run)
    phrases: list[int] = field(default_factory=list)  # phrases that end where a run of this node ends


class Automaton:
    def __init__(self, phrases=PHRASES, notices=NOTICES, least: int = 3, cover: float = 0.8, gap: int = 12) -> None:
        self.phrases, self.notices, self.least, self.cover, self.gap = phrases, notices, least, cover, gap
        texts = [words_of(t) for t, _ in (*phrases, *notices)]
        self.sizes = [len(t) for t in texts]
        self.number: dict[bytes, int] = {}
        for t in texts:
            for w in t:
                self.number.setdefault(w, len(self.number) + 1)
        self.nodes = [Node(0)]
        coded = [[self.number[w] for w in t] for t in texts]
        for t in coded:
            self._insert(t)
        for k, t in enumerate(coded):  # where each notice's prefixes end, handed on to all suffixes
            at = 0
            for n, w in enumerate(t, 1):
                at = self.nodes[at].after[w]
                up = at
                while up > 0:
                    self.nodes[up].ends.append((k, n))
                    up = self.nodes[up].link
        for k in range(len(phrases)):
            at = 0
            for w in coded[k]:
                at = self.nodes[at].after[w]
            for v in range(1, len(self.nodes)):
                up = v
                while up > 0 and up != at:
                    up = self.nodes[up].link
                if up == at:
                    self.nodes[v].phrases.append(k)
        self.known = self.number.get

    def _insert(self, text: list[int]) -> None:
        nodes, last = self.nodes, 0
        for w in text:
            if w in nodes[last].after:
                to = nodes[last].after[w]
                last = to if nodes[to].length == nodes[last].length + 1 else self._copy(last, w, to)
                continue
            new = len(nodes)
            nodes.append(Node(nodes[last].length + 1))
            at = last
            while at >= 0 and w not in nodes[at].after:
                nodes[at].after[w] = new
                at = nodes[at].link
            if at < 0:
                nodes[new].link = 0
            else:
                to = nodes[at].after[w]
                nodes[new].link = to if nodes[to].length == nodes[at].length + 1 else self._copy(at, w, to)
            last = new

    def _copy(self, at: int, w: int, to: int) -> int:
        """A node for the runs of ``to`` that are no longer than one word behind ``at``."""
        nodes = self.nodes
        new = len(nodes)
        nodes.append(Node(nodes[at].length + 1, nodes[to].link, dict(nodes[to].after)))
        nodes[to].link = new
        while at >= 0 and nodes[at].after.get(w) == to:
            nodes[at].after[w] = new
            at = nodes[at].link
        return new

    def scan(self, words: list[bytes]):
        """``(places, spans)``: (start, phrase) of every phrase, and covered spans (start, end, notice, share)."""
        ids = np.fromiter(map(self.known, words, repeat(0)), dtype=np.int32, count=len(words))
        edge = np.flatnonzero(np.diff(ids != 0, prepend=False, append=False))
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []  # start, end, node
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a > 1:
                self._stream(ids[a:b].tolist(), a, places, matches)
        return places, self._chains(matches)

    def _stream(self, ids, base, places, matches) -> None:
        nodes, at, size = self.nodes, 0, 0
        for i, w in enumerate(ids, base):
            before = (i - size, i, at)
            shrunk = False
            while at and w not in nodes[at].after:
                at = nodes[at].link
                size = nodes[at].length
                shrunk = True
            if shrunk and before[1] - before[0] >= self.least:
                matches.append(before)
            if w in nodes[at].after:
                at, size = nodes[at].after[w], size + 1
            for k in nodes[at].phrases:
                if size >= self.sizes[k]:
                    places.append((i + 1 - self.sizes[k], k))
        if size >= self.least:
            matches.append((base + len(ids) - size, base + len(ids), at))

    def _chains(self, matches):
        """The best chain of each notice around each place: matches in both orders with gaps of at most ``gap`` words."""
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        for start, end, at in matches:
            for k, n in self.nodes[at].ends:
                if k >= len(self.phrases):
                    by.setdefault(k, []).append((start, end, n - (end - start), n))
        spans = []
        for k, own in by.items():
            own.sort()
            open_: list[list[int]] = []  # text start, text end, notice end, covered words
            for start, end, p, n in own:
                # Everything further back than the gap can't be continued any more.
                for c in [c for c in open_ if start - c[1] > self.gap]:
                    open_.remove(c)
                    spans.append((c[0], c[1], k, c[3] / self.sizes[k]))
                fit = [c for c in open_ if c[2] <= p and c[1] <= start]
                best = max(fit, key=lambda c: c[3], default=None)
                if best is not None:
                    best[1], best[2], best[3] = end, n, best[3] + end - start
                else:
                    open_.append([start, end, n, end - start])
            spans += [(c[0], c[1], k, c[3] / self.sizes[k]) for c in open_]
        return sorted((a, b, k, share) for a, b, k, share in spans if share >= 0.3)

    def label(self, k: int) -> str:
        return (*self.phrases, *self.notices)[k][1]

    def report(self, text: str | None) -> dict:
        words = words_of(text)
        places, spans = self.scan(words)
        base = sorted({self.label(k) for _, k in places})
        found = {self.label(k) for _, _, k, share in spans if share >= self.cover}
        score = 1.0 if places else max((share for *_, share in spans), default=0.0)
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min((s for s, _ in places), default=None),
            "last_word": max((s for s, _ in places), default=None),
            "base_labels": ",".join(base),
            "labels": ",".join(sorted(found.union(base))),
            "score": min(1.0, score),
            "spans": [{"first": a, "last": b - 1, "label": self.label(k), "share": share} for a, b, k, share in spans],
        }


@lru_cache(maxsize=4)
def automaton(phrases=PHRASES, notices=NOTICES, least=3, cover=0.8, gap=12) -> Automaton:
    return Automaton(phrases, notices, least, cover, gap)


REPORT = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))),
])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: ``key``, counts and places of the phrases, labels, score and covered spans.

    A null or empty text has no words, no labels and score 0; repeated rows are reported each; other columns are ignored.
    No shuffle: a text of any length is streamed within its row. ``score``: the largest share of a notice that is covered,
    1 where a phrase stands.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = pa.schema([("key", _arrow(docs)), *REPORT])

    def run(batches):
        reader = automaton(**options)
        for batch in batches:
            rows = [reader.report(t.as_py()) for t in batch.column(1)]
            columns = [batch.column(0), *(pa.array([r[f.name] for r in rows], f.type) for f in REPORT)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<first: long, last: long, label: string, share: double>>").withColumnRenamed("key", key)
