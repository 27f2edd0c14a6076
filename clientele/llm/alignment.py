"""Two tokenizers' tokens of the same bytes, cut into the smallest groups that end together, and corpus-wide link counts.

A byte range of a document gives a fragment: an open prefix (tokens up to the first place where a token of each kind ends),
closed groups, and an open suffix (tokens behind the last such place). Fragments of neighbouring ranges compose: the suffix
of the left and the prefix of the right become one closed group. Composition is associative, so the fragments of a very
long document are made in different tasks and composed in a tree of grouped steps of at most ``FAN_IN`` fragments.

Both tokenizers start a token at a single blank between other characters (``BLANK``), so texts are tokenised in units
between such blanks, and the ids of a unit are kept in a bounded cache of the worker. Long texts are cut into ranges
there as well; a text without such blanks stays one range.

Link counts: pairs are counted per document, then over the corpus. Pairs with high counts, as many as fit ``TABLE``, are
broadcast as sorted arrays; links of all other pairs are joined by a shuffle, where no pair is frequent any more.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import BLANK, slices, stored

LONG, RANGE = 65_536, 32_768  # characters: longer texts are cut, into ranges of about this length
FAN_IN = 16
CACHED, LONGEST = 200_000, 64  # units in the worker's cache, characters of a cached unit
TABLE = 1 << 18  # pairs in the broadcast table, 17 bytes each
GROUP, TOGETHER = 1 << 20, 4096  # characters of the texts that are handled together; units that are tokenised in one call

Tokens = tuple[Sequence[int], Sequence[int]]  # ids of the first and of the second tokenizer


@dataclass(frozen=True)
class Fragment:
    """``cut``: whether a common end lies in the range; if not, ``head`` holds all its tokens. ``groups``: the closed groups
    as text; ``links``: their last tokens as pairs of 32-bit integers. An empty head with a cut stands for a range that is
    known to begin at a common end, such as the start of a document."""

    cut: bool
    head: Tokens
    groups: str = ""
    links: bytes = b""
    tail: Tokens = ((), ())
    n_a: int = 0
    n_b: int = 0

    def __add__(self, right: Fragment) -> Fragment:
        n_a, n_b = self.n_a + right.n_a, self.n_b + right.n_b
        if not self.cut:
            return Fragment(right.cut, _join(self.head, right.head), right.groups, right.links, right.tail, n_a, n_b)
        if not right.cut:
            return Fragment(True, self.head, self.groups, self.links, _join(self.tail, right.head), n_a, n_b)
        middle, link = closed(_join(self.tail, right.head))
        groups = ";".join(filter(None, (self.groups, middle, right.groups)))
        return Fragment(True, self.head, groups, self.links + link + right.links, right.tail, n_a, n_b)


START = Fragment(True, ([], []))  # the empty range at the start of a document


def _join(left: Tokens, right: Tokens) -> Tokens:
    return [*left[0], *right[0]], [*left[1], *right[1]]


def closed(tokens: Tokens) -> tuple[str, bytes]:
    """A group as text, and its link."""
    a, b = tokens
    if not a and not b:
        return "", b""
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b)), struct.pack("<II", a[-1], b[-1])


def lift(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of the tokens that end in a byte range; ends, in order, count from any common place."""
    at = np.searchsorted(b_ends, a_ends)
    common = np.flatnonzero(b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends) if len(b_ends) else np.empty(0, np.int64)
    if not len(common):
        return Fragment(False, (a.tolist(), b.tolist()), n_a=len(a), n_b=len(b))
    a_cuts, b_cuts = common + 1, at[common] + 1  # tokens up to each common end
    first, last = (a_cuts[0], b_cuts[0]), (a_cuts[-1], b_cuts[-1])
    groups = _text(a[first[0] : last[0]], np.diff(a_cuts), b[first[1] : last[1]], np.diff(b_cuts))
    pairs = np.stack([a[a_cuts[1:] - 1], b[b_cuts[1:] - 1]], axis=1).astype("<u4").tobytes()
    head = a[: first[0]].tolist(), b[: first[1]].tolist()
    return Fragment(True, head, groups, pairs, (a[last[0] :].tolist(), b[last[1] :].tolist()), len(a), len(b))


def _text(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> str:
    """Closed groups as text: every token is put at its place in the merged order, with the sign that follows it."""
    if not len(a_sizes):
        return ""
    a_upto, b_upto = np.cumsum(a_sizes), np.cumsum(b_sizes)
    merged = np.empty(len(a) + len(b), np.int64)
    signs = np.zeros(len(merged), np.int64)
    merged[np.arange(len(a)) + np.repeat(b_upto - b_sizes, a_sizes)] = a
    merged[np.arange(len(b)) + np.repeat(a_upto, b_sizes)] = b
    signs[a_upto + b_upto - b_sizes - 1] = 1  # the last of a group's first kind
    signs[a_upto + b_upto - 1] = 2
    size = 1 << int(merged.max()).bit_length()
    return "".join(map(_labels(size).__getitem__, (merged + signs * size).tolist()))[:-1]


@lru_cache(maxsize=2)
def _labels(size: int) -> list[str]:
    """Ids below ``size`` followed by a comma, then by a bar, then by a semicolon."""
    return [f"{i}{sign}" for sign in ",|;" for i in range(size)]


# Fixed value: the pattern of the byte-level pre-tokenizer in the tokenizers library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANKS = re.compile(r"\s{1000}")  # too long a run for the pattern engine of tiktoken


class Pair:
    """The two tokenizers, with the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True  # their strings in a text are plain text
        letters = _byte_letters()
        self.first_bytes = {}
        for token, i in self.first.get_vocab(with_added_tokens=False).items():
            self.first_bytes[i] = bytes(letters[c] for c in token)
        self.ranked = self._ranked(byte_level)
        self.second = SentencePieceProcessor(model_file=pieces)
        self.second_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            self.second_bytes.append(bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode())
        vocabulary = (self.second.id_to_piece(i) for i in range(self.second.get_piece_size()))
        if any("▁" in p.lstrip("▁") for p in vocabulary):
            raise ValueError("pieces that go across a blank: texts can't be cut there")
        self.first_sizes = np.zeros(max(self.first_bytes) + 1, np.int64)
        for i, token in self.first_bytes.items():
            self.first_sizes[i] = len(token)
        self.second_sizes = np.array([len(t) for t in self.second_bytes], np.int64)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def learn(self, units: Iterable[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Ids of units, each a blank and a text, as 32-bit integers; None where the tokens don't give the unit's bytes again."""
        wanted = set(units)
        new = [u for u in wanted if u not in self.known]
        made = {u: self.known[u] for u in wanted if u in self.known} if len(new) < len(wanted) else {}
        for at in range(0, len(new), TOGETHER):  # what the libraries return takes far more room than the ids
            some = new[at : at + TOGETHER]
            made.update(zip(some, self._encode(some)))
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
        self.known.update({u: made[u] for u in new[:CACHED] if len(u) <= LONGEST})
        return made

    def _ranked(self, path: str):
        """The same tokenizer as ranks for tiktoken, which is faster on short texts, if its file allows that: plain byte-level
        pre-tokens, and ids in the order of the merges."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        before, merges = rules["pre_tokenizer"] or {}, rules["model"]["merges"]
        ids = [rules["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        plain = rules["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if not plain or any(a >= b for a, b in zip(ids, ids[1:])) or len(ids) + 256 != len(self.first_bytes):
            return None
        return tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks={t: i for i, t in self.first_bytes.items()}, special_tokens={})

    def _first_ids(self, units: list[str]) -> list[list[int]]:
        if self.ranked is None:
            return [e.ids for e in self.first.encode_batch_fast(units, add_special_tokens=False)]
        encode = self.ranked.encode_ordinary
        return [self.first.encode(u, add_special_tokens=False).ids if len(u) >= 1000 and BLANKS.search(u) else encode(u) for u in units]

    def _encode(self, units: list[str]) -> list[tuple[bytes, bytes] | None]:
        whole, ends = "".join(units).encode(), np.cumsum([len(u.encode()) for u in units])
        found = (
            (self._first_ids(units), self.first_bytes, self.first_sizes),
            (self.second.encode([u[1:] for u in units], num_threads=1), self.second_bytes, self.second_sizes),
        )
        sides, same = [], True
        for lists, table, sizes in found:
            flat = np.fromiter(chain.from_iterable(lists), np.int64)
            upto = np.cumsum([len(ids) for ids in lists])
            # Every unit is given back if all tokens together are, and the tokens of each end where it ends.
            sums = np.concatenate([[0], np.cumsum(sizes[flat])])[upto]
            same = same and np.array_equal(sums, ends) and b"".join(map(table.__getitem__, flat.tolist())) == whole
            data, cuts = flat.astype("<u4").tobytes(), [0, *(4 * upto).tolist()]
            sides.append([data[i:j] for i, j in zip(cuts, cuts[1:])])
        pairs = list(zip(*sides))
        if same:
            return pairs
        back = [[b"".join([table[i] for i in ids]) for ids in lists] for lists, table, _ in found]
        return [pair if a == b == u.encode() else None for pair, a, b, u in zip(pairs, *back, units)]

    def fragments(self, texts: list[list[str]]) -> Iterator[Fragment | None]:
        """The fragment of each list of units, the first of which begins at a common end."""
        known = self.learn(u for units in texts for u in units)
        for units in texts:
            parts = [known[u] for u in units]
            if None in parts:
                yield None
            elif not parts:
                yield START
            else:
                a, b = (np.frombuffer(b"".join([p[side] for p in parts]), "<u4").astype(np.int64) for side in (0, 1))
                yield START + lift(a, np.cumsum(self.first_sizes[a]), b, np.cumsum(self.second_sizes[b]))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def tokenizers(byte_level: str, pieces: str) -> Pair:
    return Pair(byte_level, pieces)


FRAGMENT = pa.schema([
    ("ok", pa.bool_()), ("cut", pa.bool_()), ("head_a", pa.list_(pa.int32())), ("head_b", pa.list_(pa.int32())), ("groups", pa.string()),
    ("links", pa.binary()), ("tail_a", pa.list_(pa.int32())), ("tail_b", pa.list_(pa.int32())), ("n_a", pa.int64()), ("n_b", pa.int64()),
])
FRAGMENT_FIELDS = "ok boolean, cut boolean, head_a array<int>, head_b array<int>, groups string, links binary, tail_a array<int>, tail_b array<int>, n_a long, n_b long"
DOCUMENT = pa.schema([
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
    ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
])
DOCUMENT_FIELDS = "n_a long, n_b long, n_groups long, groups_sha256 string, a array<int>, b array<int>, times array<int>"


def _packed(f: Fragment | None) -> tuple:
    if f is None:
        return (False, False, [], [], "", b"", [], [], 0, 0)
    return (True, f.cut, *f.head, f.groups, f.links, *f.tail, f.n_a, f.n_b)


def _unpacked(row: dict) -> Fragment | None:
    if not row["ok"]:
        return None
    return Fragment(row["cut"], (row["head_a"], row["head_b"]), row["groups"], row["links"], (row["tail_a"], row["tail_b"]), row["n_a"], row["n_b"])


def _batch(columns: list[pa.Array], rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    made = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)]
    names = [*(f"c{i}" for i in range(len(columns))), *schema.names]
    return pa.RecordBatch.from_arrays([*columns, *made], names=names)


def _document(f: Fragment | None) -> tuple:
    """Counts, digest and distinct pairs (how often each is linked) of a whole document; zeros without tokens."""
    if f is None or not f.n_a:
        return 0, 0, 0, "", [], [], []
    done = START + f
    pairs = np.frombuffer(done.links, "<u4").reshape(-1, 2).astype(np.uint64)
    distinct, times = np.unique(pairs[:, 0] << np.uint64(32) | pairs[:, 1], return_counts=True)
    digest = hashlib.sha256(done.groups.encode()).hexdigest()
    return done.n_a, done.n_b, len(pairs), digest, (distinct >> np.uint64(32)).astype(np.int32), distinct.astype(np.uint32).astype(np.int32), times.astype(np.int32)


def _units(text: str, first: bool = True) -> list[str]:
    """Units of a text, or of a range of it, which begins with the blank it was cut at."""
    parts = BLANK.split(" " + text if first else text)
    return [parts[0], *[" " + p for p in parts[1:]]]


def _grouped(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """First row and texts of groups of rows of about ``GROUP`` characters."""
    rows, size, start = [], 0, 0
    for i, t in enumerate(texts):
        rows.append(t.as_py())
        size += len(rows[-1] or "")
        if size >= GROUP:
            yield start, rows
            rows, size, start = [], 0, i + 1
    if rows:
        yield start, rows


def _rename(batch: pa.RecordBatch, names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(batch.columns, names=list(names))


def aligned(
    docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text", long: int = LONG, length: int = RANGE
) -> DataFrame:
    """One row per document: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256`` and the distinct linked pairs ``a``, ``b``
    with how often each is linked, ``times``.

    Null and empty texts, and texts whose tokens of either kind don't join to a blank and the text (such as those that
    hold U+2581), have no tokens: zeros, an empty digest, no pairs. Repeated rows give repeated rows, null keys stay, other
    columns are ignored, an empty table gives an empty one. Texts up to ``long`` characters stay in the task that reads
    them. Longer ones are cut into ranges of about ``length`` characters, which are tokenised in different tasks and composed
    in a tree.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[0].dataType.simpleString()
    size = F.length(F.coalesce("text", F.lit("")))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(byte_level, pieces)
        names = ["key", *DOCUMENT.names]
        for batch in batches:
            for start, texts in _grouped(batch.column(1)):
                rows = [_document(f) for f in pair.fragments([_units(t) if t else [] for t in texts])]
                yield _rename(_batch([batch.column(0).slice(start, len(rows))], rows, DOCUMENT), names)

    short = docs.where(size <= long).mapInArrow(whole, f"key {kind}, {DOCUMENT_FIELDS}")
    most = docs.agg(F.max(size)).first()[0] or 0
    if most <= long:
        return short
    ranges = stored(_ranges(docs.where(size > long).withColumn("row", F.monotonically_increasing_id()), length).repartition("row", "part"))

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(byte_level, pieces)
        names = ["row", "part", "key", *FRAGMENT.names]
        for batch in batches:
            parts = batch.column(1)
            for start, texts in _grouped(batch.column(3)):
                units = [_units(t, first=parts[start + i].as_py() == 0) for i, t in enumerate(texts)]
                rows = [_packed(f) for f in pair.fragments(units)]
                yield _rename(_batch([c.slice(start, len(rows)) for c in batch.columns[:3]], rows, FRAGMENT), names)

    fragments = ranges.mapInArrow(some, f"row long, part long, key {kind}, {FRAGMENT_FIELDS}")
    parts = -(-most // length)
    while parts > 1:
        fragments = _composed(fragments)
        parts = -(-parts // FAN_IN)

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", *DOCUMENT.names]
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                yield _rename(_batch([one.column("key")], [_document(_unpacked(one.to_pylist()[0]))], DOCUMENT), names)

    return short.unionByName(fragments.mapInArrow(last, f"key {kind}, {DOCUMENT_FIELDS}"))


def _ranges(docs: DataFrame, length: int) -> DataFrame:
    """Ranges of long texts: ``row``, ``part`` from 0 on, ``key``, ``text``."""
    kind = docs.schema["key"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = list(slices(batch.column("text")[i].as_py(), length))
                n = len(parts)
                same = pa.array([i] * n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(same), pa.array(range(n), pa.int64()), batch.column("key").take(same), pa.array(parts, pa.string())],
                    names=["row", "part", "key", "text"],
                )

    return docs.select("row", "key", "text").mapInArrow(cut, f"row long, part long, key {kind}, text string")


def _composed(fragments: DataFrame) -> DataFrame:
    """One level of the tree: up to ``FAN_IN`` neighbouring fragments of a document become one."""
    kind = fragments.schema["key"].dataType.simpleString()

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        found = [_unpacked(r) for r in rows]
        one = None if None in found else reduce(Fragment.__add__, found)
        columns = [pa.array([rows[0]["row"]], pa.int64()), pa.array([rows[0]["part"] // FAN_IN], pa.int64()), table.column("key").slice(0, 1).combine_chunks()]
        return pa.Table.from_batches([_rename(_batch(columns, [_packed(one)], FRAGMENT), ["row", "part", "key", *FRAGMENT.names])])

    grouped = fragments.withColumn("at", F.col("part").cast("long") - F.col("part") % FAN_IN).groupBy("row", "at")
    return grouped.applyInArrow(compose, f"row long, part long, key {kind}, {FRAGMENT_FIELDS}")


@dataclass(frozen=True)
class Table:
    """Counts of frequent pairs in the order of ``pairs`` (first id, 32 bits, second id), and whether each is a best one."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs in the table, and whether they are there."""
        if not len(self.pairs):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return at, self.pairs[at] == pairs


def pair_counts(documents: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` over the corpus and ``best``: whether no other pair of the same ``b`` has a higher count.

    Counted map-side first. A window holds the pairs of one second id, at most as many as the first vocabulary has ids.
    """
    pairs = documents.select(F.inline(F.arrays_zip("a", "b", "times"))).groupBy("a", "b").agg(F.sum("times").alias("count"))
    return pairs.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def links(documents: DataFrame, most: int = TABLE) -> DataFrame:
    """The rows of :func:`aligned` with ``n_links``, ``n_best`` (links whose pair is a best one of its ``b``) and ``count_sum`` (the
    counts of all links' pairs), instead of the pairs.

    ``most`` bounds the broadcast table at every size of the corpus. The pairs outside of it have small counts, so the join
    of their links meets no frequent key; with none outside there is no join.
    """
    spark = documents.sparkSession
    documents = stored(documents.withColumn("row", F.monotonically_increasing_id()))
    pairs = stored(pair_counts(documents))
    # Pairs by the power of two below their count: the lowest power from which on all pairs fit the table.
    sizes = {r.power: r.n for r in pairs.groupBy(F.floor(F.log2("count")).alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = 64, 0
    for power in sorted(sizes, reverse=True):
        held += sizes[power]
        if held > most:
            break
        least = power
    rare = any(power < least for power in sizes)
    power = F.floor(F.log2("count"))
    known = pairs.where(power >= least).select(F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long")).alias("pair"), "count", "best").toArrow()
    order = np.argsort(known.column("pair").to_numpy())
    shared = spark.sparkContext.broadcast(Table(*[known.column(c).to_numpy()[order] for c in ("pair", "count", "best")]))

    def batches_of(batches: Iterable[pa.RecordBatch]):
        """Each batch with its links' pairs, how often they occur, and the row they belong to."""
        for batch in batches:
            a, b, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b", "times"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("a").offsets.to_numpy()))
            yield batch, a << 32 | b, times, row

    names = ["row", "key", "n_a", "n_b", "n_groups", "groups_sha256"]

    def frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pair, times, row in batches_of(batches):
            at, found = shared.value.find(pair)
            row, times, at = row[found], times[found], at[found]
            sums = []
            for weight in (times * shared.value.best[at], times * shared.value.counts[at]) if len(at) else ([], []):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, weight)
                sums.append(total)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *map(pa.array, sums or [np.zeros(batch.num_rows, np.int64)] * 2)], names=[*names, "n_best", "count_sum"])

    def others(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pair, times, row in batches_of(batches):
            rest = ~shared.value.find(pair)[1]
            rows = batch.column("row").to_numpy()[row[rest]]
            columns = [rows, (pair[rest] >> 32).astype(np.int32), (pair[rest] & 0xFFFFFFFF).astype(np.int32), times[rest]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["row", "a", "b", "times"])

    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    fields = ", ".join(f"{c} {kinds[c]}" for c in names)
    done = documents.mapInArrow(frequent, f"{fields}, n_best long, count_sum long")
    if rare:
        rest = documents.select("row", "a", "b", "times").mapInArrow(others, "row long, a int, b int, times long")
        met = rest.join(pairs.where(power < least), ["a", "b"]).groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("count")).alias("_sum")
        )
        done = done.join(met, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)),
        })
    return done.select("key", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")


def align(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text", most: int = TABLE, **ranges: int) -> DataFrame:
    """:func:`aligned` and :func:`links` of all documents; a link is the pair of last tokens of a group."""
    return links(aligned(docs, byte_level, pieces, key, text, **ranges), most)
