"""Token ids packed into fixed-length rows by best fit decreasing.

Texts are encoded by the tiktoken library; its pattern engine gives up on very long runs of white space, so texts with such a
run take the transducer of :mod:`clientele.llm.bpe`, which gives the same ids.

Every task packs its documents in bounded sets: documents are read until ``tokens`` ids are waiting, then packed and
written. A document longer than a row is split into full rows and a rest; nothing is cut off. In a set, parts go from
longest to shortest into the open row with the least room that is enough; a segment tree over the room left finds it.

A packed row holds its ids (little-endian unsigned, padded), the cumulative lengths of its segments, the position ids that
restart at every segment, and for each segment the document, the part number and the first token.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.bpe import _arrow, codec, read_ranks

BLANKS = re.compile(r"\s{2000}")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Callable[[str | None], np.ndarray]:
    """Ids of a text as 32-bit integers; one encoder for each worker process."""
    import tiktoken

    library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})

    def encode(text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if BLANKS.search(text):
            return np.frombuffer(codec(path, pattern).encode(text), "<u4")
        return library.encode_to_numpy(text, disallowed_special=())

    return encode


class Rooms:
    """Open rows by room left. ``take(n)``: a row with the least room of at least ``n``, or None."""

    def __init__(self, most: int) -> None:
        self.base = 1 << (most + 1 - 1).bit_length()
        self.filled = [0] * (2 * self.base)  # open rows below each node
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.base
        while at:
            self.filled[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        filled, at = self.filled, least + self.base
        if not filled[at]:
            # Up to the first right neighbour that has rows, then down to its leftmost one.
            while at > 1 and (at & 1 or not filled[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at = 2 * at if filled[2 * at] else 2 * at + 1
        room = at - self.base
        row = self.rows[room].pop()
        while at:
            filled[at] -= 1
            at >>= 1
        return room, row


def best_fit(sizes: list[int], most: int) -> list[list[int]]:
    """Rows as lists of item numbers. Longer items go first, equal ones in their order; of equal rooms the latest."""
    rooms, rows = Rooms(most), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[i])
        if found is None:
            rows.append([i])
            room, row = most, len(rows) - 1
        else:
            room, row = found
            rows[row].append(i)
        if room > sizes[i]:
            rooms.put(room - sizes[i], row)
    return rows


PACKED = pa.schema([
    ("set_no", pa.int64()), ("row_no", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
    ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()), ("parts", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())),
])
FIELDS = "set_no long, row_no long, n_tokens long, ids binary, cu_seqlens array<int>, position_ids binary, parts array<int>, offsets array<long>"


def pack(docs: DataFrame, path: str, pattern: str, length: int = 2048, tokens: int = 2_000_000, end: int | None = None, pad: int = 0,
         dtype: str = "<u2", key: str = "doc_id", text: str = "text", matrices: bool = True) -> DataFrame:
    """Packed rows of all documents: ``set_no`` (number of the task and of the set in it), ``row_no`` in the set, ``n_tokens``,
    ``ids``, ``cu_seqlens``, ``position_ids``, and per segment ``keys``, ``parts`` and ``offsets``. Which documents share a set,
    and so the rows, follow from how ``docs`` is partitioned.

    ``end`` is put behind every document that has ids. Null and empty texts take no room and stand in no row. Repeated
    rows are packed each; null keys stay. No shuffle; a task holds at most ``tokens`` ids, one document and one batch of texts.
    ``matrices=False`` leaves ids and positions out (null), when only the layout is wanted.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = _arrow(docs)
    schema = pa.schema([*PACKED, ("keys", pa.list_(kind))])
    tail = np.array([] if end is None else [end], "<u4")

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        encode = encoder(path, pattern)
        task = TaskContext.get().partitionId()
        waiting, held, number = [], 0, 0
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(t.as_py())
                if not len(ids):
                    continue
                ids = np.concatenate([ids, tail]).astype(dtype)
                for part, at in enumerate(range(0, len(ids), length)):
                    waiting.append((k, part, at, ids[at : at + length]))
                held += len(ids)
                if held >= tokens:
                    yield _packed(waiting, task, number, length, pad, dtype, schema, matrices)
                    waiting, held, number = [], 0, number + 1
        if waiting:
            yield _packed(waiting, task, number, length, pad, dtype, schema, matrices)

    out = docs.mapInArrow(run, f"{FIELDS}, keys array<{docs.schema[0].dataType.simpleString()}>")
    return out


def _packed(waiting, task: int, number: int, length: int, pad: int, dtype: str, schema: pa.Schema, matrices: bool) -> pa.RecordBatch:
    columns: dict[str, list] = {f.name: [] for f in schema}
    for row_no, row in enumerate(best_fit([len(w[3]) for w in waiting], length)):
        parts = [waiting[i] for i in row]
        sizes = [len(p[3]) for p in parts]
        n = sum(sizes)
        if matrices:
            ids = np.full(length, pad, dtype)
            ids[:n] = np.concatenate([p[3] for p in parts])
            positions = np.zeros(length, "<u2" if length <= 65536 else "<u4")
            positions[:n] = np.concatenate([np.arange(s) for s in sizes])
        columns["set_no"].append((task << 32) + number)
        columns["row_no"].append(row_no)
        columns["n_tokens"].append(n)
        columns["ids"].append(ids.tobytes() if matrices else None)
        columns["cu_seqlens"].append([0, *np.cumsum(sizes).tolist()])
        columns["position_ids"].append(positions.tobytes() if matrices else None)
        columns["parts"].append([p[1] for p in parts])
        columns["offsets"].append([p[2] for p in parts])
        columns["keys"].append([p[0] for p in parts])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def write(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet files of binary matrices; a reader maps ``ids`` of a file to an array of rows x length."""
    packed.write.parquet(path)
