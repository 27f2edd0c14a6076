"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Encoding. For every prefix of a piece, the BPE segmentation of that prefix ends in exactly one token: the only vocabulary
token that is a suffix of the prefix and whose pair with the last token before it survives merging. So a piece can be read
left to right. Only boundaries inside the longest suffix that still begins some token can be used by later tokens; a
state is that suffix together with the last token of each such boundary. Tokens on which all boundaries in reach agree are
final; they are emitted at the end of a piece or of a window of it, so the lookahead is bounded. States and transitions
are made when they are first met and kept in a bounded cache that is emptied when full.

Decoding. Tokens that are whole UTF-8 sequences are looked up; bytes of the others run through a UTF-8 state machine
that keeps an unfinished character between chunks.

Texts are cut into pieces by the tokenizer's pattern. A blank in front of a non-blank character always starts a match, so
texts are first cut there and the ids of such chunks are kept in a bounded cache.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import getitem
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES, PAIRS, CHUNKS = 150_000, 200_000, 300_000  # bounds of the caches
STREAM = 1 << 18  # bytes of ids that are decoded at a time, a multiple of 4
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, f))}


class State(dict):
    """A state and, by byte, the states that follow; those not met yet are made on demand.

    ``tail``: the longest suffix read that begins a token; ``lasts``: the last token at the boundary 0, 1, ... bytes back,
    as far as the tail goes; ``token`` and ``size``: the last token at this place and its length in bytes.
    """

    __slots__ = ("machine", "tail", "lasts", "token", "size")

    def __missing__(self, byte: int) -> State:
        after = self.machine.follow(self, byte)
        self[byte] = after
        return after


class Transducer:
    """Tokens of one piece, read byte by byte."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES) -> None:
        self.ranks, self.limit = ranks, states
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.starts = {t[:n] for t in ranks for n in range(len(t) + 1)}
        self.longest = max(map(len, ranks))
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.root = self.state(b"", (None,), None, 0)

    def state(self, tail: bytes, lasts: tuple, token: int | None, size: int) -> State:
        key = (tail, lasts)
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= self.limit:
                self.clear()
            found = self.states[key] = State()
            found.machine, found.tail, found.lasts, found.token, found.size = self, tail, lasts, token, size
        return found

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge, by the definition (lowest rank first), gives the token; None if it gives others."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[-1]) if len(parts) == 2 else (token, token)

    def parts_of(self, token: bytes) -> tuple[bytes, bytes] | None:
        if token not in self.parts:
            self.parts[token] = self.split(token)
        return self.parts[token]

    def fits(self, last: int | None, token: bytes) -> bool:
        """Whether ``token`` can follow ``last``, or the start of a piece."""
        if (self.parts[token] if token in self.parts else self.parts_of(token)) is None:
            return False
        if last is None:
            return True
        key = (last, self.ranks[token])
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            ok = self.pairs[key] = self.apart(self.bytes_of[last], token)
        return ok

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether merging leaves the border between two tokens alone.

        Takes the merges next to the border back, latest first. The parts at the border then would have merged with each
        other if that merge has a lower rank than the one just taken back; of equal ranks the one further left comes first.
        """
        ranks, below = self.ranks, NEVER
        while True:
            if ranks.get(left + right, NEVER) < below:
                return False
            a, b = ranks[left] if len(left) > 1 else -1, ranks[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                below, left = a, self.parts_of(left)[1]
            else:
                below, right = b + 1, self.parts_of(right)[0]

    def follow(self, state: State, byte: int) -> State:
        tail, ranks = state.tail + bytes((byte,)), self.ranks
        for size in range(len(tail), 0, -1):
            token = tail[-size:]
            if token in ranks and self.fits(state.lasts[size - 1], token):
                break
        else:
            raise ValueError(f"no token for the byte {byte}")
        while tail not in self.starts:
            tail = tail[1:]
        return self.state(tail, (ranks[token], *state.lasts)[: len(tail) + 1], ranks[token], size)

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of the piece. A piece of many tokens is emitted in windows, each after a bounded lookahead."""
        out: list[int] = []
        path = [self.root]
        window = 8 * self.longest
        if len(piece) > window:
            for at in range(0, len(piece) - window, window):
                path += list(accumulate(piece[at : at + window], getitem, initial=path[-1]))[1:]
                path = self._emit(path, out)
            piece = piece[at + window :]
        path[-1:] = accumulate(piece, getitem, initial=path[-1])
        end, back = len(path) - 1, []
        while end > 0:
            state = path[end]
            back.append(state.token)
            end -= state.size
        back.reverse()
        return out + back if out else back

    def _emit(self, path: list[State], out: list[int]) -> list[State]:
        """Emits the tokens that all boundaries in reach of later tokens share; returns the path behind them."""
        end = len(path) - 1
        live = set(range(max(0, end - len(path[end].tail)), end + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(last - path[last].size)
        end = shared = live.pop()
        back: list[int] = []
        while end > 0:
            back.append(path[end].token)
            end -= path[end].size
        out += back[::-1]
        return path[shared:]


class Utf8:
    """Incremental UTF-8 machine: text of complete characters, unfinished bytes kept for the next call.

    Bytes that can't belong to a character give U+FFFD, one for each maximal part of a character.
    """

    def __init__(self) -> None:
        self.kept = b""
        self.need = 0
        self.low, self.high = 0x80, 0xBF

    def feed(self, data: bytes, final: bool = False) -> str:
        out: list[str] = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.kept += bytes((b,))
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(self.kept.decode())
                        self.kept = b""
                    continue
                out.append("�")
                self.kept, self.need = b"", 0
            self.low, self.high = 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                self.need = 1 if b < 0xE0 else 2 if b < 0xF0 else 3
                self.kept = bytes((b,))
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
        if final and self.need:
            out.append("�")
            self.kept, self.need = b"", 0
        return "".join(out)


class Codec:
    """Texts to ids and back. ``pattern`` cuts texts into pieces; ``path`` is a file of ranks."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.transducer = Transducer(read_ranks(path))
        self.pieces = regex.compile(pattern).findall
        size = max(self.transducer.bytes_of) + 1
        self.token = [self.transducer.bytes_of.get(i) for i in range(size)]
        self.chars: list[str | None] = []
        for t in self.token:
            try:
                self.chars.append(None if t is None else t.decode())
            except UnicodeDecodeError:
                self.chars.append(None)
        self.whole = np.array([c is not None for c in self.chars])
        self.known: dict[str, bytes] = {}  # ids of a blank and the key
        self.bare: dict[str, bytes] = {}  # ids of the key
        self.marks = {m: self.chunk(m) for m in MARKS}

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern."""
        cache, key = (self.known, piece[1:]) if piece[0] == " " and len(piece) > 1 else (self.bare, piece)
        ids = cache.get(key)
        if ids is None:
            found = self.transducer.encode(piece.encode())
            ids = pack(f"<{len(found)}I", *found)
            self.keep(cache, key, ids)
        return ids

    def keep(self, cache: dict[str, bytes], key: str, ids: bytes) -> None:
        if len(key) <= 64:
            if len(cache) >= CHUNKS:
                cache.clear()
            cache[key] = ids

    def chunk(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pieces(text)))

    def spaced(self, part: str) -> bytes:
        """Ids of a blank and a text that starts with no white space."""
        if part.isalpha():  # one match of the pattern
            found = self.transducer.encode(b" " + part.encode())
            ids = pack(f"<{len(found)}I", *found)
        elif part[-1] in MARKS and part[:-1].isalpha():  # letters, then a mark of its own
            word = self.known.get(part[:-1])
            if word is None:
                return self.spaced(part[:-1]) + self.marks[part[-1]]
            ids = word + self.marks[part[-1]]
        else:
            return self.chunk(" " + part)
        self.keep(self.known, part, ids)
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null is an empty text."""
        if not text:
            return b""
        first, *rest = BLANK.split(text)
        get, spaced = self.known.get, self.spaced
        return self.chunk(first) + b"".join([get(part) or spaced(part) for part in rest])

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def stream(self, chunks: Iterable[bytes]) -> Iterator[str]:
        """Text of ids that come in chunks; the last piece ends the stream."""
        machine = Utf8()
        for chunk in chunks:
            ids = np.frombuffer(chunk, "<u4")
            at, out = 0, []
            for i in np.flatnonzero(~self.whole[ids]).tolist():
                if i > at:
                    out.append(self._plain(machine, ids[at:i]))
                out.append(machine.feed(self.token[ids[i]]))
                at = i + 1
            if at < len(ids):
                out.append(self._plain(machine, ids[at:]))
            yield "".join(out)
        yield machine.feed(b"", final=True)

    def _plain(self, machine: Utf8, ids: np.ndarray) -> str:
        return machine.feed(b"", final=True) + "".join(map(self.chars.__getitem__, ids.tolist()))

    def decode(self, ids: bytes) -> str:
        return "".join(self.stream([ids]))


MARKS = ",.;:!?"
BLANK = re.compile(r" (?=\S)")


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    made = Codec(path, pattern)
    gc.freeze()  # the tables stay; states form cycles only when their cache is emptied, so rare collections are enough
    gc.set_threshold(200_000, 20, 100)
    return made


def _over(batches, make, schema):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(make(batch), schema)], schema=schema)


def encode(docs: DataFrame, path: str, pattern: str, key: str | Column = "doc_id", text: str | Column = "text") -> DataFrame:
    """``key`` and ``ids`` (binary, little-endian unsigned 32-bit) of every text, without special tokens.

    Null and empty texts give empty ids; repeated rows give repeated rows; other columns are ignored. No shuffle.
    """
    docs = _two(docs, key, text)

    def run(batches):
        c = codec(path, pattern)
        schema = pa.schema([("key", batches_type), ("ids", pa.binary())])
        yield from _over(batches, lambda b: (b.column(0), [c.encode(t) for t in b.column(1).to_pylist()]), schema)

    batches_type = _arrow(docs)
    return docs.mapInArrow(run, f"key {docs.schema[0].dataType.simpleString()}, ids binary")


def decode(ids: DataFrame, path: str, pattern: str, key: str = "key") -> DataFrame:
    """``key`` and ``text`` of binary ``ids``; bytes that are no UTF-8 become U+FFFD. Null ids give an empty text."""
    ids = _two(ids, key, "ids")
    batches_type = _arrow(ids)

    def run(batches):
        c = codec(path, pattern)
        schema = pa.schema([("key", batches_type), ("text", pa.string())])
        yield from _over(batches, lambda b: (b.column(0), [c.decode(x or b"") for x in b.column(1).to_pylist()]), schema)

    return ids.mapInArrow(run, f"key {ids.schema[0].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str, pattern: str, key: str | Column = "doc_id", text: str | Column = "text") -> DataFrame:
    """Every text encoded and decoded again in one pass: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The ids are hashed as little-endian unsigned 32-bit integers. They are decoded in chunks by :meth:`Codec.stream`, that is by
    the UTF-8 state machine where a token is no whole sequence, and the bytes of its text are hashed. Null and empty texts have
    no tokens; repeated rows give repeated rows, null keys stay, other columns are ignored, an empty table gives an empty one.
    """
    docs = _two(docs, key, text)
    batches_type = _arrow(docs)

    def run(batches):
        c = codec(path, pattern)
        schema = pa.schema([("key", batches_type), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

        def make(batch):
            counts, ids_hex, text_hex = [], [], []
            for t in batch.column(1):
                ids = c.encode(t.as_py())
                counts.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                decoded = hashlib.sha256()
                for text in c.stream(ids[at : at + STREAM] for at in range(0, len(ids), STREAM)):
                    decoded.update(text.encode())
                text_hex.append(decoded.hexdigest())
            return batch.column(0), counts, ids_hex, text_hex

        yield from _over(batches, make, schema)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _two(df: DataFrame, key, text) -> DataFrame:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(as_col(key).alias("key"), as_col(text).alias("text"))


def _arrow(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[0].dataType)
