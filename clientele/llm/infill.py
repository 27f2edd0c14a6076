"""Fill-in-middle: texts cut at two drawn places and their three parts put in another order.

The places are numbers of units (code points, or the matches of a pattern); the text is cut in its UTF-8 bytes. A
boundary set holds the byte offset of every unit's start and the end of the text and answers "where do the first k units
end" by selection: offsets are kept by their upper 16 bits in containers, each in the smallest of three forms (a sorted
array, a bitmap with counts per word, or runs with counts before each), and cumulative cardinalities lead to the container.
Plain ASCII is one run a container, mixed scripts are arrays or bitmaps; no list of offsets of a text is ever made.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = rb"[^\n]*\n|[^\n]+"
SPAN = 1 << 16  # offsets of a container
WORDS = SPAN // 64


class Runs:
    """Offsets in runs: first offset of each run and how many offsets lie before it."""

    def __init__(self, starts: list[int], before: list[int], size: int) -> None:
        self.starts, self.before, self.size = starts, before, size

    def select(self, i: int) -> int:
        run = bisect_right(self.before, i) - 1
        return self.starts[run] + i - self.before[run]


class Array:
    def __init__(self, offsets: np.ndarray) -> None:
        self.offsets, self.size = offsets.astype(np.uint16), len(offsets)

    def select(self, i: int) -> int:
        return int(self.offsets[i])


class Bitmap:
    """A bit for each offset, and before each word of 64 bits the number of bits set so far."""

    def __init__(self, offsets: np.ndarray) -> None:
        bits = np.zeros(SPAN, np.uint8)
        bits[offsets] = 1
        self.packed = np.packbits(bits, bitorder="little").reshape(WORDS, 8)
        per_word = bits.reshape(WORDS, 64).sum(axis=1, dtype=np.int64)
        self.before = np.cumsum(per_word) - per_word
        self.size = len(offsets)

    def select(self, i: int) -> int:
        word = int(np.searchsorted(self.before, i, "right")) - 1
        bits = np.flatnonzero(np.unpackbits(self.packed[word], bitorder="little"))
        return 64 * word + int(bits[i - int(self.before[word])])


def container(offsets: np.ndarray) -> Runs | Array | Bitmap:
    """The smallest form of sorted offsets below ``SPAN``: runs take 4 bytes each, an array 2 an offset, a bitmap 8192."""
    firsts = np.flatnonzero(np.diff(offsets, prepend=-2) != 1)
    if 4 * len(firsts) <= min(2 * len(offsets), SPAN // 8):
        return Runs(offsets[firsts].tolist(), firsts.tolist(), len(offsets))
    return Array(offsets) if 2 * len(offsets) <= SPAN // 8 else Bitmap(offsets)


class Boundaries:
    """A sorted set of offsets that grows at its end, by containers."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.containers: list[Runs | Array | Bitmap] = []
        self.before: list[int] = []  # offsets in the containers before
        self.size = 0

    def _put(self, key: int, made: Runs | Array | Bitmap) -> None:
        if made.size:
            self.keys.append(key)
            self.containers.append(made)
            self.before.append(self.size)
            self.size += made.size

    def select(self, i: int) -> int:
        """The offset with ``i`` smaller ones in the set."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        at = bisect_right(self.before, i) - 1
        return (self.keys[at] << 16) + self.containers[at].select(i - self.before[at])

    @classmethod
    def of_code_points(cls, data: bytes) -> Boundaries:
        """First bytes of all code points of a UTF-8 text, and its end. Built in steps of one container."""
        made = cls()
        whole = data.isascii()
        for key in range(len(data) // SPAN + 1):
            part = data[key * SPAN : (key + 1) * SPAN]
            last = len(part) < SPAN  # the end of the text stands in this container, too
            if whole or part.isascii():
                size = len(part) + last
                made._put(key, Runs([0], [0], size))
            else:
                first = (np.frombuffer(part, np.uint8) & 0xC0) != 0x80
                offsets = np.flatnonzero(np.append(first, True) if last else first)
                made._put(key, container(offsets))
        return made

    @classmethod
    def of_units(cls, data: bytes, pattern: re.Pattern) -> Boundaries:
        """First bytes of the matches of a bytes pattern, which must cover the text, and the end of the text."""
        made, key, waiting, end = cls(), 0, [], 0
        for match in pattern.finditer(data):
            if match.start() != end or match.end() == end:
                raise ValueError(f"the unit pattern leaves byte {end} out")
            while match.start() >> 16 != key:
                made._put(key, container(np.array(waiting, np.int64)))
                key, waiting = key + 1, []
            waiting.append(match.start() & 0xFFFF)
            end = match.end()
        if end != len(data):
            raise ValueError(f"the unit pattern leaves byte {end} out")
        while end >> 16 != key:
            made._put(key, container(np.array(waiting, np.int64)))
            key, waiting = key + 1, []
        made._put(key, container(np.array([*waiting, end & 0xFFFF], np.int64)))
        return made


PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Recipe:
    """Marks of the parts, and shares in per cent: of texts that are rearranged, and of those with the suffix first.

    ``units``: a bytes pattern whose matches cover any text without a gap, such as :data:`LINES`; None stands for code points.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    rate: int = 90
    suffix_first: int = 20
    units: bytes | None = None

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        for a in marks:
            if not a or len(set(marks)) < 3:
                raise ValueError("the marks must be different and not empty")
            for b in marks:
                if any(a.endswith(b[:n]) for n in range(1, len(b))) or (a != b and b in a):
                    raise ValueError("no mark may overlap another: a text could not be taken apart again")


def _rearranged(data: bytes, draws: tuple[int, int, int, int], recipe: Recipe, marks: tuple[bytes, bytes, bytes], units):
    """Form, number of units, units of prefix and middle, and the parts of the output."""
    made = Boundaries.of_code_points(data) if units is None else Boundaries.of_units(data, units)
    n = made.size - 1
    h1, h2, h3, h4 = draws
    if not data or h3 % 100 >= recipe.rate or any(m in data for m in marks):
        return PLAIN, n, None, None, data
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut, end = made.select(low), made.select(high)
    p, s, m = marks
    prefix, middle, suffix = data[:cut], data[cut:end], data[end:]
    if h4 % 100 < recipe.suffix_first:
        return SPM, n, low, high - low, b"".join((s, suffix, p, prefix, m, middle))
    return PSM, n, low, high - low, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, recipe: Recipe = Recipe(), seed: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n`` (units of the text), ``form`` (plain, psm or spm), ``prefix_units``, ``middle_units`` and ``output``.

    The four draws of a text are the first groups of 8 hex digits of the SHA-256 of ``seed``, a colon and the key; so the
    result of a row depends on nothing but the row, at any partitioning. Null texts are empty ones; empty texts, and texts
    that hold a mark, stay plain. A null key draws like an empty one. Repeated rows give repeated rows; other columns,
    whatever their names, are ignored; an empty table gives an empty one. No shuffle; a task holds one batch of texts.
    """
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    docs = docs.select(F.col(key).alias("key"), hashed.alias("draws"), F.col(text).alias("text"))
    marks = tuple(m.encode() for m in (recipe.prefix, recipe.suffix, recipe.middle))
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([
        ("key", to_arrow_type(docs.schema[0].dataType)), ("n", pa.int64()), ("form", pa.string()), ("prefix_units", pa.int64()),
        ("middle_units", pa.int64()), ("output", pa.string()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = re.compile(recipe.units) if recipe.units is not None else None
        for batch in batches:
            for start, rows in _by_bytes(batch.column(2)):
                got = []
                for i, data in enumerate(rows, start):
                    digest = batch.column(1)[i].as_py()
                    draws = tuple(int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))
                    got.append(_rearranged(data, draws, recipe, marks, units))
                form, n, first, second, out = zip(*got)
                columns = [batch.column(0).slice(start, len(got)), n, form, first, second]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.binary()).cast(pa.string())], schema=schema)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n long, form string, prefix_units long, middle_units long, output string")


def _by_bytes(texts: pa.Array, most: int = 16 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts of groups of rows of about ``most`` bytes, so that long texts don't wait for each other."""
    rows, size, start = [], 0, 0
    for i, t in enumerate(texts):
        rows.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
        size += len(rows[-1])
        if size >= most:
            yield start, rows
            rows, size, start = [], 0, i + 1
    if rows:
        yield start, rows


def restore(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The text that an output was made of: between its marks, each of which stands once in a rearranged text."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in (recipe.prefix, recipe.suffix, recipe.middle)), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
