"""Token counts through a two-tier lookup, without a shuffle of pre-tokens.

The number of tokens of a text is the sum over its pre-tokens. The lengths of the frequent ones are broadcast as a compact
hash table; a pre-token that isn't in it goes to the cache of the worker process and, if it is new there, to the tokenizer.
Which pre-tokens are frequent is found over all texts by mergeable sketches, one for each task, combined in a tree: only
sketches of bounded size move. The table decides about speed alone; any table gives the same counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import BLANK, slices

FREQUENT, TRACKED = 16_384, 65_536  # entries of the table; items that a sketch keeps
CACHED, LONGEST = 400_000, 64  # bounds of the worker's cache: entries, characters of an entry
SLICE = 1 << 20  # characters of a text that are cut into pre-tokens at a time
FAN_IN = 256


class ByteLevel:
    """A file of the tokenizers library. Strings of added tokens inside a text count as one token, as is its default."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        added = [t["content"] for t in rules["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in rules["added_tokens"]):
            raise ValueError("added tokens that take in white space, ask for word borders or are normalised")
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # pre-tokens hold none any more
        before = rules["pre_tokenizer"] or {}
        self.plain = rules["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.cut = regex.compile(pattern).findall

    def pieces(self, text: str) -> Iterator[list[str]]:
        for part in self.added.split(text) if self.added else [text]:
            for some in slices(part, SLICE):
                if self.plain:
                    yield self.cut(some)
                else:
                    clean = self.tokenizer.normalizer.normalize_str(some) if self.tokenizer.normalizer else some
                    yield [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(clean)]

    def length(self, piece: str) -> int:
        if self.plain:
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return len(self.tokenizer.model.tokenize(piece))

    def extra(self, text: str) -> int:
        """Added tokens inside the text."""
        return sum(1 for _ in self.added.finditer(text)) if self.added else 0


class Pieces:
    """A sentencepiece model. Its pre-tokens are the parts between single blanks, if no piece of it goes across one."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        vocabulary = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        inner = any("▁" in p.lstrip("▁") for p in vocabulary)
        self.splits = not inner and self.model.encode("a b") == self.model.encode("a") + self.model.encode("b")

    def pieces(self, text: str) -> Iterator[list[str]]:
        if not text:
            return
        if not self.splits:
            yield [text]
            return
        for i, some in enumerate(slices(text, SLICE)):
            yield BLANK.split(some[1:] if i else some)

    def length(self, piece: str) -> int:
        return len(self.model.encode(piece, num_threads=1))

    def extra(self, text: str) -> int:
        return 0


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteLevel | Pieces:
    return Pieces(path) if path.endswith(".model") else ByteLevel(path, pattern)


class Lengths(dict):
    """Number of tokens by pre-token: the entries of the table, all others through the worker's cache."""

    def __init__(self, table: dict[str, int], rule: ByteLevel | Pieces, cache: dict[str, int], most: int = CACHED) -> None:
        super().__init__(table)
        self.rule, self.cache, self.most = rule, cache, most

    def __missing__(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            n = self.rule.length(piece)
            if len(piece) <= LONGEST:
                if len(self.cache) >= self.most:
                    self.cache.clear()
                self.cache[piece] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return self.rule.extra(text) + sum(sum(map(self.__getitem__, some)) for some in self.rule.pieces(text))


@dataclass(frozen=True)
class Frequent:
    """Pre-tokens and their lengths for a broadcast: the texts in one block, their ends in it, and the counts."""

    texts: bytes
    ends: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, lengths: dict[str, int]) -> Frequent:
        keys = [k.encode() for k in lengths]
        return cls(b"".join(keys), np.cumsum([len(k) for k in keys], dtype=np.uint32), np.array([*lengths.values()], np.uint16))

    def table(self) -> dict[str, int]:
        starts = [0, *self.ends[:-1].tolist()]
        return {self.texts[a:b].decode(): n for a, b, n in zip(starts, self.ends.tolist(), self.lengths.tolist())}


def frequent_items(docs: DataFrame, text: str, pattern: str, most: int = FREQUENT, tracked: int = TRACKED) -> list[str]:
    """About the ``most`` most frequent matches of a pattern over all texts; at most that many.

    Every task keeps one sketch of its texts; sketches are combined in two levels, so no task meets more than the
    sketches of a part of the tasks. Texts are looked at in slices of 65,536 characters, all of them: a match that lies
    across such a border is counted in two parts, which only a cache can see.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length("_t"), F.lit(1)), F.lit(65_536))
    some = docs.select(F.col(text).alias("_t")).where("_t is not null").select("_t", F.explode(starts).alias("_at"))
    pieces = F.regexp_extract_all(F.substring(F.col("_t"), F.col("_at"), F.lit(65_536)), F.lit("(?U)" + pattern), F.lit(0))
    items = some.select(F.explode(pieces).alias("item")).where(F.length("item").between(1, LONGEST))
    sketches = items.groupBy(F.spark_partition_id().alias("task")).agg(F.expr(f"approx_top_k_accumulate(item, {tracked}) as sketch"))
    level = sketches.groupBy((F.col("task") % FAN_IN).alias("task")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked}) as sketch"))
    top = level.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked}) as sketch"))  # no texts: no row
    return [r.item for r in top.select(F.expr(f"inline(approx_top_k_estimate(sketch, {most}))")).select("item").collect()]


def frequent(items: Iterable[str], path: str, pattern: str) -> Frequent:
    """The table of all pre-tokens that the tokenizer finds in the items."""
    rule, made = tokenizer(path, pattern), {}
    for item in items:
        for some in rule.pieces(item):
            for piece in some:
                if piece not in made and len(piece) <= LONGEST:
                    made[piece] = rule.length(piece)
    return Frequent.of(made)


_CACHES: dict[str, dict[str, int]] = {}  # by tokenizer, in each worker process


def count_tokens(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", table: Frequent | None = None) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every text, without begin, end or padding tokens.

    ``path``: a ``.json`` file of the tokenizers library or a ``.model`` of sentencepiece; ``pattern``: how pre-tokens are
    told apart (for a ``.json`` whose pre-tokenizer is the plain byte-level one it must be that one's pattern). Without
    ``table`` the frequent pre-tokens are found first, by one job over all texts; the table holds a few hundred KB at any
    input size.

    Null and empty texts have no bytes and no tokens. Repeated rows give repeated rows; null keys stay; other columns,
    whatever their names, are ignored; an empty table gives an empty one. A very long text is cut into pre-tokens in slices.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    shared = spark.sparkContext.broadcast(table or frequent(frequent_items(docs, "text", pattern), path, pattern))
    schema = pa.schema([("key", to_arrow_type(docs.schema[0].dataType)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(shared.value.table(), tokenizer(path, pattern), _CACHES.setdefault(path, {}))
        for batch in batches:
            texts = batch.column(1)
            size = pc.fill_null(pc.binary_length(texts).cast(pa.int64()), 0)
            counts = pa.array([lengths.count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, counts], schema=schema)

    return docs.mapInArrow(run, f"key {docs.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long")
