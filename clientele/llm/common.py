"""Registry of the queries of this subpackage and the text rules that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``; ``sql`` is its check, if SQL can express it."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder. Unlike a checkpoint, what is read back knows nothing of the plan
    that made it, so plans and driver memory don't grow in loops."""
    place = scratch(df.sparkSession, "stored")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


#: A blank between characters that are neither white space nor the sign that subword pieces have for a blank: byte-level
#: patterns and blank-led pieces start a token here.
BLANK = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def slices(text: str, size: int) -> Iterator[str]:
    """The text in parts of at least ``size`` characters, each but the first beginning with the blank it was cut at. A text
    without such a blank stays in one part."""
    at = 0
    while len(text) - at > size:
        cut = BLANK.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word: a run of ASCII digits, ASCII lower-case letters and any non-ASCII characters of the lowered text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The same rule over UTF-8 bytes: A-Z are lowered, every other ASCII byte that is no letter or digit becomes a blank.
BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, in order; none for a null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(BYTES).split()


def ascii_lower(text: Column) -> Column:
    """``text`` with only A-Z lowered. Pure ASCII takes the fast built-in, other text the character map."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """The words of a text as an array without Python; null text gives an empty array."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD)
    # Only the first and the last part can be empty: the text starts or ends with a separator.
    first = F.when(F.element_at(parts, 1) == "", 2).otherwise(1)
    last = F.when(F.element_at(parts, -1) == "", F.size(parts) - 1).otherwise(F.size(parts))
    return F.slice(parts, first, F.greatest(last - first + 1, F.lit(0)))
