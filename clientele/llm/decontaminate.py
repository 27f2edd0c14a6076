"""Benchmark decontamination as a prefix-filtered containment join, without Python.

Every window of an item (``width`` consecutive words, or the whole item if it is shorter) is a set of shingles. A document
contains the window only if it contains the window's rarest shingle, so for containment a prefix of one shingle is
necessary and enough. Documents probe a table of these prefix shingles; offset and length of a window bound its place in
the document; the words of the place are then compared one by one.

The prefix table is broadcast in blocks of at most ``block_bytes`` (measured), one pass over the documents for each block,
so the broadcast doesn't grow with the items. Document text is never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import LOWER, UPPER, word_array
from clientele.session import checkpointed

MARK = 0  # the prefix hash of the row that every document gets


def _hash(words, at, size: int):
    return F.xxhash64(*(F.get(words, at + (i - 1)) for i in range(size)))


def windows(items: DataFrame, width: int, item: str, text: str) -> DataFrame:
    """``item``, ``window`` (array of words) and ``wid``, a 128-bit name of the window."""
    words = items.select(F.col(item).alias("item"), word_array(F.col(text)).alias("words")).withColumn("n", F.size("words"))
    size = F.least(F.col("n"), F.lit(width))
    return (
        words.where("n > 0")
        .select("item", F.col("words"), size.alias("size"), F.explode(F.sequence(F.lit(1), F.col("n") - size + 1)).alias("at"))
        .select("item", F.slice("words", F.col("at"), F.col("size")).alias("window"))
        .withColumn("wid", F.md5(F.concat_ws(" ", "window").cast("binary")))
    )


def prefixes(found: DataFrame, shingle: int) -> DataFrame:
    """For each window its rarest shingle: words in it, hash and offset. Rarity: places in all windows of all items."""
    one = found.select("wid", "window").groupBy("wid").agg(F.first("window").alias("window"))
    parts = []
    for size in range(1, shingle + 1):
        own = one.where(F.size("window") >= shingle if size == shingle else F.size("window") == size)
        parts.append(
            own.select("wid", "window", F.explode(F.sequence(F.lit(1), F.size("window") - size + 1)).alias("at"))
            .select("wid", "window", F.lit(size).alias("size"), F.col("at").alias("offset"), _hash(F.col("window"), F.col("at"), size).alias("hash"))
        )
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    counts = every.groupBy("size", "hash").agg(F.count("*").alias("places"))
    return (
        every.join(counts, ["size", "hash"])
        .groupBy("wid").agg(F.min(F.struct("places", "hash", "offset", "size", "window")).alias("best"))
        .select("wid", "best.size", "best.hash", "best.offset", "best.window")
    )


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, shingle: int = 3, block_bytes: int = 16 << 20,
                  key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    A document word is hit if it lies in an occurrence of a window of an item. Null and empty texts have no words; null or
    empty items have no windows; a null item name is left out of the names; repeated rows are reported each; null keys stay.
    Other columns are ignored.
    """
    found = _found(docs, items, width, shingle, block_bytes, key, text, item, item_text)
    return found.select(*(c for c in found.columns if c != "digest"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no word is hit."""
    bad = _found(docs, items, key=key, text=text, **options).where("contaminated").select(F.col(key).alias("_op8_key"), F.col("digest").alias("_op8_digest"))
    digest = F.xxhash64(F.lit(1), F.col(text))
    return docs.join(bad, docs[key].eqNullSafe(F.col("_op8_key")) & (digest == F.col("_op8_digest")), "left_anti")


def _found(docs: DataFrame, items: DataFrame, width: int = 10, shingle: int = 3, block_bytes: int = 16 << 20,
           key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    found = checkpointed(windows(items, width, item, item_text))
    names = found.select("wid", "item").distinct()
    table = checkpointed(prefixes(found, shingle))
    sizes = {
        r["size"]: r["bytes"]
        for r in table.groupBy("size").agg(F.sum(F.octet_length(F.concat_ws(" ", "window")) + 160).alias("bytes")).collect()
    } or {shingle: 0}  # a row for each shingle size at most
    passes = []
    for size, total in sorted(sizes.items()):
        blocks = max(1, math.ceil(total / block_bytes))
        for block in range(blocks):
            own = table.where((F.col("size") == size) & (F.pmod("hash", F.lit(blocks)) == block))
            passes.append(_pass(docs, own, size, key, text, first=not passes))
    places = passes[0]
    for p in passes[1:]:
        places = places.unionByName(p)
    row = ["key", "digest"]
    spans = places.groupBy(*row).agg(
        F.max("n_words").alias("n_words"), F.count(F.when(F.col("wid").isNull(), 1)).alias("rows"),
        F.collect_set(F.when(F.col("wid").isNotNull(), F.struct("start", "size"))).alias("spans"),
    )
    named = (
        places.where("wid is not null").select(*row, "wid").distinct().join(names, "wid")
        .groupBy(*row).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
        .select(F.col("key").alias("k"), F.col("digest").alias("d"), "items")
    )
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["size"] - 1).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - 1 - F.greatest(acc["end"], s["start"] - 1))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (
        spans.join(named, F.col("key").eqNullSafe(F.col("k")) & F.col("digest").eqNullSafe(F.col("d")), "left")
        .select(
            F.col("key").alias(key), "digest", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"),
            F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
        )
        .drop("copy").withColumn("contaminated", F.col("n_hit") > 0)
    )


def _pass(docs: DataFrame, table: DataFrame, size: int, key: str, text: str, first: bool) -> DataFrame:
    """Places of the windows of one block in all documents; in the first pass also one row for each document."""
    probes = table.select("wid", "hash", "offset", "window", F.size("window").alias("length"))
    if first:
        spark = docs.sparkSession
        mark = spark.range(1).select(
            F.lit(None).cast("string").alias("wid"), F.lit(MARK).cast("long").alias("hash"), F.lit(0).alias("offset"),
            F.array().cast("array<string>").alias("window"), F.lit(0).alias("length"),
        )
        probes = probes.unionByName(mark)
    rows = docs.select(
        F.col(key).alias("key"), F.xxhash64(F.lit(1), F.col(text)).alias("digest"), word_array(F.col(text)).alias("words"),
    )
    last = F.greatest(F.size("words") - (size - 1), F.lit(0))
    places = rows.select("key", "digest", "words", F.explode_outer(F.sequence(F.lit(0), last)).alias("at"))
    hashed = places.withColumn("hash", F.when(F.col("at") == 0, F.lit(MARK).cast("long")).otherwise(_hash(F.col("words"), F.col("at"), size)))
    start = F.col("at") - F.col("offset") + 1
    fits = (start >= 1) & (start + F.col("length") - 1 <= F.size("words"))
    same = F.when(F.col("length") == 0, F.col("at") == 0).otherwise(
        F.when(fits & (F.col("at") > 0), F.slice("words", start, F.col("length")) == F.col("window")).otherwise(False)
    )
    return hashed.join(F.broadcast(probes), "hash").where(same).select(
        "key", "digest", F.size("words").alias("n_words"), F.when(F.col("length") > 0, start).alias("start"),
        F.col("length").alias("size"), "wid",
    )


CONTAMINATION_SQL = f"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark
), i2 as (
  select item_id, words, least(len(words), 10) as size from i where len(words) > 0
), iw as (
  select distinct item_id, size, array_to_string(words[b:b + size - 1], ' ') as w
  from (select item_id, words, size, unnest(range(1, len(words) - size + 2)) as b from i2)
), dw as (
  select doc_id, size, b, array_to_string(words[b:b + size - 1], ' ') as w
  from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as b
        from d, (select distinct size from iw) where len(words) >= size)
), hit as (
  select doc_id, item_id, b, dw.size from dw join iw using (size, w)
), n as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(b, b + size)) as p from hit) group by 1
), named as (
  select doc_id, list_sort(list(distinct item_id::varchar)) as items from hit group by 1
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(n.n_hit, 0)::bigint as n_hit,
  coalesce(len(items), 0)::bigint as n_items, sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
  coalesce(n.n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join named using (doc_id)
"""
