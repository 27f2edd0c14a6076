"""Near-duplicate documents by order MinHash and banded alignment.

A document is the sequence of its k-mers (``k`` consecutive words). Equal k-mers are told apart by their occurrence number.
Each of ``sketches`` hash functions takes the ``several`` smallest labelled k-mers and hashes them in the order in which they
stand in the text: two documents agree in a sketch only if they share these k-mers and their order, which follows the edit
similarity better than plain MinHash.

Documents that agree in a sketch are candidates. In the first rounds all documents of a bucket are paired with one hub
only, which links most copies at a linear price. Then every pair that shares a bucket and is not linked yet is compared, in
blocks of bounded size: a product of incidence matrices gives the number of common k-mers of all pairs of two blocks, and only
pairs with enough of them are aligned. No pair of a bucket is left out, whatever else is in it. Candidates are verified by
aligning their k-mer sequences inside the band that the threshold allows: with M aligned k-mers,
similarity = M / (n_a + n_b - M).

Documents with the same words are one node from the start. Classes are the connected components of verified links; after
each round the ends of its links are replaced by the roots found before, so that no link is handled twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from functools import lru_cache
from math import floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.bpe import _arrow
from clientele.llm.common import stored, words_of
from clientele.session import scratch

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Hashed(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = Hashed()


def kmers(words: list[bytes], k: int) -> np.ndarray:
    """Hashes of the k-mers in order; a shorter text is one k-mer of all its words."""
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(k, len(w))
    if not k:
        return np.empty(0, np.uint64)
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out ^ w[i : len(w) - k + 1 + i])
    return out


def labels(grams: np.ndarray) -> np.ndarray:
    """The k-mers told apart by their occurrence number."""
    n = len(grams)
    order = np.argsort(grams, kind="stable")
    sorted_ = grams[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    number = np.empty(n, np.uint64)
    number[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return mix(grams + number * _MIX[1])


def sketch(grams: np.ndarray, sketches: int, several: int) -> list[int]:
    """One number for each sketch; none for a text without words."""
    n = len(grams)
    if not n:
        return []
    labelled = labels(grams)
    take = min(several, n)
    seeds = (np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))[:, None]
    if n <= 1 << 14:
        where = _smallest(mix(labelled[None, :] ^ seeds), take)
    else:  # long texts one sketch at a time
        where = np.concatenate([_smallest(mix(labelled[None, :] ^ seeds[s : s + 1]), take) for s in range(sketches)])
    key = np.arange(sketches, dtype=np.uint64)
    for i in range(take):
        key = mix(key ^ grams[where[:, i]])
    return key.astype(np.int64).tolist()


def _smallest(h: np.ndarray, take: int) -> np.ndarray:
    """Places of the ``take`` smallest numbers of each row, in the order of the text."""
    where = np.argpartition(h, take - 1, axis=1)[:, :take] if take < h.shape[1] else np.tile(np.arange(take), (len(h), 1))
    return np.sort(where, axis=1)


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence, from matches at most ``band`` off the diagonal; one bit for each place of b."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    full = (1 << len(b)) - 1
    v = full
    for i, x in enumerate(a):
        m = 0
        for j in places.get(x, ()):
            if -band <= j - i <= band:
                m |= 1 << j
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Alignment similarity of two k-mer sequences; below ``least`` only known to be below. No k-mers: 0."""
    total = len(a) + len(b)
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    same = a[len(a) - (n - head) :][::-1] == b[len(b) - (n - head) :][::-1]
    tail = n - head if same.all() else int(same.argmin())
    band = floor(total * (1 - least) / (1 + least))
    inner = aligned(a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist(), band)
    m = head + tail + inner
    return m / (total - m)


def nodes(docs: DataFrame, k: int = 5, sketches: int = 16, several: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``digest`` of the words, number of k-mers ``n`` and sketch ``keys`` of every row. No shuffle."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = pa.schema([("id", _arrow(docs)), ("digest", pa.binary()), ("n", pa.int32()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            digest, n, keys = [], [], []
            for t in batch.column(1):
                words = words_of(t.as_py())
                grams = kmers(words, k)
                # A text without words is told apart by all its characters.
                same = b" ".join(words) or (t.as_py() or "").encode("utf-8", "surrogatepass")
                digest.append(hashlib.blake2b(same, digest_size=16, person=b"words" if words else b"text").digest())
                n.append(len(grams))
                keys.append(sketch(grams, sketches, several))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip((digest, n, keys), list(schema)[1:]))], schema=schema)

    return docs.mapInArrow(run, f"id {docs.schema[0].dataType.simpleString()}, digest binary, n int, keys array<long>")


def verified(pairs: DataFrame, docs: DataFrame, k: int, least: float, small: int = 20_000) -> DataFrame:
    """Of the pairs (``a``, ``b``) those whose texts are similar. ``docs``: ``id``, ``text``.

    The texts of all documents are shuffled once and serve both sides. Few pairs (at most ``small``, counted) are broadcast
    instead, so that only their texts are shuffled; the first round, whose pairs grow with the documents, doesn't use that.
    """
    if pairs.count() <= small:
        left = docs.join(F.broadcast(pairs), F.col("id") == F.col("a")).select("a", "b", F.col("text").alias("text_a"))
        right = docs.join(F.broadcast(pairs.select("b").distinct()), F.col("id") == F.col("b")).select(F.col("b").alias("id"), "text")
        right = right.dropDuplicates(["id"])
    else:
        left = docs.join(pairs, F.col("id") == F.col("a")).select("a", "b", F.col("text").alias("text_a"))
        right = docs
    both = left.join(right, F.col("b") == F.col("id")).select("a", "b", "text_a", F.col("text").alias("text_b"))

    def run(batches):
        @lru_cache(maxsize=64)
        def grams(text):
            return kmers(words_of(text), k)

        for batch in batches:
            ok = [similarity(grams(x.as_py()), grams(y.as_py()), least) >= least for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], schema=pa.schema(list(batch.schema)[:2])).filter(pa.array(ok, pa.bool_()))

    kind = both.schema[0].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def wanted(unit: dict, least: float) -> np.ndarray:
    """Pairs of rows (left, right) of a unit that are to be compared: of different roots, of lengths that can be similar, and
    met in no earlier sketch, so that a pair is compared once however many buckets it shares."""
    left, right = np.flatnonzero(unit["side"] != 2), np.flatnonzero(unit["side"] != 1)
    n, (_, root), keys = unit["n"], np.unique(unit["root"], return_inverse=True), unit["keys"]
    ok = root[left][:, None] != root[right][None]
    ok &= np.minimum(n[left][:, None], n[right][None]) >= least * np.maximum(n[left][:, None], n[right][None])
    ok &= (unit["side"][left][:, None] != 0) | (left[:, None] < right[None])
    i, j = np.nonzero(ok)
    i, j = left[i], right[j]
    same = keys[i] == keys[j]
    mine = keys[i, same.argmax(1)] == unit["bucket"][i] if len(i) else np.zeros(0, bool)
    return np.stack([i[mine], j[mine]], 1)


def common(left: list[np.ndarray], right: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Number of equal labelled k-mers of each of ``left`` and each of ``right``, from ``width`` k-mers at a time."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float64)

    def places(rows):
        at = [np.searchsorted(both, r) for r in rows]
        at = [a[(a < len(both)) & (both[np.minimum(a, len(both) - 1)] == r)] for a, r in zip(at, rows)] if len(both) else at
        return np.repeat(np.arange(len(rows)), [len(a) for a in at]), np.concatenate(at)

    if len(both):
        (li, lc), (ri, rc) = places(left), places(right)
        for start in range(0, len(both), width):
            size = min(width, len(both) - start)
            x, y = np.zeros((len(left), size), np.float32), np.zeros((len(right), size), np.float32)
            for m, rows, cols in ((x, li, lc), (y, ri, rc)):
                now = (cols >= start) & (cols < start + size)
                m[rows[now], cols[now] - start] = 1
            out += x @ y.T
    return out


def _units(batches):
    """Rows of one unit after the other, from batches sorted by unit, as arrays by column."""
    rest = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        unit = now.column("unit").to_numpy()
        ends = np.flatnonzero(unit[1:] != unit[:-1]) + 1
        at = [0, *ends.tolist()]
        for a, b in zip(at, at[1:]):
            yield _columns(now.slice(a, b - a))
        rest = now.slice(at[-1])
    if rest is not None and len(rest):
        yield _columns(rest)


def _columns(t: pa.Table) -> dict:
    out = {c: t.column(c).to_numpy() for c in ("unit", "side", "bucket", "n", "id", "root")}
    keys = t.column("keys").combine_chunks()
    return out | {"keys": keys.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1), "table": t}


def forest(pairs: Iterable[tuple[int, int]], similar: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Of the similar pairs enough to link the same rows: a pair that earlier ones link already is not looked at."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b and similar(i, j):
            parent[a] = b
            out.append((i, j))
    return out


def compared(entries: DataFrame, docs: DataFrame, k: int, least: float, block: int = 512, volume: int = 400_000) -> DataFrame:
    """Of all pairs of different roots in a bucket similar ones that link the same documents as all of them: a forest of each
    unit. ``entries``: ``id``, ``n``, ``bucket``,
    ``root``, ``keys``; ``docs``: ``id``, ``text``.

    The rows of a bucket are cut into classes of length, so that similar texts are in the same or in neighbouring classes,
    and classes into parts of about ``block`` rows or ``volume`` k-mers, whichever is less. Two parts are a unit, which a task can
    hold; a row goes to as many units as its class and the next have parts, so larger parts mean fewer copies of it. Texts go only to units with pairs to compare.
    """
    wide = max(1e-6, -log(max(least, 1e-9)) * 1.001)
    entries = entries.withColumn("size", F.floor(F.log("n") / wide).cast("int"))
    cells = entries.groupBy("bucket", "size").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / volume)).cast("int").alias("parts"))
    cells = cells.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("size", "parts"))).alias("cells"))
    rows = entries.join(cells, "bucket")
    parts = lambda d: F.coalesce(F.try_element_at("cells", F.col("size") + d), F.lit(0))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), parts(0)).cast("int"))

    def unit(low, high, i, j, side):
        return F.struct(F.xxhash64("bucket", low, high, i, j).alias("unit"), side.cast("int").alias("side"))

    def each(n, make):
        return F.transform(F.filter(F.sequence(F.lit(0), n), lambda j: j < n), make)

    p, c = F.col("part"), F.col("size")
    units = F.concat(
        each(parts(0), lambda j: unit(c, c, F.least(p, j), F.greatest(p, j), F.when(p == j, 0).when(p < j, 1).otherwise(2))),
        each(parts(1), lambda j: unit(c, c + 1, p, j, F.lit(1))),
        each(parts(-1), lambda j: unit(c - 1, c, j, p, F.lit(2))),
    )
    rows = rows.select(F.explode(units).alias("u"), "bucket", "id", "root", "n", "keys").select("u.unit", "u.side", "bucket", "id", "root", "n", "keys")

    def look(batches):
        for u in _units(batches):
            used = np.unique(wanted(u, least))
            if len(used):
                yield from u["table"].take(pa.array(used)).combine_chunks().to_batches()

    def compare(batches):
        for u in _units(batches):
            pairs = wanted(u, least)
            if not len(pairs):
                continue
            grams = [kmers(words_of(t), k) for t in u["table"].column("text").to_pylist()]
            marks = [labels(g) for g in grams]
            left, right = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
            equal = common([marks[i] for i in left], [marks[j] for j in right])
            m = equal[np.searchsorted(left, pairs[:, 0]), np.searchsorted(right, pairs[:, 1])]
            # No alignment is longer than the number of common k-mers.
            enough = m >= least * (u["n"][pairs[:, 0]] + u["n"][pairs[:, 1]] - m) - 1e-6
            found = forest(pairs[enough].tolist(), lambda i, j: similarity(grams[i], grams[j], least) >= least)
            if found:
                ids = u["table"].column("id")
                a, b = (ids.take(pa.array([f[s] for f in found])).combine_chunks() for s in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    rows = rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(look, rows.schema)
    rows = stored(rows).join(docs, "id")
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, f"a {kind}, b {kind}")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root`` (the smallest id) of everything linked; labels travel along links and jump over their own labels."""
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "id")
    roots = stored(roots)
    while True:
        near = edges.join(roots.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        jump = roots.select(F.col("id").alias("j"), F.col("root").alias("jumped"))
        moved = (
            roots.join(near, F.col("id") == F.col("a")).join(jump, F.least("root", "near") == F.col("j"))
            .select("id", F.least("root", "near", "jumped").alias("root"), (F.least("root", "near", "jumped") < F.col("root")).alias("moved"))
        )
        moved = stored(moved)
        if moved.where("moved").isEmpty():
            return moved.select("id", "root")
        roots = moved.select("id", "root")


def contracted(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The links between the roots of their ends, each once, without those inside a class."""
    if roots is not None:
        for end in ("a", "b"):
            found = roots.select(F.col("id").alias(end), F.col("root").alias("_r"))
            links = links.join(found, end, "left").withColumn(end, F.coalesce("_r", end)).drop("_r")
    links = links.where(F.col("a") != F.col("b"))
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def joined(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """``roots`` after the classes of their roots, and of ids that had none, were joined as ``found`` says."""
    if roots is None:
        return found
    moved = found.select(F.col("id").alias("_o"), F.col("root").alias("_r"))
    old = roots.join(moved, F.col("root") == F.col("_o"), "left").select("id", F.coalesce("_r", "root").alias("root"))
    return stored(old.unionByName(found.join(roots.select("id"), "id", "left_anti").select("id", "root")))


def classes(docs: DataFrame, k: int = 5, least: float = 0.8, sketches: int = 16, several: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``key`` and ``class_id``, the smallest key of its class.

    Texts without words are copies only if they are the same, null and empty ones being the same text. An id names one text: repeated rows get the same class. A null
    id gets a null class and joins no class. Other columns are ignored. Empty tables give none.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    place = scratch(spark, "sketches")
    nodes(own, k, sketches, several, "id").write.parquet(place)
    rows = spark.read.parquet(place)
    place = scratch(spark, "nodes")
    # The smallest id of equal texts stands for them.
    rows.where("id is not null").groupBy("digest").agg(F.min(F.struct("id", "n", "keys")).alias("m"), F.countDistinct("id").alias("ids")).select(
        "digest", "m.id", "m.n", "m.keys"
    ).write.parquet(place)
    reps = spark.read.parquet(place)
    entries = reps.where("n > 0").select("id", "n", F.explode("keys").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    entries = stored(entries.join(shared, "bucket"))
    texts = own.where("id is not null")
    tried = roots = None
    rounds = 0
    while True:
        now = entries.withColumn("root", F.col("id"))
        if roots is not None:
            now = entries.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
            # A bucket whose documents are all linked stays so: only the others go on.
            mixed = now.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("bucket")
            now = stored(now.join(mixed, "bucket"))
            entries = now.select("id", "n", "bucket")
        if rounds == 2:
            break
        order = F.struct((F.col("id") if rounds == 0 else F.xxhash64("id", F.lit(rounds))).alias("turn"), "id", "n", "root")
        hubs = now.groupBy("bucket").agg(F.min(order).alias("hub")).select("bucket", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.root").alias("hub_root"))
        pairs = now.join(hubs, "bucket").where(
            (F.col("root") != F.col("hub_root")) & (F.least("n", "hub_n") >= F.lit(least) * F.greatest("n", "hub_n"))
        ).select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()
        if rounds == 0:
            pairs = pairs.groupBy("a").agg(F.min("b").alias("b"))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        new = stored(verified(pairs, texts, k, least, 20_000 if rounds else 0))
        tried = pairs if tried is None else tried.unionByName(pairs)
        if not new.isEmpty():
            roots = joined(roots, components(contracted(new, roots)))
        rounds += 1
    # The second round has compared the documents of a bucket of two; in all others every pair of different roots is compared.
    many = now.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 2").select("bucket")
    left = now.join(many, "bucket").join(reps.select("id", "keys"), "id")
    new = stored(compared(stored(left), texts, k, least))
    if not new.isEmpty():
        roots = joined(roots, components(contracted(new, roots)))
    result = rows.select("id", "digest").join(reps.select("digest", F.col("id").alias("rep")), "digest", "left")
    if roots is not None:
        result = result.join(roots.withColumnRenamed("id", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    else:
        result = result.withColumn("root", F.col("rep"))
    return result.select(F.col("id").alias(key), F.when(F.col("id").isNotNull(), F.col("root")).alias("class_id"))


def keep_first(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """All columns of the rows of ``docs`` that stand for their class; of rows that share this id, one. Null ids stay."""
    found = stored(classes(docs, key=key, **options))
    counted = found.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("class_id").alias("class_id"), F.count("*").alias("n"))
    counted = counted.select(F.col(key).alias("_op4_id"), (F.col("class_id") != F.col(key)).alias("_op4_copy"), F.col("n").alias("_op4_n"))
    gone = counted.where("_op4_copy or _op4_n > 1").select("_op4_id")
    left = docs.join(gone, docs[key] == F.col("_op4_id"), "left_anti")
    again = counted.where("not _op4_copy and _op4_n > 1").select("_op4_id")
    if again.isEmpty():
        return left
    return left.unionByName(docs.join(again, docs[key] == F.col("_op4_id"), "left_semi").dropDuplicates([key]))
