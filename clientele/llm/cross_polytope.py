"""Approximate nearest neighbours by cross-polytope hashing.

A hash turns a unit vector by a pseudo-rotation (three rounds of random signs and a fast Hadamard transform, dimensions
padded with zeros to a power of two) and names the nearest of the signed axes. A table joins ``functions`` hashes into one
bucket number. Every row is put into its bucket of each table; a query looks into the ``probes`` buckets it fits best. The
rows of a bucket are compared with its queries exactly, in blocks of at most ``block`` rows, and only each block's best
``k`` leave it, so neither a hot bucket nor a hot vector makes a large group or many pairs.

Equal vectors are searched once, with their ``k + 1`` smallest ids; queries that found fewer than ``k`` rows are compared
with all rows, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.session import checkpointed


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised fast Hadamard transform of every row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(-1, n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(-1, n)
        h *= 2
    return x / math.sqrt(n)


class Hashes:
    def __init__(self, width: int, tables: int, functions: int, seed: int) -> None:
        self.size = 1 << max(1, (width - 1).bit_length())
        self.tables, self.functions = tables, functions
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, functions, 3, self.size))

    def turned(self, x: np.ndarray, table: int, function: int) -> np.ndarray:
        """Nearness to each signed axis: the turned coordinates, then their negatives."""
        y = np.zeros((len(x), self.size))
        y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
        for signs in self.signs[table, function]:
            y = hadamard(y * signs)
        return np.concatenate([y, -y], 1)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table."""
        out = np.zeros((len(x), self.tables), np.int64)
        for t in range(self.tables):
            for f in range(self.functions):
                out[:, t] = out[:, t] * 2 * self.size + self.turned(x, t, f).argmax(1)
        return out

    def probes(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """For each row its ``probes`` buckets of smallest loss, the own bucket first."""
        near = [self.turned(x, table, f) for f in range(self.functions)]
        best = [np.argsort(-s, axis=1, kind="stable")[:, :probes] for s in near]
        if self.functions == 1:
            return best[0]
        out = np.empty((len(x), min(probes, (2 * self.size) ** self.functions)), np.int64)
        for at in range(0, len(x), 64):
            number, loss = np.zeros((len(x[at : at + 64]), 1), np.int64), 0.0
            # The best sums over some hashes come from the best sums over all but the last of them.
            for s, b in zip(near, best):
                s, b = s[at : at + 64], b[at : at + 64]
                own = np.take_along_axis(s, b, 1)
                loss = (loss + np.zeros(number.shape))[:, :, None] + ((own[:, :1] - own) ** 2)[:, None]
                number = number[:, :, None] * 2 * self.size + b[:, None]
                loss, number = loss.reshape(len(s), -1), number.reshape(len(s), -1)
                first = np.argsort(loss, axis=1, kind="stable")[:, :probes]
                loss, number = np.take_along_axis(loss, first, 1), np.take_along_axis(number, first, 1)
            out[at : at + 64] = number
        return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vec`` of the rows that take part: no null, no null or non-finite component, not zero, one per id."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(key).alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("vec"))
        .where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
        .withColumn("vec", F.transform(v, lambda x: x + F.lit(0.0)))
    )


def functions_for(rows: int, width: int, bucket: int) -> int:
    """Hashes to join so that a bucket holds about ``bucket`` rows."""
    axes = 2 * (1 << max(1, (width - 1).bit_length()))
    return max(1, math.floor(math.log(max(1.0, rows / bucket), axes) + 0.5))


def probes_for(functions: int, width: int, probes: int) -> int:
    """Buckets to look into with joined hashes, for the recall of ``probes`` with one: half as large a part of all for each."""
    axes = 2 * (1 << max(1, (width - 1).bit_length()))
    return probes if functions == 1 else probes * (axes // 2) ** (functions - 1)


def search(vectors: DataFrame, every: int = 100, k: int = 10, tables: int = 16, probes: int = 6, bucket: int | None = None,
           block: int = 4096, seed: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row whose id is divisible by ``every``.

    A table has one hash at every number of rows, so that the recall doesn't fall with it; large buckets are cut into blocks.
    A size ``bucket`` asks for joined hashes where buckets would be larger; then the ``probes`` grow with the hashes.

    Score: Euclidean distance in double precision; ties go to the smaller id. All rows are indexed. Vectors that are null,
    zero or hold null or non-finite components take no part; a repeated id counts once per different vector, a query's own id
    never. Vectors of another width than the most common one (ties: the smaller) take no part either. Empty tables give none.
    """
    own = usable(vectors, key, vector)
    shape = own.groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if shape is None:
        return own.select(F.col("id").cast("long").alias("query_id"), F.lit(0).alias("rank"), F.col("id").cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    width, total = shape["width"], shape["count"]
    own = own.where(F.size("vec") == width)
    functions = 1 if bucket is None else functions_for(total, width, bucket)
    hashes, probes = Hashes(width, tables, functions, seed), probes_for(functions, width, probes)

    # Only the k + 1 smallest ids of equal vectors can be among anyone's k nearest; Spark cuts them before the shuffle.
    rows = own.withColumn("n", F.row_number().over(W.partitionBy("vec").orderBy("id"))).where(F.col("n") <= k + 1)
    rows = checkpointed(rows.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn("rep", F.element_at("ids", 1)))
    asked = checkpointed(
        own.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "vec").distinct()
        .join(rows.select(F.col("vec").alias("v"), "rep"), F.col("vec") == F.col("v")).select("query_id", "rep", "vec")
    )
    questions = asked.select("rep", "vec").groupBy("rep").agg(F.first("vec").alias("vec"))

    def put(pdfs):
        for pdf in pdfs:
            pdf["buckets"] = list(hashes.buckets(np.stack(pdf["vec"]))) if len(pdf) else []
            yield pdf[["rep", "vec", "ids", "buckets"]]

    def look(pdfs):
        for pdf in pdfs:
            if len(pdf):
                x = np.stack(pdf["vec"])
                found = np.stack([hashes.probes(x, t, probes) for t in range(tables)], 1)
                pdf["buckets"] = [list(map(list, f)) for f in found]
                yield pdf[["rep", "vec", "buckets"]]

    index = (
        rows.select("rep", "vec", "ids").mapInPandas(put, "rep long, vec array<double>, ids array<long>, buckets array<long>")
        .select("rep", "vec", "ids", F.posexplode("buckets").alias("table", "bucket"))
    )
    looked = (
        questions.mapInPandas(look, "rep long, vec array<double>, buckets array<array<long>>")
        .select("rep", "vec", F.posexplode("buckets").alias("table", "b")).select("rep", "vec", "table", F.explode("b").alias("bucket"))
    )
    nearest = _compare(index, looked, k, block)
    found = checkpointed(_best(nearest, asked, k))
    # The exact way for the rest: queries that found too few rows look at all of them.
    few = asked.join(found.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)), "query_id", "left_anti")
    if total > 1 and not few.isEmpty():
        everything = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns)).withColumn("table", F.lit(-1)).withColumn("bucket", F.lit(0).cast("long"))
        exact = _compare(everything(rows.select("rep", "vec", "ids")), everything(few.select("rep", "vec").dropDuplicates(["rep"])), k, block)
        ids = few.select("query_id").distinct()
        found = found.join(ids, "query_id", "left_anti").unionByName(_best(exact, few, k))
    return found.select(F.col("query_id").cast("long").alias("query_id"), "rank", F.col("vec_id").cast("long").alias("vec_id"), "score")


def _compare(index: DataFrame, looked: DataFrame, k: int, block: int) -> DataFrame:
    """``rep, vec_id, score``: for each query and each block of a bucket it looks into, the best ``k + 1`` rows."""
    by = ["table", "bucket"]
    blocks = (
        index.join(looked.select(*by).distinct(), by, "left_semi").groupBy(*by).count()
        .select(*by, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    right = index.join(blocks, by).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    left = looked.join(blocks, by).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            y = np.stack(rows["vec"])
            x = np.stack(queries["vec"])
            squares = (y * y).sum(1)
            keep = min(len(rows), k + 2)
            for at in range(0, len(queries), 256):
                part = x[at : at + 256]
                rough = squares[None] - 2 * part @ y.T
                # The fast formula only picks; near ties at the edge are kept by its error bound, then measured exactly.
                edge = np.partition(rough, keep - 1, axis=1)[:, keep - 1]
                slack = 1e-9 * (1 + squares.max() + (part * part).sum(1))
                for i in range(len(part)):
                    near = np.flatnonzero(rough[i] <= edge[i] + slack[i])
                    exact = np.sqrt(((y[near] - part[i]) ** 2).sum(1))
                    pairs = sorted((d, v) for d, j in zip(exact.tolist(), near.tolist()) for v in rows["ids"].iat[j])
                    out += [(queries["rep"].iat[at + i], v, d) for d, v in pairs[: k + 1]]
        return pd.DataFrame(out, columns=["rep", "vec_id", "score"]).astype({"rep": "int64", "vec_id": "int64", "score": "float64"})

    group = [*by, "part"]
    return (
        left.select("rep", "vec", *group).groupBy(*group)
        .cogroup(right.select("rep", "vec", "ids", *group).groupBy(*group))
        .applyInPandas(compare, "rep long, vec_id long, score double")
    )


def _best(near: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what the tables found for a vector, for every query with that vector, without its own id."""
    order = W.partitionBy("rep").orderBy("score", "vec_id")
    top = near.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    own = asked.select("query_id", "rep").join(top, "rep").where(F.col("query_id") != F.col("vec_id"))
    rank = W.partitionBy("query_id").orderBy("score", "vec_id")
    return own.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
