"""Work in the order of a key's rows that stays bounded when one key owns a large part of the table.

A window over a key puts all its rows in one task. Keys that are small enough take that plain window: one shuffle by key.
The rows of the few keys that are not are range-partitioned by key and order, so that a key may be cut anywhere, and written
with the number of their piece. Windows then run inside the pieces, and what a row needs from beyond its piece is carried
over from one summary row per piece. Which keys are cut follows from a count per key; no width or bucket is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from clientele.session import written

#: Rows of one key that a task may sort.
ROWS = 4_000_000
PIECE = "_piece"


def heavy_keys(df: DataFrame, keys: Sequence[str], most: int, feed: DataFrame | None = None) -> list[Row]:
    """Keys with more than ``most`` rows and their ``_n``. There are at most rows / most of them; counted map-side.

    ``feed``: a table that is cheap to count and has at least as many rows as ``df``, such as the scan ``df`` comes from. If it
    has no more than ``most``, no key can have.
    """
    if feed is not None and feed.count() <= most:
        return []
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).collect()


def is_same(keys: Sequence[str], left: str, right: str) -> Column | bool:
    """Equality of all keys, NULL equal to NULL."""
    same = [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    out = F.lit(True)
    for term in same:
        out = out & term
    return out


def split_by_keys(df: DataFrame, keys: Sequence[str], chosen: list[Row]) -> tuple[DataFrame, DataFrame]:
    """Rows of the ``chosen`` keys, and all others. The chosen keys are a literal table of as many rows."""
    schema = df.select(*keys).schema
    few = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in chosen], schema)
    on = is_same(keys, "l", "r")
    hot = df.alias("l").join(F.broadcast(few).alias("r"), on, "left_semi")
    cold = df.alias("l").join(F.broadcast(few).alias("r"), on, "left_anti")
    return hot, cold


@dataclass(frozen=True)
class Pieces:
    """``rows``: the table; ``by``: the columns that a window over a bounded number of its rows is partitioned by; ``hot``: the rows
    of the keys that were cut, or None."""

    rows: DataFrame
    keys: tuple[str, ...]
    hot: DataFrame | None = None

    @property
    def by(self) -> tuple[str, ...]:
        return self.keys if self.hot is None else (*self.keys, PIECE)

    def window(self, *order: str | Column) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*order)

    def carry(self, df: DataFrame, summary: Sequence[Column], carried: Sequence[Column]) -> DataFrame:
        """``df`` (rows of all pieces) with the ``carried`` columns: window expressions over the ``summary`` of the pieces of a key.

        NULL for keys that were not cut. The summaries are one row for each piece of a cut key, so few by construction.
        """
        edges = self.hot.groupBy(*self.by).agg(*summary)
        names = [c for c in edges.columns if c not in self.by]
        far = F.broadcast(edges.select("*", *carried).drop(*names))
        extra = [c for c in far.columns if c not in self.by]
        return df.alias("l").join(far.alias("r"), is_same(self.by, "l", "r"), "left").select(
            *[F.col(f"l.`{c}`") for c in df.columns], *[F.col(f"r.`{c}`") for c in extra]
        )

    def along(self, ahead: bool = False) -> WindowSpec:
        """The pieces of a key before a piece (or, ``ahead``, behind it), nearest last."""
        order = F.desc(PIECE) if ahead else F.asc(PIECE)
        keys = self.keys or (F.lit(0),)
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], most: int = ROWS) -> Pieces:
    """``df`` cut so that no window partitioned by :attr:`Pieces.by` has many more than ``most`` rows.

    The pieces of a key are numbered along ``order``. Rows that agree in it are dealt by their other columns; only rows that
    are the same in all columns stay together.
    """
    keys = tuple(keys)
    heavy = heavy_keys(df, keys, most)
    if not heavy:
        return Pieces(df, keys)
    hot, cold = split_by_keys(df, keys, heavy) if keys else (df, df.limit(0))
    parts = sum(-(-r["_n"] // most) for r in heavy) + 1
    rest = [c for c in df.columns if c not in keys and c not in order]
    ties = [F.xxhash64(*rest)] if rest else []
    ranged = hot.repartitionByRange(parts, *keys, *order, *ties).withColumn(PIECE, F.spark_partition_id())
    cut = written(ranged, "pieces")
    return Pieces(cold.withColumn(PIECE, F.lit(0)).unionByName(cut), keys, cut)


def neighbour(df: DataFrame, keys: Sequence[str], order: str, name: str, ahead: bool = True, most: int = ROWS) -> DataFrame:
    """Add the next (or previous) value of ``order`` within ``keys`` as ``name``. ``order`` must not be NULL.

    Of rows with equal ``order`` all but one have that value itself as neighbour.
    """
    pieces = in_pieces(df, keys, [order], most)
    step = F.lead if ahead else F.lag
    local = pieces.rows.withColumn(name, step(order).over(pieces.window(order)))
    if pieces.hot is None:
        return local
    edge = (F.min if ahead else F.max)(order).alias("_edge")
    far = F.last("_edge", ignorenulls=True).over(pieces.along(ahead)).alias("_far")
    return pieces.carry(local, [edge], [far]).select(*df.columns, F.coalesce(name, "_far").alias(name))


def as_of_merge(facts: DataFrame, versions: DataFrame, key: str, day: str, start: str = "valid_from", most: int = ROWS) -> DataFrame:
    """Facts with the columns of the version of their key that started last, on their ``day`` or before.

    The moments of the facts, one row for each key and day, and the versions are put into one order, and every moment takes the
    last version before it; the facts then meet their moment's version by equality. So the work is linear in facts plus versions,
    however many versions a key has. (An equi join with a range condition compares every fact with all versions of its key.) The
    facts themselves are never sorted by this, and shuffled only where their moments are too many for a broadcast. They are read
    twice (once more if single moments are crowded): facts that come out of shuffles should be ``written`` first. The versions of
    a key must not overlap: of several that started, only the last is looked at. Facts with a NULL key or day, or from before the
    first version, are left out.
    """
    added = [c for c in versions.columns if c != key]
    clash = set(added) & set(facts.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    version_type = versions.select(*added).schema.simpleString()
    dated = facts.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(F.col(key).alias("_key"), F.col(day).alias("_at"))
    left = written(dated.groupBy("_key", "_at").agg(F.count(F.lit(1)).alias("_n")), "moments").select(
        "_key", "_at", F.lit(1).alias("_side"), "_n", F.lit(None).cast(version_type).alias("_version")
    )
    right = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).cast(facts.schema[day].dataType).alias("_at"), F.lit(0).alias("_side"),
        F.lit(None).cast("long").alias("_n"), F.struct(*added).alias("_version"),
    )
    pieces = in_pieces(left.unionByName(right), ["_key"], ["_at", "_side"], most)
    before = pieces.window("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = pieces.rows.withColumn("_valid", F.last("_version", ignorenulls=True).over(before))
    if pieces.hot is not None:
        latest = F.max(F.when(F.col("_side") == 0, F.struct("_at", "_version")))["_version"].alias("_latest")
        far = F.last("_latest", ignorenulls=True).over(pieces.along()).alias("_far")
        merged = pieces.carry(merged, [latest], [far]).withColumn("_valid", F.coalesce("_valid", "_far"))
    # Written, so that Spark knows before the join of the facts how large it is.
    found = written(merged.where(F.col("_side") == 1).select("_key", "_at", "_n", "_valid"), "as_of")
    same = (F.col(f"l.`{key}`") == F.col("r._key")) & (F.col(f"l.`{day}`") == F.col("r._at"))

    def dated_by(some: DataFrame, moments: DataFrame) -> DataFrame:
        both = some.alias("l").join(moments.alias("r"), same).where(F.col("r._valid").isNotNull())
        return both.select(*[F.col(f"l.`{c}`") for c in facts.columns], *[F.col(f"r._valid.`{c}`").alias(c) for c in added])

    # Moments with more facts than a task should hold, at most facts / most: their facts stay where they are.
    crowded = F.broadcast(found.where(F.col("_n") > most))
    if crowded.isEmpty():
        return dated_by(facts, found)
    rest = facts.alias("l").join(crowded.alias("r"), same, "left_anti")
    return dated_by(facts, crowded).unionByName(dated_by(rest, found))
