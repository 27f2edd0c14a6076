"""Joins of a large table with a dimension when a few keys own a large part of the large table's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators.ordered import ROWS, heavy_keys, split_by_keys


def dimension_join(
    facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", most: int = ROWS, feed: DataFrame | None = None
) -> DataFrame:
    """``facts`` joined to ``dim`` on ``key``; ``dim`` has one row per key. ``how``: inner or left.

    Keys with more than ``most`` facts are found first (``feed``: see :func:`heavy_keys`). Their facts stay where they are and
    meet their dimension rows, one per such key and so at most facts / most, by a broadcast; all other facts take the plain
    join, in which no key is large any more.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, got {how!r}")
    heavy = [r for r in heavy_keys(facts, [key], most, feed) if r[key] is not None]
    unmatched = facts.where(F.col(key).isNull())
    if not heavy:
        return facts.join(dim, key, how)
    hot, cold = split_by_keys(facts.where(F.col(key).isNotNull()), [key], heavy)
    few, _ = split_by_keys(dim, [key], heavy)
    out = hot.join(F.broadcast(few), key, how).unionByName(cold.join(dim, key, how))
    if how == "left":
        # NULL keys match nothing: no shuffle would deal them out evenly.
        blanks = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in dim.columns if c != key]
        out = out.unionByName(unmatched.select("*", *blanks))
    return out
