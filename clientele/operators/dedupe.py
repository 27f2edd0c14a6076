"""Keep one row per key without pulling a key's rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` tuple of every key.

    An aggregate instead of a window: every map task reduces its rows to one per key before the shuffle, so a key that
    owns a third of the input costs one row per task. ``order_by`` should end in tie-break columns that make the
    choice unique.
    """
    order = [F.col(c) for c in order_by]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per ``partition_by`` group, the first under ``order_by`` = [(column, 'asc' | 'desc'), ...].

    NULLs come last in either direction: a row with a NULL is picked only where no other is left. Groups are reduced
    map-side as in :func:`latest_per_key`. A mixed order is expressed by two nested picks: the leading column is fixed
    first (min or max per key), the others among the rows that share it.
    """
    directions = {d for _, d in order_by}
    pick = [c for c, _ in order_by]
    rest = [c for c in df.columns if c not in partition_by and c not in pick]
    if len(directions) == 1:
        # In the order of structs a NULL is the least value: last for max, and put behind by a flag for min.
        behind = [f for c in pick for f in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
        best = F.max(F.struct(*pick, *rest)) if directions == {"desc"} else F.min(F.struct(*behind, *rest))
        return df.groupBy(*partition_by).agg(best.alias("_row")).select(
            *[F.col(c) if c in partition_by else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
        )
    (lead, direction), *others = order_by
    bound = df.groupBy(*partition_by).agg((F.max if direction == "desc" else F.min)(lead).alias("_bound"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in partition_by]
    tied = df.alias("a").join(bound.alias("b"), [*same, F.col(f"a.{lead}").eqNullSafe(F.col("b._bound"))], "left_semi")
    return deduplicate(tied, partition_by, others)
