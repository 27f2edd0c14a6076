"""Slowly changing dimension (type 2) kept by one join of the current versions with a snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import surrogate_key

NEW, CHANGED, SAME, ABSENT = "NEW", "CHANGED", "NO_CHANGE", "ABSENT"


@dataclass(frozen=True)
class Tracking:
    """``tracked`` columns open a new version when they differ, ``overwritten`` ones are updated in place.

    A NULL on either side of a comparison is no difference, except for the ``blank_aware`` columns, where NULL counts
    as an empty string.
    """

    key: str
    tracked: Sequence[str]
    overwritten: Sequence[str]
    blank_aware: Sequence[str] = ()
    surrogate: str = "customer_key"


def _differs(columns: Sequence[str], blank_aware: Sequence[str] = ()) -> Column:
    def one(c: str) -> Column:
        s, h = F.col(f"s.{c}"), F.col(f"h.{c}")
        if c in blank_aware:
            s, h = F.coalesce(s, F.lit("")), F.coalesce(h, F.lit(""))
        return F.coalesce(s != h, F.lit(False))

    return reduce(lambda a, b: a | b, [one(c) for c in columns], F.lit(False))


def _matched(history: DataFrame, snapshot: DataFrame, t: Tracking, how: str) -> DataFrame:
    current = history.where("is_current")
    joined = snapshot.alias("s").join(current.alias("h"), F.col(f"s.{t.key}") == F.col(f"h.{t.key}"), how)
    kind = (
        F.when(F.col(f"h.{t.key}").isNull(), NEW).when(F.col(f"s.{t.key}").isNull(), ABSENT)
        .when(_differs(t.tracked), CHANGED).otherwise(SAME)
    )
    return joined.withColumn("_kind", kind)


def detect(history: DataFrame, snapshot: DataFrame, t: Tracking) -> DataFrame:
    """Change type of every snapshot row with the old and new tracked values."""
    values = [F.col(f"{side}.{c}").alias(f"{name}_{c}") for c in t.tracked for side, name in (("h", "old"), ("s", "new"))]
    return _matched(history, snapshot, t, "left").select(F.col(f"s.{t.key}").alias(t.key), F.col("_kind").alias("change_type"), *values)


def changes(history: DataFrame, snapshot: DataFrame, t: Tracking, as_of: dt.date, kinds: Sequence[str] = (NEW, CHANGED, SAME, ABSENT)) -> DataFrame:
    """The versions that replace the current ones, labelled with what happened (``_part``).

    A changed key gives two rows, the closed and the new version; a version that itself started on ``as_of`` is
    replaced in place, so repeated runs of one day do not leave empty ranges.
    """
    columns = history.columns
    day = F.lit(as_of)

    def row(part: str, **over: Column) -> Column:
        cells = []
        for f in history.schema.fields:
            value = over.get(f.name, F.col(f"h.{f.name}"))
            cells.append(value.cast(f.dataType).alias(f.name))
        return F.struct(F.lit(part).alias("_part"), *cells)

    taken = {c: F.col(f"s.{c}") for c in columns if c in snapshot.columns}
    fresh = {
        **taken, t.surrogate: surrogate_key(F.col(f"s.{t.key}"), day), "valid_from": day,
        "valid_to": F.lit(None), "is_current": F.lit(True), "updated_on": day,
    }
    same_day = F.col("h.valid_from") == day
    new = row("inserted", **fresh)
    closed = row("expired", valid_to=F.date_sub(day, 1), is_current=F.lit(False), updated_on=day)
    in_place = row("replaced", **{c: F.col(f"s.{c}") for c in (*t.tracked, *t.overwritten)}, updated_on=day)
    updated = row("updated", **{c: F.col(f"s.{c}") for c in t.overwritten}, updated_on=day)
    kept = row("kept")
    rows = (
        F.when(F.col("_kind") == NEW, F.array(new))
        .when((F.col("_kind") == CHANGED) & same_day, F.array(in_place))
        .when(F.col("_kind") == CHANGED, F.array(closed, new))
        .when((F.col("_kind") == SAME) & _differs(t.overwritten, t.blank_aware), F.array(updated))
        .otherwise(F.array(kept))
    )
    how = "full" if ABSENT in kinds else "left"
    matched = _matched(history, snapshot, t, how).where(F.col("_kind").isin(*kinds))
    return matched.select(F.inline(rows))


def scd2_merge(history: DataFrame, snapshot: DataFrame, t: Tracking, as_of: dt.date) -> DataFrame:
    """The whole dimension after ``as_of``: closed versions pass through, current ones meet the snapshot once."""
    return history.where(~F.col("is_current")).unionByName(changes(history, snapshot, t, as_of).drop("_part"))
