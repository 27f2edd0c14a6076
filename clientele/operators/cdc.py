"""Change streams: classification against a history table, history merge, fact upsert, summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.dates import at_time
from clientele.operators.dedupe import latest_per_key
from clientele.operators.ordered import ROWS, in_pieces, neighbour

OPEN_END = dt.datetime(9999, 12, 31)


def intervals(rows: DataFrame, key: str, start: str, most: int = ROWS) -> DataFrame:
    """Add end_time (start of the next row of the key, else the open end) and current_flag."""
    near = neighbour(rows, [key], start, "_next", most=most)
    return near.withColumns({
        "end_time": F.coalesce("_next", at_time(OPEN_END)), "current_flag": F.col("_next").isNull().cast("int"),
    }).drop("_next")


# Kinds of rows in the fold over history and changes.
KNOWN, FRESH, UPDATE, DELETE = "known", "fresh", "update", "delete"


def _fold(changes: DataFrame, history: DataFrame, attributes: Sequence[str], as_of: dt.datetime, most: int) -> DataFrame:
    """History and changes in one order by id and time, each row with the history rows it brings about as ``_out``.

    ``_out``: (dml_type, end_time, current_flag) of the version that the row opens (I) or closes (U, D). A fresh insert ends
    where the next fresh insert of its id starts, an update where the next update does; the open version of an id that has
    updates takes part in their order and is closed (U), that of an id with a deletion is closed at ``as_of`` (D). One
    shuffle by id; rows of a hot id are cut into pieces, over whose borders the next starts and the presence of updates and
    deletions are carried.
    """
    kind = (
        F.when((F.col("action") == "INSERT") & ~F.col("is_update"), FRESH).when((F.col("action") == "INSERT") & F.col("is_update"), UPDATE)
        .when((F.col("action") == "DELETE") & ~F.col("is_update"), DELETE)
    )
    batch = changes.select(
        "id", F.col("update_timestamp").alias("start_time"), *[F.col(a).cast(history.schema[a].dataType).alias(a) for a in attributes], kind.alias("_kind"),
        F.lit(None).cast("timestamp_ntz").alias("end_time"), F.lit(None).cast("int").alias("current_flag"),
    ).where(F.col("_kind").isNotNull())
    known = history.select("id", "start_time", *attributes, F.lit(KNOWN).alias("_kind"), "end_time", F.col("current_flag").cast("int").alias("current_flag"))
    pieces = in_pieces(known.unionByName(batch), ["id"], ["start_time"], most)

    is_open = (F.col("_kind") == KNOWN) & (F.col("current_flag") == 1)
    starts = {"fresh": F.when(F.col("_kind") == FRESH, F.col("start_time")), "update": F.when((F.col("_kind") == UPDATE) | is_open, F.col("start_time"))}
    present = {k: F.max(F.col("_kind") == k) for k in (UPDATE, DELETE)}
    behind = pieces.window(F.desc("start_time")).rowsBetween(Window.unboundedPreceding, -1)
    rows = pieces.rows.withColumns({f"_next_{k}": F.last(c, ignorenulls=True).over(behind) for k, c in starts.items()})
    rows = rows.withColumns({f"_has_{k}": c.over(Window.partitionBy(*pieces.by)) for k, c in present.items()})
    if pieces.hot is not None:
        whole = Window.partitionBy("id")
        rows = pieces.carry(
            rows,
            [*[F.min(c).alias(f"_first_{k}") for k, c in starts.items()], *[c.alias(f"_in_{k}") for k, c in present.items()]],
            [
                *[F.last(f"_first_{k}", ignorenulls=True).over(pieces.along(ahead=True)).alias(f"_far_{k}") for k in starts],
                *[F.max(f"_in_{k}").over(whole).alias(f"_any_{k}") for k in present],
            ],
        ).withColumns({
            **{f"_next_{k}": F.coalesce(f"_next_{k}", f"_far_{k}") for k in starts},
            **{f"_has_{k}": F.coalesce(f"_any_{k}", f"_has_{k}") for k in present},
        })

    def version(dml: str, end, flag):
        return F.struct(F.lit(dml).alias("dml_type"), end.alias("end_time"), flag.cast("int").alias("current_flag"))

    def until(name: str, dml: str):
        following = F.col(f"_next_{name}")
        return version(dml, F.coalesce(following, at_time(OPEN_END)), following.isNull())

    out = F.array_compact(F.array(
        F.when(F.col("_kind") == FRESH, until("fresh", "I")), F.when(F.col("_kind") == UPDATE, until("update", "I")),
        F.when(is_open & F.col("_has_update"), until("update", "U")),
        F.when(is_open & F.col("_has_delete"), version("D", at_time(as_of), F.lit(None))),
    ))
    return rows.select("id", "start_time", *attributes, "_kind", "end_time", "current_flag", out.alias("_out"))


def classify(changes: DataFrame, history: DataFrame, attributes: Sequence[str], as_of: dt.datetime, most: int = ROWS) -> DataFrame:
    """History rows to insert (I), close by an update (U) or close by a deletion (D).

    ``changes``: id, update_timestamp, action, is_update, attributes. ``history``: id, attributes, start_time,
    end_time, current_flag.
    """
    rows = _fold(changes, history, attributes, as_of, most)
    opens = F.col("_kind") != KNOWN
    return rows.select(
        "id", *[F.when(opens, F.col(a)).alias(a) for a in attributes], "start_time", F.explode("_out").alias("_o")
    ).select("id", *attributes, "start_time", "_o.end_time", "_o.current_flag", "_o.dml_type").distinct()


def apply_changes(changes: DataFrame, history: DataFrame, attributes: Sequence[str], as_of: dt.datetime, most: int = ROWS) -> DataFrame:
    """History after the changes: :func:`classify` and :func:`merge_history` in one pass over both, with one shuffle by id.

    A row that is closed twice keeps the earlier end. Of several inserts with the start of one version one is taken, and
    none if the history has that version.
    """
    rows = _fold(changes, history, attributes, as_of, most)
    place = Window.partitionBy("id", "start_time")
    known, opened = F.col("_kind") == KNOWN, F.get("_out", F.lit(0))
    close = F.when(known, F.array_min(F.transform("_out", lambda o: o["end_time"])))
    fresh = F.when(~known & (F.size("_out") > 0), F.struct(*attributes, opened["end_time"].alias("end_time"), opened["current_flag"].alias("current_flag")))
    rows = rows.withColumns({
        "_close": F.min(close).over(place), "_known": F.max(known).over(place), "_new": fresh,
    })
    first = F.row_number().over(Window.partitionBy("id", "start_time", known).orderBy(F.desc_nulls_last("_new")))
    kept = rows.withColumn("_at", first).where(known | (~F.col("_known") & F.col("_new").isNotNull() & (F.col("_at") == 1)))
    closed = F.col("_close").isNotNull()
    return kept.select(
        "id", *attributes, "start_time",
        F.when(known, F.coalesce("_close", "end_time")).otherwise(F.col("_new.end_time")).alias("end_time"),
        F.when(known & closed, 0).when(known, F.col("current_flag")).otherwise(F.col("_new.current_flag")).alias("current_flag"),
    )


def merge_history(history: DataFrame, classified: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Close matched rows (U, D) and insert unmatched I rows, matching on (id, start_time).

    When a row is closed twice in one batch the earlier end holds. Both sides have one row per (id, start_time), so
    one full join does the whole merge. :func:`apply_changes` does it from the changes themselves.
    """
    ends = F.min(F.when(F.col("dml_type").isin("U", "D"), F.col("end_time"))).alias("close_at")
    picked = F.max(F.when(F.col("dml_type") == "I", F.struct(*attributes, "end_time", "current_flag"))).alias("_new")
    batch = classified.groupBy("id", "start_time").agg(ends, picked)
    known = F.col("h.id").isNotNull()
    joined = history.alias("h").join(
        batch.alias("b"), (F.col("h.id") == F.col("b.id")) & (F.col("h.start_time") == F.col("b.start_time")), "full"
    ).where(known | F.col("_new").isNotNull())
    closed = F.col("close_at").isNotNull()
    return joined.select(
        F.coalesce("h.id", "b.id").alias("id"),
        *[F.when(known, F.col(f"h.{a}")).otherwise(F.col(f"_new.{a}")).alias(a) for a in attributes],
        F.coalesce("h.start_time", "b.start_time").alias("start_time"),
        F.when(known & closed, F.col("close_at")).when(known, F.col("h.end_time")).otherwise(F.col("_new.end_time")).alias("end_time"),
        F.when(known & closed, 0).when(known, F.col("h.current_flag")).otherwise(F.col("_new.current_flag")).alias("current_flag"),
    )


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], updated: Sequence[str] | None = None,
    action: str | None = None,
) -> DataFrame:
    """``target`` after the latest change of every key in ``batch``.

    A DELETE removes the row, anything else updates the ``updated`` columns (default: all) or inserts. The batch is
    reduced to one row per key map-side, so one key re-delivered many times does not skew the join.
    """
    latest = latest_per_key(batch, keys, order_by)
    updated = list(updated or [c for c in target.columns if c not in keys])
    on = None
    for k in keys:
        term = F.col(f"t.{k}") == F.col(f"b.{k}")
        on = term if on is None else on & term
    old, new = F.col(f"t.{keys[0]}").isNotNull(), F.col(f"b.{keys[0]}").isNotNull()
    removed = new & (F.col(f"b.{action}") == "DELETE") if action else F.lit(False)
    joined = target.alias("t").join(latest.alias("b"), on, "full").where(~F.coalesce(removed, F.lit(False)))

    def cell(name: str):
        if name in keys:
            return F.coalesce(F.col(f"t.{name}"), F.col(f"b.{name}"))
        if name not in batch.columns:
            return F.col(f"t.{name}")
        if name in updated:
            return F.when(new, F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))
        return F.when(old, F.col(f"t.{name}")).otherwise(F.col(f"b.{name}"))

    return joined.select(*[cell(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def summary(changes: DataFrame) -> DataFrame:
    """Number of changes by action."""
    return changes.agg(
        F.count(F.lit(1)).alias("total_changes"),
        F.sum(F.when(F.col("action") == "INSERT", 1).otherwise(0)).alias("inserts"),
        F.sum(F.when(F.col("action") == "DELETE", 1).otherwise(0)).alias("deletes"),
    )
