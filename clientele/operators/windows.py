"""Numbers and shares over the order of a whole table, whole and bounded when one value owns a large part of the rows.

A window over a table puts all its rows in one task. The operators here first cut the order into ranges, work inside the
ranges, and carry one summary row per range across their borders. The only windows that span a whole table run over those
summaries. Orders within keys are in :mod:`clientele.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.operators.ordered import ROWS
from clientele.session import written


def _bucket_of(value: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """Number of sorted bounds that are <= value, by halving."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    below, above = _bucket_of(value, bounds[:middle], first), _bucket_of(value, bounds[middle + 1 :], first + middle + 1)
    return F.when(value < F.lit(bounds[middle]), below).otherwise(above)


def global_ranks(df: DataFrame, orders: Mapping[str, tuple[str, bool]], most: int = ROWS) -> DataFrame:
    """Add RANK() over the whole table for several orders at once: ``orders`` = {name: (column, ascending)}.

    ``df`` is written once. Up to ``most`` rows the ranks are plain windows of one task. Beyond that, one pass finds
    quantiles of all columns with mergeable sketches, as many as the rows ask for. Equal values are collapsed to
    (value, count), which also removes hot values; the distinct values are cut into ranges at the quantiles, and counts before
    a value are the sum of the lower ranges plus the running count inside its range. The quantiles only steer the split and
    are literals of the plan, so a retried task sees the same ranges. NULL values have no rank.
    """
    df = written(df, "ranked")
    rows = df.count()
    if rows <= most:
        for name, (column, ascending) in orders.items():
            order = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
            df = df.withColumn(name, F.when(F.col(column).isNotNull(), F.rank().over(Window.orderBy(order))))
        return df
    ranges = -(-rows // most)
    columns = sorted({c for c, _ in orders.values()})
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    splits = doubles.approxQuantile(columns, [i / ranges for i in range(1, ranges)], max(1 / (4 * ranges), 1e-5))
    bounds = {c: sorted(set(found)) for c, found in zip(columns, splits)}
    for name, (column, ascending) in orders.items():
        ranks = _ranks(df, column, name, ascending, bounds[column])
        df = df.join(ranks, F.col(column) == F.col("_v"), "left").drop("_v")
    return df


def _ranks(df: DataFrame, value: str, name: str, ascending: bool, bounds: Sequence[float]) -> DataFrame:
    """Rank of every distinct value ``_v``."""
    values = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = values.withColumn("_range", _bucket_of(F.col("_v").cast("double"), bounds))
    order = F.col("_v") if ascending else F.col("_v").desc()
    outer = F.col("_range") if ascending else F.col("_range").desc()
    before_range = (
        ranged.groupBy("_range").agg(F.sum("_n").alias("_in"))
        .withColumn(
            "_before", F.coalesce(F.sum("_in").over(Window.orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).select("_range", "_before")
    )
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(before_range, "_range")
        .select("_v", (F.col("_before") + F.col("_inside") + 1).alias(name))
    )


def range_bucket(df: DataFrame, column: str, ranges: int | None = None, rows_per_range: int = 100_000) -> Column:
    """Number of the equal-width range of a numeric column.

    Least and greatest value and the row count are read first. The number of ranges follows from the rows unless given.
    """
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    if low is None:
        return F.lit(0)
    ranges = ranges or max(256, rows // rows_per_range + 1)
    width = max(1, (high - low) // ranges + 1)
    return F.floor((F.col(column) - F.lit(low)) / F.lit(width))


def global_row_number(df: DataFrame, day: str, middle: str, tie: str, name: str, ranges: int | None = None) -> DataFrame:
    """ROW_NUMBER() over (day, middle, tie) for the whole table.

    Counts per (day, range of the numeric column ``middle``) give the offset of each cell; only the rows of one cell
    are numbered together. A day with many rows is split by ``middle``, a frequent ``middle`` by the days.
    """
    cell = range_bucket(df, middle, ranges)
    counts = df.groupBy(F.col(day), cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    per_day = counts.groupBy(day).agg(F.sum("_n").alias("_day_n")).withColumn(
        "_day_before",
        F.coalesce(F.sum("_day_n").over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select(day, "_day_before")
    cells = counts.withColumn(
        "_cell_before",
        F.coalesce(
            F.sum("_n").over(Window.partitionBy(day).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).join(per_day, day).select(day, "_cell", (F.col("_day_before") + F.col("_cell_before")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(day, "_cell").orderBy(middle, tie))
    return (
        df.withColumn("_cell", cell).withColumn("_local", local).join(cells, [day, "_cell"])
        .withColumn(name, F.col("_before") + F.col("_local")).drop("_cell", "_local", "_before")
    )


def month_over_month(df: DataFrame, month: str, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Previous month's value and the change in percent, over an already aggregated monthly table."""
    w = Window.partitionBy(*keys).orderBy(month)
    prior = F.lag(value).over(w)
    change = F.round((F.col(value) - F.col(name)).cast("double") * 100 / F.nullif(F.col(name).cast("double"), F.lit(0.0)), 2)
    return df.withColumn(name, prior).withColumn(f"{value}_pct_change", change)


def share_of_total(df: DataFrame, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of a group's value in the total of the (few) result rows of ``keys``."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(
        name, F.round(F.col(value).cast("double") * 100 / F.nullif(total.cast("double"), F.lit(0.0)), 2)
    )
