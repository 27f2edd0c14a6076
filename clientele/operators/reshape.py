"""Pivot, unpivot, series, spines and row expansion."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.columns import slugify
from clientele.functions.dates import at_time

COMPARE = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
}
AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def pivot_columns(
    column: str, values: Sequence, agg: str = "sum", cmp: str = "=", then=1, other=0, prefix: str = "", suffix: str = "",
    distinct: bool = False, slug: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, to be used inside ``groupBy().agg()``.

    ``then`` and ``other`` are literals or columns. Unlike ``groupBy().pivot()`` a value that does not match
    contributes ``other``.
    """
    out = []
    for value in values:
        hit = COMPARE[cmp](F.col(column), F.lit(value))
        cell = F.when(hit, then if isinstance(then, Column) else F.lit(then)).otherwise(
            other if isinstance(other, Column) else F.lit(other)
        )
        if distinct:
            made = {"sum": F.sum_distinct, "count": F.count_distinct}[agg](cell)
        else:
            made = AGGREGATES[agg](cell)
        name = f"{prefix}{value}{suffix}"
        out.append(made.alias(slugify(name) if slug else name))
    return out


def column_values(
    df: DataFrame, column: str, limit: int | None = None, where: Column | None = None, order_by: Column | None = None
) -> DataFrame:
    """Distinct values, most frequent first unless ``order_by`` says otherwise."""
    found = (df.where(where) if where is not None else df).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ordered = found.orderBy(order_by if order_by is not None else F.desc("_n"), "value")
    return (ordered.limit(limit) if limit else ordered).select("value")


def unpivot(
    df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (), remove: Sequence[str] = (),
    field_name: str = "field_name", value_name: str = "value",
) -> DataFrame:
    """Columns to rows: ``exclude`` columns are kept beside every row, ``remove`` columns are dropped."""
    hidden = {c.lower() for c in (*exclude, *remove)}
    melted = [f for f in df.schema.fields if f.name.lower() not in hidden]
    # Booleans become 'true' / 'false' before the cast.
    cells = [
        (F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, T.BooleanType) else F.col(f"`{f.name}`"))
        .cast(cast_to).alias(f.name)
        for f in melted
    ]
    return df.select(*exclude, *cells).unpivot(list(exclude), [f.name for f in melted], field_name, value_name)


def series(spark: SparkSession, n: int, name: str = "generated_number") -> DataFrame:
    """1..n, split over the tasks."""
    return spark.range(1, n + 1).select(F.col("id").alias(name))


SECONDS = {"minute": 60, "hour": 3600}


def date_spine(spark: SparkSession, part: str, start: dt.date, end: dt.date) -> DataFrame:
    """Dates from ``start`` in steps of ``part``; ``end`` itself is not produced.

    Parts: minute and hour give timestamps; day, week, month, quarter and year give dates. Steps are made in the tasks.
    """
    name = f"date_{part}"
    if part in SECONDS:
        first = dt.datetime.combine(start, dt.time())
        count = max(0, (end - start).days * 86400 // SECONDS[part])
        return spark.range(count).select((at_time(first) + F.make_dt_interval(secs=F.col("id") * SECONDS[part])).alias(name))
    step = {
        "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR",
    }[part]
    if end <= start:
        return spark.createDataFrame([], f"{name} date")
    one = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr(step))).alias(name))
    return one.where(F.col(name) < F.lit(end))


def spine_of(bounds: DataFrame, step: str, name: str) -> DataFrame:
    """Dates between the ``first`` and ``last`` of a one-row table, last excluded."""
    days = F.explode(F.sequence("first", "last", F.expr(step))).alias(name)
    return bounds.select("last", days).where(F.col(name) < F.col("last")).select(name)


def months_from(first: dt.date, last: dt.date) -> Column:
    """The month starts from ``first`` to ``last``, both included, as an array."""
    return F.sequence(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)), F.expr("INTERVAL 1 MONTH"))


def entity_months(entities: DataFrame, key: str, months: Column) -> DataFrame:
    """Every entity in every month, made in place by exploding the calendar array."""
    return entities.select(key, F.explode(months).alias("month"))


def monthly_panel(active: DataFrame, entities: DataFrame, months: Column, key: str, measures: Sequence[str]) -> DataFrame:
    """Every entity in every month, absent measures as 0."""
    dense = entity_months(entities, key, months).join(active, [key, "month"], "left")
    return dense.select(key, "month", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


def expand_rows(df: DataFrame, times: Column, name: str = "seq") -> DataFrame:
    """Repeat every row ``times`` times with a sequence number from 0; rows with 0 or fewer times disappear."""
    return df.where(times > 0).select("*", F.explode(F.sequence(F.lit(0), times.cast("int") - 1)).alias(name))
