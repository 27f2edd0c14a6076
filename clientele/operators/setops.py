"""Stacking and comparing relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_relations(
    relations: Mapping[str, DataFrame], include: Sequence[str] = (), exclude: Sequence[str] = (),
    override: Mapping[str, str] | None = None, source_column: str | None = "source_relation", where: Column | None = None,
) -> DataFrame:
    """Stack relations over the superset of their columns; missing ones are NULL, ``override`` forces a type."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = dict(override or {})
    hidden, shown = {c.lower() for c in exclude}, {c.lower() for c in include}
    types: dict[str, str] = {}
    for df in relations.values():
        for name, kind in df.dtypes:
            if name.lower() in hidden or (shown and name.lower() not in shown):
                continue
            types.setdefault(name, override.get(name, kind))
    parts = []
    for source, df in relations.items():
        rows = df.where(where) if where is not None else df
        cells = [
            (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in types.items()
        ]
        tag = [F.lit(source).alias(source_column)] if source_column else []
        parts.append(rows.select(*tag, *cells))
    return reduce(DataFrame.union, parts)


def except_both(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found on one side only, with the side.

    Both sides are grouped once and joined by one full comparison of row counts per side, instead of two EXCEPTs that
    would each shuffle both inputs.
    """
    columns = list(columns or a.columns)
    sides = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    seen = sides.groupBy(*columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    side = F.when(F.col("_b") == 0, "a_minus_b").otherwise("b_minus_a")
    return seen.where(F.col("_a") != F.col("_b")).select(side.alias("which_diff"), *columns)


def cardinality_diff(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs that differ between two columns."""
    left = a.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    right = b.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return except_both(left, right)


def beside(*rows: DataFrame) -> DataFrame:
    """One-row tables put side by side as one row.

    The rows are stacked and reduced by one aggregate, which needs no join; a column keeps the value of the one table
    that has it.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(f"`{c}`").alias(c) for c in stacked.columns])


def group_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of the row counts of two relations per group; groups with a NULL key stay unmatched."""
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_a"))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_b"))
    if not keys:
        return beside(left, right)
    on = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    named = [F.col(f"{s}.{k}").alias(f"{k}_{s}") for k in keys for s in ("a", "b")]
    return left.alias("a").join(right.alias("b"), on, "full").select(*named, "count_a", "count_b")
