"""Exact percentiles of groups of any size, without a width or a number of ranges to choose.

Groups that a task can hold take Spark's own exact percentile, all columns in one aggregate. For larger groups the wanted
ranks are located by rounds of histograms: each round splits only the ranges that hold a wanted rank and keeps the bin that
holds it, narrowed to the least and greatest value found in that bin. A range that is one value, or small, is finished.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.operators.ordered import ROWS, heavy_keys, is_same, split_by_keys

BINS = 1024


def percentiles(
    df: DataFrame, keys: Sequence[str], wanted: Mapping[str, Mapping[str, float]], count: str | None = None, most: int = ROWS,
    feed: DataFrame | None = None,
) -> DataFrame:
    """One row per group with the interpolated percentiles ``wanted`` = {column: {name: share}}, exact for groups of any size.

    ``count``: how often a row counts (default once). NULL values don't count; a group without values has NULLs. ``most``
    rows of a group are held by one task; ``feed``: see :func:`heavy_keys`.
    """
    keys = list(keys)
    heavy = heavy_keys(df, keys, most, feed)
    plain = [
        F.percentile(F.col(c).cast("double"), F.lit(float(p)), *([F.col(count).cast("long")] if count else [])).alias(name)
        for c, names in wanted.items() for name, p in names.items()
    ]
    if not heavy:
        return df.groupBy(*keys).agg(*plain)
    hot, cold = split_by_keys(df, keys, heavy) if keys else (df, None)
    rows = []
    found = [_select(hot, keys, c, names, count, most) for c, names in wanted.items()]
    for r in heavy:
        group = tuple(r[k] for k in keys)
        rows.append((*group, *[values.get((group, name)) for values, names in zip(found, wanted.values()) for name in names]))
    names = [name for of in wanted.values() for name in of]
    fields = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), *(f"`{n}` double" for n in names)])
    large = df.sparkSession.createDataFrame(rows, fields)
    return large if cold is None else cold.groupBy(*keys).agg(*plain).unionByName(large)


@dataclass(frozen=True)
class Target:
    """The range that holds a wanted rank of a group: values from ``low`` to ``high``, ``before`` rows below, ``inside`` rows in it."""

    group: tuple
    rank: int
    low: float
    high: float
    before: int
    inside: int


def _scaled(v: Column) -> Column:
    """A monotone scale on which values of very different size are apart: linear near 0, logarithmic beyond."""
    return F.signum(v) * F.log1p(F.abs(v))


def _select(hot: DataFrame, keys: list[str], column: str, names: Mapping[str, float], count: str | None, most: int) -> dict[tuple, float]:
    """Percentiles by (group, name). What comes to the driver is a row for each group and wanted rank."""
    weight = F.col(count).cast("long") if count else F.lit(1).cast("long")
    values = hot.select(*keys, F.col(column).cast("double").alias("_v"), weight.alias("_w")).where(F.col("_v").isNotNull() & (F.col("_w") > 0))
    spans = values.groupBy(*keys).agg(F.sum("_w").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")).collect()
    at = {}
    targets = []
    for s in spans:
        group = tuple(s[k] for k in keys)
        ranks = set()
        for name, p in names.items():
            position = (s["n"] - 1) * float(p)
            at[group, name] = (math.floor(position), math.ceil(position), position - math.floor(position))
            ranks |= {math.floor(position), math.ceil(position)}
        targets += [Target(group, r, s["low"], s["high"], 0, s["n"]) for r in sorted(ranks)]
    done: dict[tuple, float] = {}
    scaled = True
    while targets:
        done |= {(t.group, t.rank): t.low for t in targets if t.low == t.high}
        targets = [t for t in targets if t.low < t.high]
        small = [t for t in targets if t.inside <= most]
        if small:
            done |= _finish(values, keys, small)
        targets = [t for t in targets if t.inside > most]
        if targets:
            targets = _split(values, keys, targets, scaled)
            scaled = not scaled
    out = {}
    for (group, name), (low, high, share) in at.items():
        below, above = done[group, low], done[group, high]
        out[group, name] = below + (above - below) * share
    return out


def _inside(values: DataFrame, keys: list[str], targets: Sequence[Target]) -> DataFrame:
    """Rows of the targets' ranges, once for each target that has them in range. Targets are a few rows."""
    fields = ", ".join([*(f"`{k}` {values.schema[k].dataType.simpleString()}" for k in keys), "_t int, _low double, _high double, _rank long, _before long"])
    table = values.sparkSession.createDataFrame([(*t.group, i, t.low, t.high, t.rank, t.before) for i, t in enumerate(targets)], fields)
    on = is_same(keys, "v", "t") & F.col("_v").between(F.col("_low"), F.col("_high"))
    return values.alias("v").join(F.broadcast(table).alias("t"), on).select("_t", "_v", "_w", "_low", "_high", "_rank", "_before")


def _split(values: DataFrame, keys: list[str], targets: Sequence[Target], scaled: bool) -> list[Target]:
    """Every target narrowed to the bin of its range that holds its rank.

    The least and the greatest value are in different bins, so a range of two values on gets smaller in every round. Ranges
    whose ends the logarithmic scale can't tell apart, and every second round, are split evenly.
    """
    v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    even = (v / 2 - low / 2) / (high / 2 - low / 2)
    share = even
    if scaled:
        width = _scaled(high) - _scaled(low)
        share = F.when(width > 1e-9, (_scaled(v) - _scaled(low)) / width).otherwise(even)
    number = F.when(v == low, 0).when(v == high, BINS - 1).otherwise(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(share * BINS)))).cast("int")
    bins = _inside(values, keys, targets).groupBy("_t", "_rank", "_before", number.alias("_bin")).agg(
        F.sum("_w").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    upto = F.sum("_n").over(Window.partitionBy("_t").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.col("_before") + upto
    held = bins.withColumns({"_end": end, "_start": end - F.col("_n")}).where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end")))
    return [
        replace(targets[r["_t"]], low=r["_least"], high=r["_most"], before=r["_start"], inside=r["_n"])
        for r in held.select("_t", "_least", "_most", "_start", "_n").collect()
    ]


def _finish(values: DataFrame, keys: list[str], targets: Sequence[Target]) -> dict[tuple, float]:
    """The values at the targets' ranks, from ranges that a task can sort."""
    counted = _inside(values, keys, targets).groupBy("_t", "_rank", "_before", "_v").agg(F.sum("_w").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_t").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.col("_before") + upto
    held = counted.withColumn("_end", end).where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
    return {(targets[r["_t"]].group, targets[r["_t"]].rank): r["_v"] for r in held.select("_t", "_v").collect()}
