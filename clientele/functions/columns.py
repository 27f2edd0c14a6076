"""Keys, guarded arithmetic, buckets, lookups and money helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: marker that stands for NULL inside a surrogate key.
NULL_KEY_MARKER = "_dbt_utils_surrogate_key_null_"

MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(28, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols, null_as_empty: bool = False) -> Column:
    """md5 over the dash-joined text of ``cols``; NULLs get a marker so that they still tell rows apart."""
    filler = F.lit("" if null_as_empty else NULL_KEY_MARKER)
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), filler) for c in cols]))


def safe_add(*cols) -> Column:
    total = F.coalesce(_col(cols[0]), F.lit(0))
    for c in cols[1:]:
        total = total + F.coalesce(_col(c), F.lit(0))
    return total


def safe_subtract(*cols) -> Column:
    total = F.coalesce(_col(cols[0]), F.lit(0))
    for c in cols[1:]:
        total = total - F.coalesce(_col(c), F.lit(0))
    return total


def safe_divide(numerator, denominator) -> Column:
    """NULL instead of an error when the denominator is 0."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def width_bucket(value, low, high, buckets: int) -> Column:
    """Equal-width bucket number; 0 below ``low``, ``buckets`` + 1 at or above ``high``."""
    return F.width_bucket(_col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance."""
    scale = {"mi": 1.0, "km": 1.60934}.get(unit)
    if scale is None:
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    chord = F.pow(half_lat, 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(half_lon, 2)
    return F.lit(2 * 3961) * F.asin(F.sqrt(chord)) * F.lit(scale)


def lookup(value, mapping: Mapping, default=None) -> Column:
    """CASE over a small fixed mapping."""
    out = None
    for key, result in mapping.items():
        hit = _col(value) == F.lit(key)
        out = F.when(hit, F.lit(result)) if out is None else out.when(hit, F.lit(result))
    return out.otherwise(F.lit(default)) if default is not None else out


def banded(value, bands: Iterable[tuple], default, op: str = "lt") -> Column:
    """First matching label from ``bands`` = [(bound, label), ...]; ``op`` is lt, le or ge."""
    compare = {"lt": lambda v, b: v < b, "le": lambda v, b: v <= b, "ge": lambda v, b: v >= b}[op]
    value, out = _col(value), None
    for bound, label in bands:
        hit = compare(value, F.lit(bound))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def mean(c) -> Column:
    """Exact sum over count, as double; NULL for no rows."""
    return F.sum(_col(c)).cast("double") / F.nullif(F.count(_col(c)), F.lit(0)).cast("double")


def money_mean(c) -> Column:
    """Mean of two-decimal amounts held as double, again independent of the order of the rows."""
    return mean(_col(c).cast(MONEY_TOTAL))


def stable_mean(c) -> Column:
    """Mean of doubles that does not depend on the order of the rows: summed as decimals with ten digits."""
    return mean(_col(c).cast(T.DecimalType(38, 10)))


def pct(part, whole, digits: int = 2) -> Column:
    """Share in percent, rounded; NULL when ``whole`` is 0."""
    return F.round(safe_divide(_col(part).cast("double") * 100, _col(whole).cast("double")), digits)


def flag_count(condition: Column) -> Column:
    return F.count_if(condition)


def slugify(text: str) -> str:
    """Lower-case identifier: blanks and dashes to underscores, other signs dropped, leading digit prefixed."""
    text = re.sub(r"[ -]+", "_", text.lower())
    text = re.sub(r"[^a-z0-9_]+", "", text)
    return f"_{text}" if text[:1].isdigit() else text


def plain_types(df: DataFrame) -> DataFrame:
    """Report types: every integer as bigint, every decimal and float as double."""
    wide = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            wide.append(F.col(f"`{field.name}`").cast("bigint").alias(field.name))
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            wide.append(F.col(f"`{field.name}`").cast("double").alias(field.name))
        else:
            wide.append(F.col(f"`{field.name}`"))
    return df.select(*wide)
