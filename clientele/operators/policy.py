"""Masking, row policies and classification of sensitive columns. Roles are passed in, not looked up."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tag levels, masked text and the pattern that keeps only the domain of an email.
HIGH, CONFIDENTIAL = "highly_confidential", "confidential"
MASKED = "*** MASKED ***"
LOCAL_PART = r".+\@"
# Fixed value: national insurance number.
UK_TAX_ID = r"^([a-zA-Z]){2}( )?([0-9]){2}( )?([0-9]){2}( )?([0-9]){2}( )?([a-zA-Z]){1}?$"


def domain_only(c) -> Column:
    return F.regexp_replace(c, LOCAL_PART, "*****@")


def mask(column: str, roles: Collection[str]) -> Column:
    """Clear for the high role, domain only for the lower one, hidden otherwise."""
    if HIGH in roles:
        return F.col(column)
    return domain_only(F.col(column)) if CONFIDENTIAL in roles else F.lit(MASKED)


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Write tag levels into the column metadata, where they follow the column through projections."""
    return reduce(lambda d, item: d.withMetadata(item[0], {"tag": item[1]}), tags.items(), df)


def mask_by_tag(df: DataFrame, roles: Collection[str]) -> DataFrame:
    """Mask every tagged column by its level and the roles; untagged columns stay."""
    out = []
    for field in df.schema.fields:
        level, c = field.metadata.get("tag"), F.col(f"`{field.name}`")
        if level is None:
            out.append(c)
        elif level == HIGH and HIGH in roles:
            out.append(c)
        elif level == HIGH and CONFIDENTIAL in roles:
            out.append(domain_only(c.cast("string")).alias(field.name))
        elif level == CONFIDENTIAL and CONFIDENTIAL in roles:
            out.append(c)
        else:
            out.append(F.lit(MASKED).alias(field.name))
    return df.select(*out)


def row_policy(df: DataFrame, policies: Sequence[tuple[DataFrame, str, str]], roles: Collection[str]) -> DataFrame:
    """Rows allowed by every policy.

    A policy is (mapping, mapping column, data column); the mapping has a ``role`` column and allows a value when any
    of ``roles`` has it. Semi joins keep rows single even if several roles allow them.
    """
    for mapping, allowed, column in policies:
        values = mapping.where(F.col("role").isin(*roles)).select(F.col(allowed).alias(column)).distinct()
        df = df.join(values, column, "left_semi")
    return df


def classify_columns(df: DataFrame, pattern: str, name_pattern: str, category: str, threshold: float = 0.8) -> DataFrame:
    """Match rate of ``pattern`` per string column in one scan; a high rate or a telling name marks it sensitive."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = df.agg(
        *[F.count(f"`{c}`").alias(f"n_{i}") for i, c in enumerate(texts)],
        *[F.count_if(F.col(f"`{c}`").rlike(pattern)).alias(f"m_{i}") for i, c in enumerate(texts)],
    )
    lines = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("n_values"), F.col(f"m_{i}").alias("n_matches"))
        for i, c in enumerate(texts)
    ])
    rate = F.coalesce(F.col("n_matches").cast("double") / F.nullif(F.col("n_values"), F.lit(0)).cast("double"), F.lit(0.0))
    by_name = F.upper("column_name").rlike(f"^{name_pattern}$")
    return counts.select(F.inline(lines)).withColumns({"match_rate": rate, "name_match": by_name}).withColumn(
        "category", F.when((F.col("match_rate") >= threshold) | (F.col("name_match") & (F.col("n_matches") > 0)), F.lit(category))
    )
