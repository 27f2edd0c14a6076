"""Projections: cleaning, category attributes, column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.columns import lookup

# Attributes of the merchant categories.
CATEGORY_GROUP = {
    "Travel": "Leisure", "Dining": "Leisure", "Hotels": "Leisure", "Airlines": "Leisure", "Entertainment": "Leisure",
    "Grocery": "Necessities", "Gas": "Necessities", "Utilities": "Necessities", "Healthcare": "Necessities",
    "Retail": "Retail",
}
SPENDING_TYPE = {
    "Travel": "High discretionary spending",
    "Dining": "Moderate discretionary spending",
    "Hotels": "High discretionary spending",
    "Airlines": "High discretionary spending",
    "Entertainment": "Moderate discretionary spending",
    "Grocery": "Essential spending",
    "Gas": "Essential spending",
    "Utilities": "Essential spending",
    "Healthcare": "Essential spending",
    "Retail": "Variable spending",
}
DISCRETIONARY = ("Travel", "Dining", "Hotels", "Airlines", "Entertainment", "Retail")
ESSENTIAL = ("Grocery", "Gas", "Utilities", "Healthcare")


def clean_customers(df: DataFrame) -> DataFrame:
    """Trim names and city, lower-case the email, upper-case the state."""
    return df.withColumns({
        "first_name": F.trim("first_name"),
        "last_name": F.trim("last_name"),
        "email": F.lower(F.trim("email")),
        "state": F.upper(F.trim("state")),
        "city": F.trim("city"),
    })


def clean_transactions(df: DataFrame) -> DataFrame:
    """Trim the merchant, default a missing category."""
    return df.withColumns({
        "merchant_name": F.trim("merchant_name"),
        "merchant_category": F.coalesce(F.trim("merchant_category"), F.lit("Uncategorized")),
    })


def category_attributes(name: str = "category_name") -> list:
    """Group, spending type and discretionary flag of a category column."""
    c = F.col(name)
    return [
        lookup(c, CATEGORY_GROUP, "Other").alias("category_group"),
        lookup(c, SPENDING_TYPE, "Other spending").alias("spending_type"),
        F.when(c.isin(*DISCRETIONARY), "Discretionary").when(c.isin(*ESSENTIAL), "Essential").otherwise("Other")
        .alias("discretionary_flag"),
    ]


def star(df: DataFrame, except_: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but the listed ones (any case), optionally renamed with a prefix and suffix."""
    hidden = {c.lower() for c in except_}
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in hidden])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings to NULL in every string column."""
    return df.select(*[
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
