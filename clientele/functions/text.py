"""URL parts, readable headings, unit formatting and value formatting for exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import _col, lookup

# Words that a heading spells out.
HEADING_WORDS = {
    "id": "Id",
    "ltv": "Lifetime Value",
    "clv": "Customer Lifetime Value",
    "roi": "Return On Investment",
    "roas": "Return On Ad Spend",
    "aov": "Average Order Value",
    "avg": "Average",
    "min": "Minimum",
    "max": "Maximum",
    "std": "Standard Deviation",
    "pct": "Percent",
    "cvr": "Conversion Rate",
    "ctr": "Click Through Rate",
    "num": "Number",
    "qty": "Quantity",
}
# Parts of a column name that mark percentages and money.
PERCENT_MARKS = ("_pct", "_percent", "risk_score", "rate", "ratio")
MONEY_MARKS = (
    "amount", "value", "ltv", "clv", "spend", "spent", "revenue", "cost", "price", "pricing", "limit", "credit",
    "paid", "payment", "balance", "total", "sum",
)
COUNT_MARKS = ("count", "num_")
# Hourly credits per warehouse size.
CREDITS_PER_HOUR = {
    "X-SMALL": 1.0, "SMALL": 2.0, "MEDIUM": 4.0, "LARGE": 8.0, "X-LARGE": 16.0,
    "2X-LARGE": 32.0, "3X-LARGE": 64.0, "4X-LARGE": 128.0, "5X-LARGE": 256.0, "6X-LARGE": 512.0,
}


def url_host(url) -> Column:
    """Host without scheme; cut at the first '/' and then at the first '?'."""
    bare = _col(url)
    for scheme in ("android-app://", "http://", "https://"):
        bare = F.replace(bare, F.lit(scheme), F.lit(""))
    return F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url) -> Column:
    """Text after the first '/' (or from the '?' on when there is no slash) up to the '?'."""
    bare = _col(url)
    for scheme in ("http://", "https://"):
        bare = F.replace(bare, F.lit(scheme), F.lit(""))
    cut = F.coalesce(F.nullif(F.position(F.lit("/"), bare), F.lit(0)), F.position(F.lit("?"), bare) - 1)
    return F.split_part(F.substring(bare, cut + 1, F.length(bare)), F.lit("?"), F.lit(1))


def url_parameter(url, name: str) -> Column:
    """Value of a query parameter, NULL when absent or empty."""
    after = F.split_part(_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))


def format_bytes(c) -> Column:
    """Whole units of the largest unit that the number strictly exceeds."""
    c = _col(c).cast("double")
    out = None
    for power, unit in ((4, "TB"), (3, "GB"), (2, "MB"), (1, "KB")):
        size = float(1024**power)
        shown = F.concat((c / size).cast("bigint").cast("string"), F.lit(unit))
        out = F.when(c > size, shown) if out is None else out.when(c > size, shown)
    return out.otherwise(c.cast("bigint").cast("string"))


def format_count(c) -> Column:
    """One decimal with K, Million, Billion or Trillion."""
    c = _col(c)
    out = None
    for power, unit in ((12, " Trillion"), (9, " Billion"), (6, " Million"), (3, " K")):
        size = 10**power
        shown = F.concat(F.format_string("%.1f", F.round(c.cast("double") / size, 1)), F.lit(unit))
        out = F.when(c >= size, shown) if out is None else out.when(c >= size, shown)
    return out.otherwise(c.cast("string"))


def format_millis(c) -> Column:
    """Elapsed time as h m s, dropping leading zero parts; plain milliseconds below one second."""
    c = _col(c).cast("double")
    seconds = F.floor(c / 1000)
    hours = F.floor(seconds / 3600)
    minutes = F.floor((seconds - hours * 3600) / 60)
    rest = seconds - hours * 3600 - minutes * 60
    return (
        F.when(hours > 0, F.concat(hours, F.lit("h "), minutes, F.lit("m "), rest, F.lit("s")))
        .when(minutes > 0, F.concat(minutes, F.lit("m "), rest, F.lit("s")))
        .when(seconds > 0, F.concat(seconds, F.lit("s")))
        .otherwise(F.concat(c.cast("bigint"), F.lit("ms")))
    )


def credits_per_hour(size) -> Column:
    return lookup(F.upper(_col(size)), CREDITS_PER_HOUR, 0.0)


def heading(name: str) -> str:
    """customer_id -> 'Customer Id', avg_ltv -> 'Average Lifetime Value'."""
    return " ".join(HEADING_WORDS.get(w, w.capitalize()) for w in name.lower().replace("_", " ").split())


def readable(df: DataFrame) -> DataFrame:
    """Format values by column-name pattern and rename every column to its heading."""
    shown = []
    for field in df.schema.fields:
        name, c = field.name.lower(), F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, T.NumericType)
        missing = F.lit("N/A")
        if "month" in name or "date" in name:
            if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                c = F.date_format(c, "MMM yyyy" if "month" in name else "yyyy-MM-dd")
            elif isinstance(field.dataType, T.StringType):  # dates held as text; other text stays
                c = F.coalesce(F.date_format(c.try_cast("timestamp"), "MMM yyyy" if "month" in name else "yyyy-MM-dd"), c)
        elif any(m in name for m in PERCENT_MARKS):
            if numeric:
                c = F.when(c.isNull(), missing).otherwise(F.format_string("%.1f%%", c.cast("double")))
        elif any(m in name for m in MONEY_MARKS):
            if numeric:
                amount = c.cast("double")
                c = (
                    F.when(c.isNull(), missing)
                    .when(F.abs(amount) >= 1000, F.format_string("$%,.0f", amount))
                    .otherwise(F.format_string("$%,.2f", amount))
                )
        elif any(m in name for m in COUNT_MARKS) and numeric:
            c = F.when(c.isNull(), missing).otherwise(F.format_string("%,d", c.cast("bigint")))
        shown.append(c.alias(heading(field.name)))
    return df.select(*shown)
