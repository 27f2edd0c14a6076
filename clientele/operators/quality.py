"""Data-quality checks. Every check returns the offending rows; an empty result is a pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.dates import at_time
from clientele.operators.ordered import neighbour
from clientele.operators.setops import except_both, group_counts


def _expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


# ---- single-column checks ----


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the range; NULL passes."""
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.where(bad)


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Forbidden values that occur."""
    return df.select(F.col(column).alias("value_field")).where(F.col("value_field").isin(*values)).distinct()


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row counts; NULL passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value_field")).agg(
        F.count(F.lit(1)).alias("n_records")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL passes."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def at_least_one(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Groups without a single non-NULL value."""
    return df.groupBy(*keys).agg(F.count(column).alias("filled")).where(F.col("filled") == 0)


def not_constant(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value. Min and max decide that without a distinct shuffle."""
    low, high = F.min(column).alias("_low"), F.max(column).alias("_high")
    return df.groupBy(*keys).agg(low, high).where(F.col("_low") == F.col("_high")).select(*keys, F.lit(1).alias("distinct_values"))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    return df.where((F.trim(column) if trim else F.col(column)) == "")


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0, keys: Sequence[str] = ()) -> DataFrame:
    share = F.count(column).cast("double") / F.count(F.lit(1)).cast("double")
    p = F.col("not_null_proportion")
    return df.groupBy(*keys).agg(share.alias("not_null_proportion")).where((p < at_least) | (p > at_most))


def expression_is_true(df: DataFrame, expression) -> DataFrame:
    """Rows where the expression is false; NULL passes."""
    return df.where(~_expr(expression))


# ---- checks between relations ----


def relationships_where(
    child: DataFrame, column: str, parent: DataFrame, field: str, child_where="true", parent_where="true"
) -> DataFrame:
    """Child keys without a parent, both sides filtered. Keys are counted first, so a frequent orphan is one row."""
    keys = child.where(_expr(child_where) & F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    known = parent.where(_expr(parent_where)).select(F.col(field).alias("id"))
    return keys.join(known, "id", "left_anti")


def equality(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return except_both(a, b, columns)


def equal_rowcount(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Row counts of both sides with their absolute difference; the failure measure is the sum of the differences."""
    return group_counts(a, b, keys).withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """0 where ``a`` has fewer rows, 1 where both are equal, the surplus where ``a`` has more."""
    more, same = F.col("count_a") > F.col("count_b"), F.col("count_a") == F.col("count_b")
    delta = F.when(more, F.col("count_a") - F.col("count_b")).when(same, 1).otherwise(0)
    return group_counts(a, b, keys).withColumn("row_count_delta", delta)


# ---- ordered checks ----


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, keys: Sequence[str], gaps: str = "allowed", zero_length: bool = False,
) -> DataFrame:
    """Ranges that end before they start, or overlap the next range, or break the gap rule.

    The last range of a group has no successor. Bounds that are NULL fail.
    """
    rules = {
        "allowed": lambda u, nxt: u <= nxt, "not_allowed": lambda u, nxt: u == nxt, "required": lambda u, nxt: u < nxt,
    }
    if gaps not in rules:
        raise ValueError(f"gaps must be one of {sorted(rules)}, got {gaps!r}")
    ordered = neighbour(df, keys, lower, "next_lower_bound")
    low, high, nxt = F.col(lower), F.col(upper), F.col("next_lower_bound")
    proper = F.coalesce(low <= high if zero_length else low < high, F.lit(False))
    apart = F.coalesce(F.when(nxt.isNull(), True).otherwise(rules[gaps](high, nxt)), F.lit(False))
    return ordered.where(~(proper & apart))


def sequential_values(df: DataFrame, column: str, keys: Sequence[str], step) -> DataFrame:
    """Rows whose value is not the previous value of the group plus ``step`` (a number or an interval column)."""
    ordered = neighbour(df, keys, column, "previous_value", ahead=False)
    following = F.col("previous_value") + (step if isinstance(step, Column) else F.lit(step))
    return ordered.where(F.col("previous_value").isNotNull() & (F.col(column) != following))


def recency(df: DataFrame, column: str, as_of, keys: Sequence[str] = (), **interval: int) -> DataFrame:
    """Groups whose latest value is older than ``as_of`` minus the interval (days=, hours=)."""
    oldest = as_of - dt.timedelta(**interval)
    threshold = at_time(oldest) if isinstance(oldest, dt.datetime) else F.lit(oldest)
    return df.groupBy(*keys).agg(F.max(column).alias("most_recent")).where(F.col("most_recent") < threshold).withColumn(
        "threshold", threshold
    )


def scd_one_current(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys that do not have exactly one current version."""
    return dim.groupBy(key).agg(
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("current_count"), F.count(F.lit(1)).alias("total_versions")
    ).where(F.col("current_count") != 1)


def scd_gaps(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Versions whose end is not the day before the next version starts.

    The next start is found over all versions and closed versions are tested afterwards, so the step into the current
    version is tested too.
    """
    ordered = neighbour(dim.select(key, "valid_from", "valid_to"), [key], "valid_from", "next_valid_from")
    closed = F.col("next_valid_from").isNotNull() & (F.col("valid_to") != F.date_sub("next_valid_from", 1))
    return ordered.where(closed).withColumn("gap_days", F.datediff("next_valid_from", "valid_to") - 1)


def segment_min_share(segments: DataFrame, least: float = 5.0) -> DataFrame:
    """Segments with less than ``least`` percent of the customers."""
    from clientele.operators.windows import share_of_total

    counts = segments.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customer_count"))
    return share_of_total(counts, "customer_count", "percentage").where(F.col("percentage") < least)
