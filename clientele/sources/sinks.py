"""Writers: unload, export, rebuild, validated publish, partition-wise upsert, sorted and narrow copies."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clientele.functions.text import readable
from clientele.operators import cdc
from clientele.session import written


class ValidationFailed(Exception):
    """A staged load did not pass its checks and was not published."""


def unload_parquet(df: DataFrame, path: str) -> None:
    """Column names travel in the files."""
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a heading line of readable names; one file per task, each with its heading."""
    readable(df).write.mode("overwrite").option("header", True).csv(path)


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Drop and rebuild a table; returns it as written."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_validated(
    df: DataFrame, name: str, key: str, required: Sequence[str], expected_rows: int, tolerance: float = 0.25
) -> dict[str, int]:
    """Write a new version of the table ``name``, check the written rows, and only then let the view ``name`` show it.

    The version is a managed table of its own. Row count and NULLs are observed while it is written; only the uniqueness of
    the key reads it again, one column. A failed load, or a crash at any time, leaves the view as it was. The view keeps the
    names of its version and of the one before, which stays for a roll-back; older ones are dropped. Read with
    :func:`read_published`.
    """
    spark = df.sparkSession
    version = f"{name}_{uuid.uuid4().hex[:12]}"
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]]
    df.observe(seen, *counted).write.saveAsTable(version)
    found = {**seen.get, "repeated_keys": repeated_keys(spark.table(version), key).first()["repeated_keys"]}
    low, high = expected_rows * (1 - tolerance), expected_rows * (1 + tolerance)
    problems = []
    if not low <= found["total_rows"] <= high:
        problems.append(f"{found['total_rows']} rows, expected {low:.0f} to {high:.0f}")
    problems += [f"{found[f'null_{c}']} rows without {c}" for c in required if found[f"null_{c}"]]
    if found["repeated_keys"]:
        problems.append(f"{found['repeated_keys']} repeated values of {key}")
    if problems:
        spark.sql(f"DROP TABLE {version}")
        raise ValidationFailed("; ".join(problems))
    before = _published(spark, name)
    _show(spark, name, [version, *before[:1]])
    for old in before[1:]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return found


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many values of ``key`` occur more than once."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.count_if(F.col("_n") > 1).alias("repeated_keys"))


def read_published(spark: SparkSession, name: str, back: int = 0) -> DataFrame:
    """The current version of a published table, or the one ``back`` versions before."""
    return spark.table(_published(spark, name)[back])


def _published(spark: SparkSession, name: str) -> list[str]:
    """Version tables of a view, the current one first; none before the first publish."""
    if not spark.catalog.tableExists(name):
        return []
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('versions')").first()["value"].split()


def _show(spark: SparkSession, name: str, versions: Sequence[str]) -> None:
    """One catalogue change makes the first of the versions current."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('versions' = '{' '.join(versions)}') AS SELECT * FROM {versions[0]}")


def write_partitioned(
    df: DataFrame, path: str, partition: str, mode: str = "error", sort_by: Sequence[str] = (), more: Sequence[str] = ()
) -> None:
    """Write one folder per value of ``partition`` (and of the columns ``more`` below it); overwriting replaces only the folders that get rows.

    Rows are rebalanced by the partition value: small ones end up in one file, and one that holds a large part of the
    table is split over many tasks. ``sort_by`` orders the rows inside the files, so scans can skip row groups.
    """
    folders = [partition, *more]
    balanced = df.hint("rebalance", *[F.col(c) for c in folders]).sortWithinPartitions(*folders, *sort_by)
    balanced.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def create_partitioned(df: DataFrame, name: str, partition: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """A managed table with one folder per value of ``partition``, written as by :func:`write_partitioned`."""
    balanced = df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *sort_by)
    balanced.write.partitionBy(partition).saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time of a write that takes it from nowhere else."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def overwrite_partitions(df: DataFrame, name: str, partition: str, touched: DataFrame | None = None) -> None:
    """Replace the partitions of the table ``name`` that occur in ``df``, and drop those that occur only in ``touched``.

    ``df`` may read from the table itself: it is written to a staging place first. Emptied partitions are dropped through the
    catalogue; only their values, one for each folder, come to the driver. A run that died anywhere is repaired by running it
    again: the staged rows and the emptied partitions come out the same.
    """
    spark = df.sparkSession
    staged = written(df, "partitions")
    emptied = []
    if touched is not None:
        has = staged.select(F.col(partition).alias("_has")).distinct()
        emptied = touched.select(F.col(partition).alias("_v")).distinct().join(has, F.col("_v").eqNullSafe(F.col("_has")), "left_anti").select(
            F.col("_v").cast("string").alias("v")
        ).collect()
    columns = spark.table(name).columns
    balanced = staged.hint("rebalance", F.col(partition)).select(*columns).sortWithinPartitions(partition)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        balanced.write.mode("overwrite").insertInto(name)
    for row in emptied:
        value = "NULL" if row.v is None else "'" + row.v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{partition}` = {value})")


def upsert_table(
    spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], partition: str,
    action: str | None = None,
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions the batch touches.

    With ``action``, rows whose latest change is a DELETE go; a partition that loses all its rows is dropped.

    The partition of a key must not change between versions of its row. The semi join on the partition column lets
    Spark prune the read of the table to the touched partitions.
    """
    target = spark.table(name)
    touched = batch.select(partition).distinct()
    affected = target.join(touched, partition, "left_semi")
    overwrite_partitions(cdc.upsert(affected, batch, keys, order_by, action=action), name, partition, touched=touched)


def above_watermark(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows newer than everything in the target. The bound is read first, so it prunes the source scan."""
    bound = target.agg(F.max(column)).first()[0]
    return source if bound is None else source.where(F.col(column) > F.lit(str(bound)).cast(source.schema[column].dataType))


def sorted_copy(df: DataFrame, path: str, by: Sequence[str], files: int | None = None) -> DataFrame:
    """Copy in global order of ``by``: files and row groups get narrow, disjoint ranges that scans can skip.

    Range bounds on all of ``by`` split a hot leading value over several files when a second column follows it.
    """
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed_copy(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """A managed copy dealt into ``buckets`` by a hash of ``by`` and sorted in them. Joins and groupings of such copies by that
    column need no shuffle, however often they run; both sides must have the same number of buckets.

    Rows are dealt once before they are written, so there is one file per bucket and not one per bucket and task.
    """
    df.repartition(buckets, F.col(by)).write.bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return df.sparkSession.table(name)


def narrow_copy(df: DataFrame, path: str, columns: Sequence[str], by: str, bloom: bool = True) -> DataFrame:
    """Few columns in the order of a lookup key, with bloom filters on it, for point lookups."""
    key: Column = F.col(by)
    writer = df.select(*columns).repartitionByRange(key, *[c for c in columns if c != by]).sortWithinPartitions(key).write
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{by}", "true")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
