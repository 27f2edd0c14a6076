"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shuffle_parts(input_bytes: int, target_bytes: int = 128 << 20, least: int = 200) -> int:
    """Shuffle partitions to start from, so that one holds about ``target_bytes`` even if all of the input is shuffled."""
    return max(least, -(-input_bytes // target_bytes))


def build_session(app: str = "clientele", master: str | None = None, input_bytes: int | None = None, **confs: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    Adaptive execution coalesces small partitions and splits skewed join partitions at run time, but never makes more
    than it starts from. ``input_bytes``, the size of the tables read, sets that number; without it Spark's default holds.
    """
    if input_bytes is not None:
        confs = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts(input_bytes)), **confs}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # No capture of the Python call site for every column expression; halves the time to build a wide plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **confs}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) falls back to a temporary folder, which is then recorded in the
    session so that later calls agree.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="clientele-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or overwritten there."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def database(spark: SparkSession) -> str:
    """Name of the database for managed tables, which lies in the shared folder; made when it is first asked for.

    Dropping a table or a partition there removes its files.
    """
    name = "clientele_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId).lower()
    place = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/tables"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")
    return name


def fresh_table(spark: SparkSession, name: str) -> str:
    """A table name in :func:`database` that was never used."""
    return f"{database(spark)}.{name}_{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` as a table written to the shared folder: evaluated once, and what is read back doesn't depend on the plan."""
    place = scratch(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def checkpointed(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
