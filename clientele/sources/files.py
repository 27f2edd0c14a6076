"""Readers: positional CSV, named parquet, load-once, fixed-width text, semi-structured columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for NULL in delimited files.
NULL_TEXTS = ("NULL", "null", "")


def lineage(df: DataFrame, row_number: bool = False) -> DataFrame:
    """Add the file a row came from and, if asked, its number within the file.

    Rows are numbered by block of the file and position within the task, so a large splittable file is not pulled into
    one task: block counts are added up first, and only one block is numbered together.
    """
    meta = F.col("_metadata")
    out = df.withColumn("source_file", meta["file_path"])
    if not row_number:
        return out
    return out.withColumns({"_block": meta["file_block_start"], "_at": F.monotonically_increasing_id()})


def number_rows(df: DataFrame, name: str = "file_row_number") -> DataFrame:
    """Turn the block position of :func:`lineage` into a row number per file."""
    from pyspark.sql import Window

    counts = df.groupBy("source_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    local = F.row_number().over(Window.partitionBy("source_file", "_block").orderBy("_at"))
    return df.withColumn("_local", local).join(offsets, ["source_file", "_block"]).withColumn(
        name, F.col("_before") + F.col("_local")
    ).drop("_block", "_at", "_local", "_before")


def null_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and replace the NULL texts."""
    return df.withColumns({
        c: F.when(F.trim(c).isin(*NULL_TEXTS), F.lit(None)).otherwise(F.trim(c)) for c in columns
    })


def read_csv_positional(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, strict: bool = True,
    row_number: bool = False, malformed: str | None = None,
) -> DataFrame:
    """Delimited text with a header, read by position and cast to ``schema``.

    Columns are read as text first, because NULL texts would otherwise fail the cast. Short rows are filled with NULL
    and surplus fields dropped; ``malformed`` names a column that keeps the original line of such rows. ``strict`` makes a bad
    value an error; otherwise it becomes NULL.
    """
    names = [f.name for f in schema.fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([malformed] if malformed else [])]])
    reader = _csv(spark, text, "PERMISSIVE", malformed)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    raw = null_texts(lineage(reader.csv(path).select("*", "_metadata"), row_number).drop("_metadata"), names)
    casts = {
        f.name: F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType) for f in schema.fields
    }
    typed = raw.withColumns(casts)
    return number_rows(typed) if row_number else typed


def _csv(spark: SparkSession, schema: T.StructType, mode: str, corrupt: str | None = None):
    """A CSV reader that looks at all fields of a line, whichever columns are asked for: whether a line is malformed must not
    depend on them."""
    reader = spark.read.schema(schema).option("header", True).option("quote", '"').option("mode", mode).option("enforceSchema", True)
    reader = reader.option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", corrupt) if corrupt else reader


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType, rejected: str = "rejected", header: bool = True) -> DataFrame:
    """Delimited text, one record a line; a line that doesn't fit keeps its original text in ``rejected``.

    A line doesn't fit if a value isn't of its type, if it has too few or too many fields, or if a quote stays open (which
    the parser itself takes for a value). Its readable fields are filled, the others NULL. Lines equal to the header of the
    files are no records.
    """
    lines = spark.read.text(path)
    if header:
        first = lines.first()
        lines = lines.where(F.col("value") != F.lit(first[0])) if first else lines
    fields = T.StructType([*schema.fields, T.StructField(rejected, T.StringType())])
    parsed = F.from_csv("value", fields.simpleString()[len("struct<") : -1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rejected})
    quotes = F.replace(F.col("value"), F.lit('\\"'), F.lit(""))
    is_open = (F.length(quotes) - F.length(F.replace(quotes, F.lit('"'), F.lit("")))) % 2 == 1
    rows = lines.select("value", parsed.alias("_r"))
    bad = F.col(f"_r.{rejected}").isNotNull() | is_open
    return rows.select(*[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields], F.when(bad, F.col("value")).alias(rejected))


#: Error condition of the reader for a line that doesn't fit.
MALFORMED = "MALFORMED_RECORD_IN_PARSING"


def load_or_abort(spark: SparkSession, path: str, schema: T.StructType, target: str) -> DataFrame | None:
    """Delimited text written to ``target`` as Parquet, or None if a line doesn't fit: then nothing is kept.

    Only the reader's own error for such a line counts as an aborted load. All others, such as a lost executor or a full disk,
    are raised.
    """
    try:
        _csv(spark, schema, "FAILFAST").csv(path).write.parquet(target)
    except (PySparkException, Py4JJavaError) as error:
        if MALFORMED not in str(error):
            raise
        return None
    return spark.read.schema(schema).parquet(target)


def read_parquet_named(spark: SparkSession, path: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Parquet by column name: ``columns`` maps the new name to (source name, type)."""
    df = spark.read.parquet(path)
    return df.select(
        *[F.col(source).cast(kind).alias(name) for name, (source, kind) in columns.items()],
        F.col("_metadata.file_name").alias("source_file"),
    )


def load_once(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str, pattern: str,
    fmt: str = "parquet", files_per_batch: int = 10_000,
) -> None:
    """Append the files that were not loaded before.

    The checkpoint of a file stream remembers every processed file, so a second call over the same files reads
    nothing, and a call that died half-way resumes its own batch. A large backlog is taken in several batches.
    """
    stream = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", pattern).option(
        "maxFilesPerTrigger", files_per_batch
    ).load(path)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    )
    query.awaitTermination()


@dataclass(frozen=True)
class FixedField:
    """A field at ``start`` (from 1) with ``length``; other positions for other record types in ``by_type``."""

    name: str
    start: int
    length: int
    by_type: Mapping[str, tuple[int, int]] | None = None


RECORD_TYPE = FixedField("rec_type", 23, 3)
# Layout of the company / financial / security feed.
FEED_LAYOUT = (
    FixedField("pts", 8, 15),
    RECORD_TYPE,
    FixedField("company_name", 26, 60),
    FixedField("cik", 86, 10),
    FixedField("status", 47, 4, {"CMP": (96, 4)}),
    FixedField("industry_id", 100, 2),
    FixedField("sp_rating", 102, 4),
    FixedField("founding_date", 106, 8),
    FixedField("addr_line1", 114, 80),
    FixedField("addr_line2", 194, 80),
    FixedField("postal_code", 274, 12),
    FixedField("city", 286, 25),
    FixedField("state_province", 311, 20),
    FixedField("country", 331, 24),
    FixedField("ceo_name", 355, 46),
    FixedField("description", 401, 150),
    FixedField("year", 8, 4),
    FixedField("quarter", 30, 1),
    FixedField("qtr_start_date", 31, 8),
    FixedField("posting_date", 39, 8),
    FixedField("revenue", 47, 17),
    FixedField("earnings", 64, 17),
    FixedField("eps", 81, 12),
    FixedField("diluted_eps", 93, 12),
    FixedField("margin", 105, 12),
    FixedField("inventory", 117, 17),
    FixedField("assets", 134, 17),
    FixedField("liabilities", 151, 17),
    FixedField("sh_out", 127, 13, {"FIN": (168, 13)}),
    FixedField("diluted_sh_out", 181, 13),
    FixedField("co_name_or_cik", 168, 10, {"FIN": (194, 10)}),
    FixedField("symbol", 26, 15),
    FixedField("issue_type", 41, 6),
    FixedField("name", 51, 70),
    FixedField("ex_id", 121, 6),
    FixedField("first_trade_date", 140, 8),
    FixedField("first_trade_exchg", 148, 8),
    FixedField("dividend", 156, 12),
)


def cut(line: str, layout: Sequence[FixedField] = FEED_LAYOUT) -> list[Column]:
    """Substring columns of a fixed-width line."""
    kind = F.substring(line, RECORD_TYPE.start, RECORD_TYPE.length)
    out = []
    for f in layout:
        c = F.substring(line, f.start, f.length)
        for record, (start, length) in (f.by_type or {}).items():
            c = F.when(kind == record, F.substring(line, start, length)).otherwise(c)
        out.append(F.rtrim(c).alias(f.name))
    return out


def read_fixed_width(spark: SparkSession, path: str, layout: Sequence[FixedField] = FEED_LAYOUT) -> DataFrame:
    return spark.read.text(path).select(*cut("value", layout))


def split_records(feed: DataFrame) -> dict[str, DataFrame]:
    """The three record types of the feed as typed tables."""
    stamp = F.try_to_timestamp("pts", F.lit("yyyyMMdd-HHmmss")).cast("timestamp_ntz").alias("pts")

    def day(c: str) -> Column:
        return F.expr(f"try_to_date({c}, 'yyyyMMdd')").alias(c)

    def number(c: str, precision: int, scale: int) -> Column:
        return F.nullif(F.trim(c), F.lit("")).cast(T.DecimalType(precision, scale)).alias(c)

    company = feed.where(F.col("rec_type") == "CMP").select(
        stamp, "rec_type", "company_name", "cik", "status", "industry_id", "sp_rating", day("founding_date"), "addr_line1",
        "addr_line2", "postal_code", "city", "state_province", "country", "ceo_name", "description",
    )
    financial = feed.where(F.col("rec_type") == "FIN").select(
        stamp, "rec_type", number("year", 4, 0), number("quarter", 1, 0), day("qtr_start_date"), day("posting_date"),
        *[number(c, 15, 2) for c in ("revenue", "earnings")], *[number(c, 10, 2) for c in ("eps", "diluted_eps", "margin")],
        *[number(c, 15, 2) for c in ("inventory", "assets", "liabilities")], number("sh_out", 13, 0),
        number("diluted_sh_out", 13, 0), "co_name_or_cik",
    )
    security = feed.where(F.col("rec_type") == "SEC").select(
        stamp, "rec_type", "symbol", "issue_type", "status", "name", "ex_id", number("sh_out", 13, 0), day("first_trade_date"),
        day("first_trade_exchg"), number("dividend", 10, 2), "co_name_or_cik",
    )
    return {"CMP": company, "FIN": financial, "SEC": security}


def variant_column(df: DataFrame, name: str = "data") -> DataFrame:
    """Every row as one semi-structured value."""
    return df.select(F.parse_json(F.to_json(F.struct("*"))).alias(name))


def variant_paths(df: DataFrame, paths: Mapping[str, tuple[str, str]], column: str = "data") -> DataFrame:
    """Columns from paths of a semi-structured column: name -> (path, type)."""
    return df.select(*[F.variant_get(column, p, kind).alias(n) for n, (p, kind) in paths.items()])
