"""Headline and price files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.numbers import real
from tidemark.operators.rows import split_pair
from tidemark.schemas import CLEAN_HEADLINE, PAIRED_HEADLINE, RAW_HEADLINE, STREAM_HEADLINE


def read_headlines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_HEADLINE,
    multi_line: bool = False,
) -> DataFrame:
    """Headline rows from JSON files, one object or one array of objects per line.

    ``multi_line`` reads arrays that are broken over lines; such a file is read by one task.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line, encoding="utf-8")


def read_clean_headlines(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", paired: bool = False
) -> DataFrame:
    """Cleaned headlines; ``paired`` files hold polarity and subjectivity in one array."""
    if not paired:
        return spark.read.schema(CLEAN_HEADLINE).format(fmt).load(path)
    rows = spark.read.schema(PAIRED_HEADLINE).format(fmt).load(path)
    split = split_pair(rows, "polarity_subjectivity", "polarity", "subjectivity")
    return split.select(*CLEAN_HEADLINE.names)


def stream_headlines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = STREAM_HEADLINE,
    max_files: int | None = None,
) -> DataFrame:
    """Headlines from JSON files as they are dropped into a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def _with_header(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All columns as text, those of folder names too: a symbol such as ``000001`` must not become a number."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    names = reader.csv(paths).columns
    return reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(paths)


def read_prices(
    spark: SparkSession,
    paths: str | list[str],
    start: date | None = None,
    end: date | None = None,
    symbol_from_path: bool = False,
) -> DataFrame:
    """Price bars from CSV files with a header, columns taken by name.

    All files must have the same header; a file that differs raises. Numbers that cannot be read, such as
    "null", are missing values; a date that cannot be read raises.

    With ``symbol_from_path`` the company is the file's name without its ending, for files that hold one
    symbol each.
    """
    raw = _with_header(spark, paths)
    company = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv(?:\.gz)?$", 1)
    bars = raw.select(
        F.col("Date").cast("date").alias("Date"),
        real(F.col("Open").try_cast("double")).alias("Open"),
        real(F.col("Volume").try_cast("double")).alias("Volume"),
        (company if symbol_from_path else F.col("Company")).alias("Company"),
    )
    if start is not None:
        bars = bars.where(F.col("Date") >= F.lit(start))
    return bars if end is None else bars.where(F.col("Date") <= F.lit(end))


def read_daily(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """A daily series from CSV files with a header: the date in the first column, then numbers."""
    raw = _with_header(spark, path)
    day = raw.columns[0]
    return raw.select(F.col(day).cast("date").alias("Date"), *[real(F.col(c).try_cast("double")).alias(c) for c in columns])


def read_features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Price features from CSV files with a header: company, date, and numbers in all other columns."""
    raw = _with_header(spark, path)
    kinds = {"Company": F.col("Company"), "Date": F.col("Date").cast("date")}
    return raw.select(*[kinds[c].alias(c) if c in kinds else real(F.col(c).try_cast("double")).alias(c) for c in raw.columns])


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    compression: str | None = None,
    header: bool = False,
    partition_by: Sequence[str] = (),
    single_file: bool = False,
) -> None:
    """Write rows as Parquet, JSON or CSV.

    ``single_file`` gathers all rows in one task, for small results only.
    """
    writer = (df.coalesce(1) if single_file else df).write.format(fmt).mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
