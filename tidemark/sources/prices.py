"""Price files that don't agree: columns in another order, further or missing ones, rows that can't be read."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.numbers import real
from tidemark.operators.rows import union_all
from tidemark.schemas import PRICE_BAR
from tidemark.session import staged

HEADER_BYTES = 1 << 16  # in which a header must end


class Prices(NamedTuple):
    """Bars, and the rows that are none: ``file, line, reason``."""

    bars: DataFrame
    rejected: DataFrame


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            files, name = fs.FileSystem.from_uri(path)
            with files.open_input_stream(name) as source:  # compression by the file's ending
                found.append(source.read(HEADER_BYTES).split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r"))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], names=["path", "header"])


def headers(spark: SparkSession, paths: str | list[str]) -> dict[str, list[str]]:
    """The files of each header line; only the files' first bytes are read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")
    found = defaultdict(list)
    for r in listed.mapInArrow(_headers, "path string, header string").collect():  # one row per file
        found[r["header"]].append(r["path"])
    return dict(found)


def read_mixed_prices(spark: SparkSession, paths: str | list[str]) -> Prices:
    """Price bars from CSV files whose headers differ; columns are taken by name and missing ones are null.

    Files with the same header are one scan. A row is rejected, with its file and the reason, if its fields are not
    those of the header, its date can't be read, or it has no company. Numbers that can't be read are missing values, as
    in :func:`tidemark.sources.files.read_prices`. The rows are staged, since both tables come from them.
    """
    scans = []
    for header, files in headers(spark, paths).items():
        names = [n.strip().strip('"') for n in header.split(",")] if header else []
        if len(set(names)) < len(names):
            raise ValueError(f"a column is twice in the header {header!r} of {files[0]}")
        if not names:
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names]).add("_line", T.StringType())
        reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", "_line").option("enforceSchema", True)
        raw = reader.schema(schema).csv(files).select("*", F.col("_metadata.file_path").alias("_file"))
        column = lambda n: F.trim(F.col(f"`{n}`")) if n in names else F.lit(None).cast("string")  # noqa: E731, B023
        text = F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names])
        scans.append(raw.select(*[column(n).alias(n) for n in PRICE_BAR.names], F.coalesce("_line", text).alias("_line"), F.col("_line").isNotNull().alias("_broken"), "_file"))
    if not scans:
        empty = spark.createDataFrame([], PRICE_BAR)
        return Prices(empty, spark.createDataFrame([], "file string, line string, reason string"))
    rows = union_all(scans)
    day = F.col("Date").try_cast("date")
    reason = (
        F.when(F.col("_broken"), "fields are not those of the header")
        .when(day.isNull(), "no date")
        .when(F.coalesce(F.col("Company"), F.lit("")) == "", "no company")
    )
    told = staged(rows.withColumn("_reason", reason), "mixed-prices")
    bars = told.where(F.col("_reason").isNull()).select(
        day.alias("Date"), *[real(F.col(n).try_cast("double")).alias(n) for n in ("Open", "Volume")], "Company"
    )
    rejected = told.where(F.col("_reason").isNotNull()).select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason"))
    return Prices(bars, rejected)
