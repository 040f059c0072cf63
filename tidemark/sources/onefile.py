"""One ordered file written by many tasks."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import new_folder

COPY_BYTES = 8 << 20


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """The data files of a folder in the order of their tasks, and their sizes; only their names are read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "length")
    return sorted((r["path"], r["length"]) for r in found.collect() if r["length"])


def _placed(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """Copies parts to their places in a file that is already as long as all of them."""
    from pyarrow import fs

    for batch in batches:
        done = []
        for path, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist(), strict=True):
            files, name = fs.FileSystem.from_uri(path)
            size = 0
            with files.open_input_stream(name, compression=None) as source, open(target, "r+b") as out:
                out.seek(at)
                while chunk := source.read(COPY_BYTES):
                    size += out.write(chunk)
            done.append(size)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["size"])


def _appended(batches: Iterator[pa.RecordBatch], target: str, head: bytes, tail: bytes = b"") -> Iterator[pa.RecordBatch]:
    """Copies parts one after another to a file that can't be written in places."""
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(target)
    size = 0
    with files.open_output_stream(name, compression=None) as out:
        out.write(head)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source_files, source_name = fs.FileSystem.from_uri(path)
                with source_files.open_input_stream(source_name, compression=None) as source:
                    while chunk := source.read(COPY_BYTES):
                        size += out.write(chunk)
        out.write(tail)
    yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], names=["size"])


def write_one_file(df: DataFrame, path: str, order: Sequence[str], compressed: bool = False, header: bool = True) -> None:
    """Rows as one CSV file at ``path``, in ``order``; ``compressed`` as the members of one gzip file.

    Tasks sort and write a range of the order each, side by side. The parts, already encoded, are then laid end to end:
    on a file system that tasks can write to in places (a path without a scheme or with ``file:``) by one task for each
    part, elsewhere by one task that copies bytes, of which it holds a few MB. The file appears under its name when it is
    whole; one that was there before is replaced. Copying a part again, after a lost executor, changes nothing.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "parts")
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    ranged.write.option("compression", "gzip" if compressed else "none").csv(folder)
    line = ",".join(c if not set(c) & set('",\n') else '"' + c.replace('"', '\\"') + '"' for c in df.columns).encode() + b"\n" if header else b""
    head = gzip.compress(line, mtime=0) if compressed and line else line
    _joined(spark, folder, path, head)


def write_one_text(df: DataFrame, path: str, head: str = "", tail: str = "") -> None:
    """The texts of a table of one column, a line each, as one file at ``path`` between ``head`` and ``tail``.

    Tasks write their texts side by side, in no fixed order; the parts are laid end to end as in :func:`write_one_file`.
    """
    folder = new_folder(df.sparkSession, "parts")
    df.write.option("compression", "none").text(folder)
    _joined(df.sparkSession, folder, path, head.encode(), tail.encode())


def _joined(spark: SparkSession, folder: str, path: str, head: bytes, tail: bytes = b"") -> None:
    """Lays the parts in ``folder`` end to end between ``head`` and ``tail``, and removes the folder."""
    parts = _parts(spark, folder)
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    target = f"{path}.{uuid.uuid4().hex}"
    local = hadoop(path).toUri().getScheme() in (None, "file")
    if local:
        at = target.removeprefix("file://").removeprefix("file:")
        with open(at, "wb") as out:
            out.write(head)
            out.seek(len(head) + sum(size for _, size in parts))
            out.write(tail)
            out.truncate()
        places, offset = [], len(head)
        for name, size in parts:
            places.append((name, offset))
            offset += size
        listed = spark.createDataFrame(places, "path string, at bigint").repartition(max(len(places), 1))
        copied = listed.mapInArrow(lambda batches: _placed(batches, at), "size bigint")
    else:
        listed = spark.createDataFrame([p for p in parts], "path string, length bigint").coalesce(1)
        copied = listed.mapInArrow(lambda batches: _appended(batches, target, head, tail), "size bigint")
    total = copied.agg(F.sum("size")).head()[0] or 0
    files = hadoop(path).getFileSystem(conf)
    if total != sum(size for _, size in parts):
        files.delete(hadoop(target), False)
        raise OSError(f"{total} bytes were copied instead of {sum(size for _, size in parts)}")
    files.delete(hadoop(path), True)
    if not files.rename(hadoop(target), hadoop(path)):
        raise OSError(f"{target} can't be renamed")
    files.delete(hadoop(folder), True)
