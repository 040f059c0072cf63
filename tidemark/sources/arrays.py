"""JSON objects of files that break them over lines, read by as many tasks as the files have ranges.

Spark's text reader cuts files at closing braces, and a range begins wherever that falls. So each range is first scanned
for what it does to the state it may begin in: whether it is inside a string, and how deep in objects. Chained along
a file, these give every range's true state. With it the ranges are cut into objects, and an object that lies across
ranges is put together from its parts.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.schemas import RAW_HEADLINE
from tidemark.session import staged

CLOSE = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
TASK_BYTES = 64 << 20  # of ranges that a task reads one after another
TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|["{]', re.S)


def advance(chunk: str, inside: bool) -> tuple[int, int, bool]:
    """Objects that open in the text before a closing brace, where the first does, and whether the brace is in a string."""
    at = 0
    if inside:
        end = CLOSE.match(chunk)
        if not end:
            return 0, -1, True
        at = end.end()
    opens, first = 0, -1
    for found in TOKEN.finditer(chunk, at):
        if found[0] == "{":
            opens, first = opens + 1, found.start() if first < 0 else first
        elif found[0] == '"':  # the start of a string without an end
            return opens, first, True
    return opens, first, False


class Effect(NamedTuple):
    """What a range does: inside a string at its end or not, change of depth, least depth on the way, both from its start."""

    inside: bool
    change: int = 0
    least: int = 0

    def then(self, chunk: str) -> Effect:
        opens, _, inside = advance(chunk, self.inside)
        change = self.change + opens - (not inside)
        return Effect(inside, change, min(self.least, change))


class Start(NamedTuple):
    """The state a range begins in; ``began`` is the range with the start of the object it is in."""

    inside: bool = False
    depth: int = 0
    began: int = -1


def starts(effects: list[tuple[int, Effect, Effect]]) -> dict[int, Start]:
    """The state at the start of each range of a file from the effects of all, outside and inside a string."""
    found, now = {}, Start()
    for block, outside, inside in sorted(effects):
        found[block] = now
        effect = inside if now.inside else outside
        depth = effect.change + max(now.depth, -effect.least)  # closing braces too many count for nothing
        began = now.began if now.depth and now.depth + effect.least > 0 else block
        now = Start(effect.inside, depth, began if depth else -1)
    return found


def _chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in ("file", "block", "value")), strict=True)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], tuple[Effect, Effect]] = {}
    for file, block, chunk in _rows(batches):
        outside, inside = found.get((file, block)) or (Effect(False), Effect(True))
        found[file, block] = outside.then(chunk), inside.then(chunk)
    out = [(f, b, *x, *y) for (f, b), (x, y) in found.items()]
    if out:
        names = ["file", "block", "out_inside", "out_change", "out_least", "in_inside", "in_change", "in_least"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)


EFFECTS = "file string, block bigint, out_inside boolean, out_change bigint, out_least bigint, in_inside boolean, in_change bigint, in_least bigint"


def cut(chunks: Iterator[str], start: Start, block: int) -> Iterator[tuple[int | None, str]]:
    """The objects of a range, as ``(None, text)``, and its parts of others, with the range in which these begin."""
    inside, depth = start.inside, start.depth
    held: list[str] = []
    of: int | None = start.began if depth else None
    for chunk in chunks:
        opens, first, after = advance(chunk, inside)
        if depth or opens:
            held.append((chunk if depth else chunk[first:]) + "}")
        depth = depth + opens if after else max(depth + opens - 1, 0)
        inside = after
        if held and not depth:
            yield of, "".join(held)
            held, of = [], None
    if held:
        yield block if of is None else of, "".join(held)


def json_objects(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """``file, object``: the text of every outermost JSON object of the files, wherever lines break.

    Objects may stand in arrays, one after another or one per line. Large files are read in ranges of
    ``split_bytes`` (Spark's own setting if not given), side by side, small ones several to a task. Whatever is outside
    objects is passed over, and an object that its file cuts off is closed there. The objects are staged; only parts of
    objects that lie across ranges are shuffled, and of each range a few numbers come to the driver.
    """
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    costs = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        if split_bytes:
            spark.conf.set(setting, split_bytes)
            spark.conf.set("spark.sql.files.openCostInBytes", min(split_bytes, 4 << 20))
        text = _chunks(spark, path)
        if split_bytes:  # small ranges stay apart, but a task reads many of them
            ranges = text.rdd.getNumPartitions()
            tasks = max(2 * spark.sparkContext.defaultParallelism, ranges * split_bytes // TASK_BYTES)
            text = text.coalesce(tasks) if tasks < ranges else text
        effects = defaultdict(list)
        for r in text.mapInArrow(_effects, EFFECTS).collect():  # one row per range
            effects[r["file"]].append((r["block"], Effect(*r[2:5]), Effect(*r[5:8])))
        known = {(file, block): start for file, parts in effects.items() if len(parts) > 1 for block, start in starts(parts).items()}
        shared = spark.sparkContext.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from itertools import groupby

            held: list[tuple] = []
            size = 0
            for (file, block), rows in groupby(_rows(batches), lambda r: r[:2]):
                for began, part in cut((chunk for *_, chunk in rows), shared.value.get((file, block), Start()), block):
                    held.append((file, began, block, part))
                    size += len(part)
                    if size > 1 << 22:
                        yield _batch(held)
                        held, size = [], 0
            if held:
                yield _batch(held)

        found = staged(text.mapInArrow(run, "file string, began bigint, block bigint, part string"), "json-objects")
    finally:
        spark.conf.set(setting, before)
        spark.conf.set("spark.sql.files.openCostInBytes", costs)
    whole = found.where(F.col("began").isNull()).select("file", F.col("part").alias("object"))
    parts = F.sort_array(F.collect_list(F.struct("block", "part")))["part"]
    joined = found.where(F.col("began").isNotNull()).groupBy("file", "began").agg(F.array_join(parts, "").alias("object"))
    return whole.unionByName(joined.select("file", "object"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "began", "block", "part"])


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_HEADLINE, split_bytes: int | None = None) -> DataFrame:
    """Rows of JSON files whose objects are broken over lines, as Spark's multi-line reader gives them, but from all ranges at once."""
    objects = json_objects(spark, path, split_bytes)
    return objects.select(F.from_json("object", schema).alias("row")).select("row.*")
