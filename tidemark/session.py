"""Session defaults, the shared scratch folder, and size-aware joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Spark's setting to remove the shuffle files of an action when it ends; else they stay until the driver's memory is cleaned.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# One row per value of these types is a bounded table whatever the input size:
# a date column has at most 3.65 million days in years 1 to 9999.
BOUNDED_KEY_TYPES = (T.DateType, T.BooleanType, T.ByteType, T.ShortType)


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


_named: ContextVar[list[str] | None] = ContextVar("named", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, under the application's id, that no other job uses."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if (named := _named.get()) is not None:
        named.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end all folders that were named inside it, staged tables among them.

    Meant for whole jobs, which write their results elsewhere: a DataFrame that reads a staged table can't be used
    after that. Folders that another thread names are not removed.
    """
    named: list[str] = []
    token = _named.set(named)
    try:
        yield
    finally:
        _named.reset(token)
        for path in named:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action inside it are removed when the action ends.

    Meant for chains of staged tables. A DataFrame on which two actions are run makes its shuffles anew, as it does anyway
    unless Spark still has its plan.
    """
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_END)
        else:
            spark.conf.set(SHUFFLES_END, before)


def written(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the folder ``path`` as Parquet and read it back."""
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str = "staged", compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends at the written files, so a lost executor costs one re-read, and Catalyst plans
    with the true size of the table.
    """
    return written(df, new_folder(df.sparkSession, name), compression)


@contextmanager
def lent(df: DataFrame, name: str, compression: str | None = None) -> Iterator[DataFrame]:
    """``df`` staged until the end of the block, for one large table; folders named inside the block stay."""
    path = new_folder(df.sparkSession, name)
    try:
        yield written(df, path, compression)
    finally:
        remove(df.sparkSession, path)


def join_per_key(rows: DataFrame, per_key: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with a table that has one narrow row per key.

    The small side is broadcast outright when the key's type bounds its row count. Otherwise it is
    staged first: Spark then sees its real size, broadcasts below ``autoBroadcastJoinThreshold`` and
    sort-merges above it, where adaptive execution splits a skewed key.
    """
    if isinstance(per_key.schema[on].dataType, BOUNDED_KEY_TYPES):
        return rows.join(F.broadcast(per_key), on, how)
    return rows.join(staged(per_key, "per-key"), on, how)


def with_fit(
    df: DataFrame, fit: Column, by: str | None = None, of: DataFrame | None = None, how: str = "left"
) -> DataFrame:
    """Adds the aggregate ``fit`` of ``of`` (``df`` itself by default) as column ``_fit``.

    Over the whole table it is one subquery, run once: the rows are neither joined nor shuffled. With
    ``by`` it is an aggregate per key, joined back; a window would gather the rows of a key in one task.
    """
    source = df if of is None else of
    if by is None:
        return df.withColumn("_fit", source.select(fit).scalar())
    fits = source.where(F.col(by).isNotNull()).groupBy(by).agg(fit.alias("_fit"))
    return join_per_key(df, fits, by, how)


def as_dict(df: DataFrame, key: str, value: str, max_rows: int = 100_000) -> dict:
    """A small table as a dictionary on the driver; a table over ``max_rows`` raises."""
    rows = df.where(df[key].isNotNull() & df[value].isNotNull()).select(key, value).take(max_rows + 1)
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; use the join form for a table of this size")
    return {row[0]: row[1] for row in rows}
