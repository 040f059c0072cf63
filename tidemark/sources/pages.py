"""A feed's pages as files, and files as a feed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.paging import DEFAULT_PAGE, keyset_page, page_documents

GROUP_BYTES = 1 << 20  # of a row group in a slice, the least that is read for a page


def write_pages(df: DataFrame, path: str, order: Sequence[str], size: int = DEFAULT_PAGE) -> None:
    """Write all pages of a table, one JSON array per line, spread over as many files as tasks.

    The headline reader takes these files as they are.
    """
    page_documents(df, order, size).select("body").write.mode("overwrite").text(path)


def drain_pages(
    table: Callable[[], DataFrame],
    path: str,
    order: Sequence[str],
    after: Sequence[Any],
    size: int = DEFAULT_PAGE,
) -> tuple[list[Any], int]:
    """Follow a growing table from a cursor until a page comes back empty.

    Each page is a job of its own that writes ``after=<cursor>``; only the new cursor comes to the
    driver. Meant for keeping up with a feed; :func:`write_pages` takes a whole table at once. Returns
    the last cursor and the number of pages.
    """
    cursor, pages = list(after), 0
    while True:
        page = keyset_page(table(), order, cursor, size)
        folder = f"{path}/after={'_'.join(str(c) for c in cursor)}"
        page.write.mode("overwrite").json(folder)
        written = page.sparkSession.read.schema(page.schema).json(folder)
        last = written.orderBy(*[written[c].desc() for c in order]).select(*order).head()
        if last is None:
            return cursor, pages
        cursor, pages = list(last), pages + 1


def write_slices(df: DataFrame, path: str, key: tuple[str, str], width: int) -> None:
    """Append rows to a folder per slice of ``width`` seconds, in files sorted by ``key``, a time in seconds and an id.

    Rows are range-partitioned by the whole key, so a second that very many rows share is split.
    """
    number = F.floor(F.col(key[0]) / width).cast("bigint")
    rows = df.where(F.col(key[0]).isNotNull() & F.col(key[1]).isNotNull()).withColumn("slice", number)
    ranged = rows.repartitionByRange(*key).sortWithinPartitions("slice", *key)
    ranged.write.mode("append").partitionBy("slice").option("parquet.block.size", GROUP_BYTES).parquet(path)


def sliced_feed(path: str, key: tuple[str, str], width: int, columns: Sequence[str] = ()) -> tuple[Callable, Callable]:
    """``fetch`` and ``newest`` of the paged source over the folders of :func:`write_slices`.

    A page is read from the row groups that can hold it, by the statistics of the sorted files. Only slices of the
    asked range are opened, so a page costs the same however long the feed is.
    """

    def folder(number: int):
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        found = files.get_file_info(fs.FileSelector(f"{root}/slice={number}", allow_not_found=True))
        return files, sorted(f.path for f in found if f.path.endswith(".parquet"))

    def fetch(after: tuple, until: int, size: int) -> list[tuple]:
        import pyarrow as pa
        import pyarrow.dataset as ds

        when, last = after
        moment, ident = ds.field(key[0]), ds.field(key[1])
        newer = moment >= when if last is None else (moment > when) | ((moment == when) & (ident > last))
        for number in range(when // width, (until - 1) // width + 1):
            files, paths = folder(number)
            # A file is sorted, and so is what one append has written; several appends lie side by side.
            pages = [
                ds.dataset(p, format="parquet", filesystem=files)
                .scanner(columns=[*key, *columns], filter=newer & (moment >= when) & (moment < until), batch_size=size, use_threads=False)
                .head(size)
                for p in paths
            ]
            if rows := sum(map(len, pages)):
                page = pa.concat_tables(pages).sort_by([(k, "ascending") for k in key]).slice(0, min(size, rows))
                return list(zip(*(page.column(c).to_pylist() for c in page.column_names), strict=True))
        return []

    def newest() -> tuple | None:
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        numbers = sorted((int(f.base_name.removeprefix("slice=")) for f in found if f.base_name.startswith("slice=")), reverse=True)
        for number in numbers:
            keys = []
            for p in folder(number)[1]:
                file = pq.ParquetFile(p, filesystem=files)
                if file.metadata.num_rows:
                    group = file.read_row_group(file.num_row_groups - 1, columns=list(key))
                    keys.append(tuple(group.column(k)[-1].as_py() for k in key))
            if keys:
                return max(keys)
        return None

    return fetch, newest
