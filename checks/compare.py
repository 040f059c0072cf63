"""Run queries next to their SQL and report differences: ``python -m checks.compare SF_DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks import catalog


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        db.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def difference(spark, db, name: str, sf: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = catalog.QUERIES[name](spark, sf)
    begin = time.time()
    got = _rows(df.columns, df.collect())
    print(f"{time.time() - begin:6.2f}s", end=" ")
    if name not in catalog.SQL:
        return None if got else "no rows"
    result = db.sql(catalog.SQL[name])
    want = _rows(result.columns, result.fetchall())
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} against {sorted(result.columns)}"
    if not got:
        return "no rows"
    if got != want:
        extra, lacking = list((got - want).elements()), list((want - got).elements())
        sample = [str(sorted(rows)[:2])[:600] for rows in (extra, lacking)]
        return f"{got.total()} and {want.total()} rows, {len(extra)} differ: {sample[0]} against {sample[1]}"
    return None


def main() -> None:
    from tidemark import build_session

    sf, names = sys.argv[1], sys.argv[2:] or list(catalog.QUERIES)
    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    for name in names:
        begin = time.time()
        try:
            found = difference(spark, db, name, sf)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - begin:.2f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
