"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is run once unmeasured and
then ``BENCH_RUNS`` times; the best run counts. Training and streams, which run many jobs each, are run
once. Results go to Spark's no-op sink, whole.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from checks import catalog
from tidemark import build_session

ONCE = {
    "train_predict", "train_metrics", "train_other", "validation_labels", "assembled_numbers", "loaded_model_agrees", "stream_prepare",
    "stream_lexicon_join", "stream_page_files", "stream_score", "stream_score_differences", "cursor_feed", "bounded_stream",
}


def timed(spark, name: str, sf: str) -> float:
    begin = time.perf_counter()
    catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(catalog.QUERIES)
    wanted = os.environ.get("BENCH_QUERIES")
    if wanted:
        names = [n for n in names if n in wanted.split(",")]
    seconds = {}
    for name in names:
        if name not in ONCE:
            timed(spark, name, sf)
        seconds[name] = round(min(timed(spark, name, sf) for _ in range(1 if name in ONCE else runs)), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf).name}))


if __name__ == "__main__":
    main()
