"""The entry points without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "the pipeline file", "a broken module"])
def test_the_other_queries_are_there_without_the_folder(tmp_path, left):
    for name in ("tidemark", "checks"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if left != "nothing":
        (tmp_path / "tidemark" / "llm" / "__pycache__").mkdir(parents=True)
    if left in ("the pipeline file", "a broken module"):
        (tmp_path / "corpus_pipeline.py").write_text("from tidemark.llm import near\n")
    if left == "a broken module":
        (tmp_path / "tidemark" / "llm" / "near.py").write_text("import a_library_that_is_not_there\n")
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    names = run.stdout.split()
    assert len(names) > 80 and not any(n.startswith("op") or n == "pipeline" for n in names)


def test_headlines_keep_documents_without_an_order(spark, tmp_path):
    from checks import tables

    spark.createDataFrame([(k, f"t{k}", "en", "s", 2) for k in (1, 2, 4000)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([(1,)], "o_orderkey bigint").selectExpr("o_orderkey", "DATE '1999-05-05' AS o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    found = {r["id"]: str(r["day"]) for r in tables.headlines(spark, str(tmp_path)).collect()}
    assert found == {"1": "1999-05-05", "2": "1995-01-03", "4000": "1995-01-01"}
