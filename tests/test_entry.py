import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from checks.compare import compare
from checks.queries import registry

FOLDER = os.environ.get("TIDEMARK_TEST_TABLES", "/root/testdata/sf0.001")

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_has_its_sql():
    own = set(registry())
    assert own <= set(entry_point.queries()) and own <= set(entry_point.oracle_sql())


@needs_tables
def test_flagship(spark):
    assert entry_point.entry(spark).count() == 2


@needs_tables
@pytest.mark.parametrize("name", list(registry()))
def test_query_equals_sql(spark, name):
    assert compare(spark, FOLDER, [name])[name].startswith("ok")


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry_point
for name in ("vector_topk", "retrieve", "write_training_shards", "digest_embedding"):
    assert entry_point.queries()[name](spark, sys.argv[2]).count() > 0, name
print("fine")
"""


@needs_tables
def test_workers_need_nothing_installed(tmp_path):
    """From another folder, with a session made by someone else."""
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run(
        [sys.executable, "-c", ELSEWHERE, str(root), FOLDER],
        cwd=tmp_path, capture_output=True, text=True, timeout=600,
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
