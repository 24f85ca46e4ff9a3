import importlib.util
import os
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from contract.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, small, name):
    rows, difference, _, _ = compare(spark, small, name)
    assert difference is None
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    got = entry(spark)
    assert got.columns[0] == "subreddit" and got.count() == 35


def test_entry_works_from_any_folder(tmp_path):
    """Functions sent to the executors must not need this package there."""
    script = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_module", r"{ROOT}/__spark_entry__.py")
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("gear_reviews", "batched_enrichment", "resumed_lookup", "trail_fetched_weather", "element_file_scan"):
    print(name, module.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, text=True,
                          capture_output=True, timeout=300)
    assert "gear_reviews 35" in done.stdout and "batched_enrichment 1" in done.stdout, done.stderr[-2000:]
