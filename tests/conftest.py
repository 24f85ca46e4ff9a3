import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
os.environ.setdefault("OMP_NUM_THREADS", "1")  # numpy's threads would compete with Spark's

from cairn.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cairn-tests-")
    session = build_session(
        "cairn-tests",
        master="local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="4g",
        spark_sql_warehouse_dir=f"{scratch}/warehouse",
        spark_checkpoint_dir=f"{scratch}/checkpoints",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("CAIRN_TEST_DATA", "/root/testdata/sf0.001")
