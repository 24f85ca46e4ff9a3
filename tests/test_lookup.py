"""Batches in order, and lookups that go on where others ended."""

import collections
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from cairn.operators import ledger
from cairn.operators.enrich import batched_lookup, ordered_lookup

ROOT = Path(__file__).resolve().parents[1]
FIELDS = StructType().add("key", LongType()).add("at", DoubleType()).add("first", LongType()).add("n", LongType())


def keys_of(spark, many):
    return spark.range(many).repartition(5).select(F.col("id").alias("key"), (F.col("id") / 4).alias("at"))


def answer(batch):
    return [{"first": batch[0][0], "n": len(batch)} if key % 7 else None for key, _ in batch]


def counting(path, fails=lambda batch: False):
    """Answers, and notes every key that was answered in a file."""
    def fetch(batch):
        if fails(batch):
            raise RuntimeError("no answer")
        with open(path, "a") as log:
            log.write("".join(f"{key}\n" for key, _ in batch))
        return [{"first": batch[0][0], "n": len(batch)} if key % 7 else None for key, _ in batch]

    return fetch


def asked(path):
    return collections.Counter(map(int, path.read_text().split()))


@pytest.mark.parametrize("many, size", [(47, 10), (40, 10), (3, 10), (0, 4), (25, 1)])
def test_batches_are_consecutive_over_all_ranges(spark, many, size):
    rows = keys_of(spark, many).withColumn("other", -F.col("key"))
    got = ordered_lookup(rows, F.col("other"), answer, FIELDS, size).collect()
    order = list(range(many))[::-1]
    want = {(k, k / 4, order[i // size * size], len(order[i // size * size:][:size]), i // size, i % size)
            for i, k in enumerate(order) if k % 7}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_keys_must_lead(spark):
    with pytest.raises(ValueError, match="lead"):
        ordered_lookup(keys_of(spark, 3).select("at"), F.col("at"), answer, FIELDS)


@pytest.mark.parametrize("ordered", [True, False])
def test_a_later_run_asks_only_what_is_open(spark, tmp_path, ordered):
    folder, log = f"file://{tmp_path}/ledger", tmp_path / "log"

    def look(many, fails=lambda batch: False):
        keys, fetch = keys_of(spark, many), counting(log, fails)
        if ordered:
            return ordered_lookup(keys, F.col("key"), fetch, FIELDS, 10, folder).drop("batch_id", "batch_pos")
        return batched_lookup(keys, fetch, FIELDS, 10, folder)

    first = look(95, lambda batch: any(key == 33 for key, _ in batch))
    open_keys = set(range(95)) - set(asked(log))
    assert 33 in open_keys and len(open_keys) <= 10
    assert {r.key for r in first.collect()} == {k for k in range(95) if k % 7 and k not in open_keys}
    assert first.count() == first.count()  # asks nothing
    assert {r.key for r in look(95).collect()} == {k for k in range(95) if k % 7}
    assert asked(log) == {k: 1 for k in range(95)}
    ledger.merge(spark, folder, FIELDS)
    assert not list((tmp_path / "ledger/answers").glob("*.parquet"))
    again = look(95).collect()
    assert len(again) == len({r.key for r in again}) == sum(k % 7 > 0 for k in range(95))
    assert asked(log) == {k: 1 for k in range(95)}


def test_null_keys_are_asked_once(spark, tmp_path):
    fields = StructType().add("a", StringType()).add("b", DoubleType()).add("n", LongType())
    keys = spark.createDataFrame([(None, 1.0), ("x", None), (None, None), ("x", 1.0)], "a string, b double")
    log = tmp_path / "log"

    def fetch(batch):
        with open(log, "a") as file:
            file.write("k\n" * len(batch))
        return [{"n": len(batch)}] * len(batch)

    for _ in range(2):
        found = batched_lookup(keys, fetch, fields, 3, f"file://{tmp_path}/ledger")
        assert found.count() == 4
    assert log.read_text() == "k\n" * 4


SCRIPT = """
import os, signal, sys
sys.path.insert(0, {root!r})
from cairn.session import build_session
from cairn.operators.enrich import batched_lookup, ordered_lookup
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

spark = build_session("killed", master="local[2,4]", spark_ui_enabled="false", spark_sql_shuffle_partitions="2",
                      spark_checkpoint_dir={scratch!r} + "/checkpoints")
fields = StructType().add("key", LongType()).add("n", LongType())
scratch = {scratch!r}

def fetch(batch):
    marker = scratch + "/killed"
    if len(open(scratch + "/log").read().split()) >= 40 and not os.path.exists(marker):
        open(marker, "w").close()
        os.kill(os.getpid(), signal.SIGKILL)
    with open(scratch + "/log", "a") as log:
        log.write("".join(f"{{key}}\\n" for key, in batch))
    return [{{"n": len(batch)}} for _ in batch]

open(scratch + "/log", "w").close()
keys = spark.range(150).repartition(3).select(F.col("id").alias("key"))
look = batched_lookup(keys, fetch, fields, 10, scratch + "/ledger") if {ordered} else ordered_lookup(
    keys, F.col("key"), fetch, fields, 10, scratch + "/ledger")
print("rows", look.count(), look.select("key").distinct().count())
"""


@pytest.mark.parametrize("ordered", [True, False])
def test_a_killed_task_does_not_ask_answered_keys_again(tmp_path, ordered):
    script = SCRIPT.format(root=str(ROOT), scratch=str(tmp_path), ordered=ordered)
    done = subprocess.run([sys.executable, "-c", script], text=True, capture_output=True, timeout=300, cwd=tmp_path)
    assert "rows 150 150" in done.stdout, done.stderr[-3000:]
    assert (tmp_path / "killed").exists()
    assert asked(tmp_path / "log") == {k: 1 for k in range(150)}
