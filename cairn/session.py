"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "cairn", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, ANSI casts and adaptive execution.

    Partition counts are left to the cluster; pass them in ``conf`` (with ``_``
    for ``.``) for a local run.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without: it gets a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


def settle(rows: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder, where no lost executor can
    take them along. For results that cost outside requests or feed a plan twice."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def landed(rows: DataFrame, name: str) -> DataFrame:
    """The rows, computed once and kept as Parquet in the shared folder, so that later steps read
    only the columns they need."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """The counters of an observation, after an action: 0 where adaptive execution found the rows
    below it to be none and left the counting out."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return {n: found.get(n, 0) for n in names}


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="cairn-")
