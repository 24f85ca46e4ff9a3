"""A ledger of answered lookup batches in a shared folder.

A batch's answers are written by the task that asked, right after they came, as one file under the
digest of its keys: under a temporary name first, then moved. A batch that has a file is never asked
again, neither by a task that is run anew nor by a later run. ``folder`` is a URI that pyarrow and
Spark both reach from every executor.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

#: Columns of an entry beside the lookup's own.
BATCH, PLACE, ANSWERED = "_batch", "_place", "_answered"


def _schema(fields: StructType) -> StructType:
    return StructType([
        StructField(BATCH, StringType()), StructField(PLACE, IntegerType()), StructField(ANSWERED, BooleanType()),
        *fields.fields])


def opened(folder: str) -> str:
    """The ledger's folder, made if it is not there."""
    store, path = fs.FileSystem.from_uri(folder)
    for part in ("answers", "merged"):
        store.create_dir(f"{path}/{part}", recursive=True)
    return folder.rstrip("/")


def entries(spark: SparkSession, folder: str, fields: StructType) -> DataFrame:
    """All keys that were asked, with their answers."""
    reader = spark.read.schema(_schema(fields)).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    # A merge that was cut short leaves entries twice.
    return reader.parquet(f"{folder}/answers", f"{folder}/merged").dropDuplicates([BATCH, PLACE])


def digest(members: Column) -> Column:
    """What names a batch: its keys, in order."""
    return F.sha2(F.to_json(F.struct(members.alias("keys"))), 256)


def asking(fetch: Callable, names: list[str], keys: int, fields: StructType, folder: str) -> Callable:
    """The function that answers a batch from the ledger, or asks and writes its entry. Nested, so
    that it travels to executors by value; returns whether there is an entry."""
    schema, columns = to_arrow_schema(_schema(fields)), (BATCH, PLACE, ANSWERED)

    def ask(batch: str, members: list[tuple]) -> bool:
        import logging

        import pyarrow.parquet as pq

        store, path = fs.FileSystem.from_uri(folder)
        final = f"{path}/answers/{batch}.parquet"
        if store.get_file_info(final).type == fs.FileType.File:
            return True
        try:
            answers = list(fetch(members))[:len(members)]
        except Exception as error:
            logging.getLogger("cairn").warning("lookup of %d keys failed: %s", len(members), error)
            return False
        answers += [None] * (len(members) - len(answers))
        rows = [  # positional; surplus answers are ignored
            dict(zip(columns, (batch, i, answer is not None))) | dict(zip(names, key))
            | {n: (answer or {}).get(n) for n in names[keys:]}
            for i, (key, answer) in enumerate(zip(members, answers))]
        temporary = f"{final}.{uuid.uuid4().hex}.tmp"
        pq.write_table(pa.Table.from_pylist(rows, schema=schema), temporary, filesystem=store)
        store.move(temporary, final)
        return True

    return ask


def merge(spark: SparkSession, folder: str, fields: StructType) -> None:
    """Puts the entries of many small files into one table. For a time when nothing is asked."""
    store, path = fs.FileSystem.from_uri(folder)
    small = [f.path for f in store.get_file_info(fs.FileSelector(f"{path}/answers")) if f.path.endswith(".parquet")]
    if not small:
        return
    rows = spark.read.schema(_schema(fields)).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/answers")
    rows.repartition(max(1, len(small) // 10_000)).write.parquet(f"{folder}/merged/{uuid.uuid4().hex}")
    for file in small:
        store.delete_file(file)
