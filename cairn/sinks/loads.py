"""Loads that are published once: a ledger of load ids beside the table's files.

The rows of a load are staged in ``_loads/<id>`` under the table's location, which readers of the
table pass over. Then its files are moved into the table under names that hold the id, and the
report becomes the entry ``done``. A load that was cut short goes on where it ended: staged rows
that have no report are staged again, files that were moved stay, the others follow. A load whose
entry is done adds nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LOADS = "_loads"


class Folder:
    """A folder on any store that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path
        self._store = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def has(self, name: str) -> bool:
        return self._store.exists(self._at(f"{self.path}/{name}"))

    def files(self, name: str) -> list[str]:
        if not self.has(name):
            return []
        found = self._store.listStatus(self._at(f"{self.path}/{name}"))
        return sorted(f.getPath().getName() for f in found if f.isFile())

    def move(self, name: str, target: str) -> None:
        if not self._store.rename(self._at(f"{self.path}/{name}"), self._at(f"{self.path}/{target}")):
            raise OSError(f"{self.path}/{name} could not be moved to {target}")

    def remove(self, name: str = "") -> None:
        self._store.delete(self._at(f"{self.path}/{name}".rstrip("/")), True)

    def write(self, name: str, text: str) -> None:
        """Under a temporary name first: a file that is there is whole."""
        out = self._store.create(self._at(f"{self.path}/{name}.tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{name}.tmp", name)

    def read(self, name: str) -> str:
        stream = self._store.open(self._at(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def location(spark: SparkSession, table: str) -> str:
    """Where the table's files are. Only plain Parquet tables have files that can be moved in."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if about.get("Provider", "").lower() != "parquet" or "# Partition Information" in about:
        raise ValueError(f"{table} is no unpartitioned Parquet table, so it takes no load id")
    return about["Location"]


def publish_once(rows: DataFrame, table: str, load_id: str, report: Callable[[], dict]) -> tuple[dict, bool]:
    """Adds the rows unless the load ``load_id`` did so before; its report, and whether it is new.

    ``report`` is called when the rows have been staged. Two runs of one id at the same time are
    not kept apart.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.\-]*", load_id):
        raise ValueError("a load id has letters, digits, '_', '.' and '-'")
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], rows.schema).write.mode("append").saveAsTable(table)
    there = {f.name: f.dataType for f in spark.table(table).schema}
    if there != {f.name: f.dataType for f in rows.schema}:
        raise ValueError(f"{table} has other columns than the load")
    folder, entry = Folder(spark, location(spark, table)), f"{LOADS}/{load_id}"
    if folder.has(f"{entry}/done"):
        return json.loads(folder.read(f"{entry}/done")), False
    if not folder.has(f"{entry}/report"):
        folder.remove(entry)
        rows.write.parquet(f"{folder.path}/{entry}/staged")
        folder.write(f"{entry}/report", json.dumps(report()))
    known = json.loads(folder.read(f"{entry}/report"))
    for name in folder.files(f"{entry}/staged"):
        if known["rows"] and not name.startswith(("_", ".")):
            folder.move(f"{entry}/staged/{name}", f"load-{load_id}-{name}")
    folder.move(f"{entry}/report", f"{entry}/done")
    folder.remove(f"{entry}/staged")
    spark.catalog.refreshTable(table)
    return known, True
