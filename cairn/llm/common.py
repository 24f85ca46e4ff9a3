"""What the operators share: the kept tables, text defaults and batches of Arrow rows."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.session import shared_folder


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors, once a context: Spark copies the archive from the
    driver to each of them. To be called before a function that needs it goes into a plan."""
    context = spark.sparkContext
    if getattr(context, "_cairn_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cairn-")) / "cairn_package.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._cairn_shipped = True


def keep(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, read by later steps,
    safe when executors are lost."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def texts(documents: DataFrame) -> DataFrame:
    """Only ``doc_id`` (bigint) and ``text`` (null as empty), so no other column can clash."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


#: What tells documents of one id, or without one, apart.
KEY = "text_key"


def text_key() -> Column:
    """A 64-bit hash of the text (null as empty). With the id it names a document: rows that are equal
    in both are one document, and rows without an id, or with the same one, are told apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def same_document(a: DataFrame, b: DataFrame, doc_id: str = "doc_id", key: str = KEY) -> Column:
    """Joins ``a`` and ``b`` by id, null ones as well, and text."""
    return a["doc_id"].cast("bigint").eqNullSafe(b[doc_id]) & (a[KEY] == b[key])


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the folds of the labelled rows."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def map_rows(
    rows: DataFrame,
    schema: str,
    function: Callable[[dict[str, list]], dict[str, Sequence]],
    small: int = 2 << 20,
) -> DataFrame:
    """``function`` over the columns of Arrow batches, as lists of Python values.

    A batch is cut so that its texts take about ``small`` characters, or hold one row.
    """
    ship(rows.sparkSession)
    target = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(target)
        for batch in batches:
            for part in pieces(batch, small):
                columns = {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}
                made = function(columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], type=f.type) for f in out], schema=out)

    return rows.mapInArrow(run, target)


def pieces(batch: pa.RecordBatch, small: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``small`` bytes each, at least one row."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * small / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


class Remembered:
    """Answers of a function by key, at most twice ``most`` of them: the newer half is kept when
    room is made, so frequent keys stay."""

    def __init__(self, function: Callable, most: int):
        self.function, self.most = function, most
        self.new: dict = {}
        self.old: dict = {}

    def __call__(self, key):
        hit = self.new.get(key)
        if hit is None:
            hit = self.old.get(key)
            if hit is None:
                hit = self.function(key)
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            self.new[key] = hit
        return hit
