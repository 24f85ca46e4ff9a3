"""Map-element payloads: JSON documents with an ``elements`` array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.schemas import ELEMENT, LANDED_ELEMENT, PAYLOAD


def _element_rows(payloads: DataFrame, elements: Column, payload_key: Column) -> DataFrame:
    exploded = payloads.select(payload_key.alias("_payload"), F.posexplode(elements))
    return exploded.select(
        F.struct(F.col("_payload").alias("payload"), F.col("pos").cast("bigint").alias("pos")).alias("ord"),
        *(F.col("col")[name].alias(name) for name in ELEMENT.names),
    )


def read_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per element of every file; ``ord`` is (file, position in the payload).

    A payload is parsed by one task, in memory; for large files see ``split.scan_elements``. A file
    that is no valid payload fails the job.
    """
    payloads = (
        spark.read.schema(PAYLOAD).option("multiLine", True).option("mode", "FAILFAST").json(path)
    )
    return _element_rows(payloads, F.col("elements"), F.col("_metadata.file_path"))


def read_landed_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Elements once parsed and written as parquet, ``ord`` included.

    Landed like this, elements are split among tasks and a job reads only the columns it needs.
    """
    return spark.read.schema(LANDED_ELEMENT).format("parquet").load(path)


def parse_elements(payloads: DataFrame, text: str, payload_key: str) -> DataFrame:
    """The same from a table with a payload per row, in a JSON text column.

    ``payload_key`` orders the payloads.
    """
    parsed = F.from_json(F.col(text), PAYLOAD, {"mode": "FAILFAST"})
    return _element_rows(payloads, parsed["elements"], F.col(payload_key))
