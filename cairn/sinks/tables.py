"""The two result tables: set-up script and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cairn.schemas import GEAR_REVIEWS, TRAIL_WEATHER

TRAIL_TABLE = "trail.trail_weather"
GEAR_TABLE = "gear.gear_reviews"

_REPORT = "idx int, statement string, ok boolean, error string"


def _create(table: str, schema: StructType, file_format: str) -> str:
    columns = ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  {columns}\n) USING {file_format}"


def ddl_script(
    trail_table: str = TRAIL_TABLE, gear_table: str = GEAR_TABLE, file_format: str = "parquet"
) -> str:
    """Creates the databases and tables that do not exist yet."""
    databases = sorted({t.rsplit(".", 1)[0] for t in (trail_table, gear_table) if "." in t})
    statements = [f"CREATE SCHEMA IF NOT EXISTS {d}" for d in databases]
    statements += [
        _create(gear_table, GEAR_REVIEWS, file_format),
        _create(trail_table, TRAIL_WEATHER, file_format),
    ]
    return ";\n\n".join(statements) + ";\n"


def apply_ddl(spark: SparkSession, script: str) -> DataFrame:
    """Runs a script statement by statement and reports on each; failures do not stop it.

    Statements end at every ``;``, also inside quotes.
    """
    report = []
    for statement in filter(None, (part.strip() for part in script.split(";"))):
        error = None
        try:
            spark.sql(statement)
        except Exception as failure:
            error = str(failure)
        report.append((len(report), statement, error is None, error))
    return spark.createDataFrame(report, _REPORT)


def init_tables(
    spark: SparkSession,
    trail_table: str = TRAIL_TABLE,
    gear_table: str = GEAR_TABLE,
    file_format: str = "parquet",
) -> DataFrame:
    """Creates the result tables; the report of :func:`apply_ddl`."""
    return apply_ddl(spark, ddl_script(trail_table, gear_table, file_format))


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a sink, in its order and types; columns that are missing become typed nulls."""
    present = set(rows.columns)
    return rows.selectExpr(*(
        f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema.fields
    ))


def append(rows: DataFrame, table: str) -> None:
    """Appends by column name. A rerun appends again: there is no key."""
    rows.write.mode("append").saveAsTable(table)
