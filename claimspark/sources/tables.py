"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimspark.functions.compat import empty_to_null


def read_table(
    spark: SparkSession, root: str | None, name: str, schema: T.StructType | None = None, fmt: str = "parquet", empty_as_null: bool = False, **options: str
) -> DataFrame:
    """A table by name: files under ``root``, a catalog table when ``root`` is None, or JDBC.

    A schema is passed for text formats, so codes with leading zeros are never read as numbers. ``empty_as_null`` is for
    tables of the legacy warehouse, in which an empty text is NULL. A JDBC table is read by one task unless the options
    split it, as ``split_read`` gives them.
    """
    df = _read(spark, root, name, schema, fmt, options)
    return empty_to_null(df) if empty_as_null else df


def split_read(column: str, least: int, most: int, rows: int, rows_a_task: int = 1_000_000, most_tasks: int = 10_000) -> dict[str, str]:
    """Options with which a JDBC table of ``rows`` rows is read by several tasks, by equal ranges of a whole-number column.

    The last task also reads what lies above ``most``, the first what lies below ``least`` and NULLs.
    """
    tasks = max(1, min(most_tasks, -(-rows // rows_a_task), most - least + 1))
    if tasks == 1:
        return {}
    return {"partitionColumn": column, "lowerBound": str(least), "upperBound": str(most + 1), "numPartitions": str(tasks)}


def _read(spark: SparkSession, root: str | None, name: str, schema: T.StructType | None, fmt: str, options: dict[str, str]) -> DataFrame:
    if root is None and fmt != "jdbc":
        return spark.table(name)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "jdbc":
        return reader.option("dbtable", name).load()
    suffix = {"parquet": ".parquet", "orc": ".orc", "csv": ".csv", "json": ".json"}.get(fmt, "")
    return reader.load(f"{root.rstrip('/')}/{name}{suffix}")
