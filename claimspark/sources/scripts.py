"""A corpus of script files as a table ``(script, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_scripts(spark: SparkSession, folder: str, suffix: str = ".sql", strict: bool = True) -> DataFrame:
    """One row per file. Bytes are read as UTF-8 when valid, else as Latin-1, which always succeeds.

    A blank file is an error, or is left out with ``strict=False``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    utf8 = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(utf8), utf8).otherwise(F.decode("content", "ISO-8859-1"))
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("script"), text.alias("text"))
    blank = F.regexp_replace("text", r"(?U)\s+", "") == ""
    if not strict:
        return rows.where(~blank)
    message = F.concat(F.lit("script is empty: "), F.col("script"))
    return rows.withColumn("text", F.when(blank, F.raise_error(message)).otherwise(F.col("text")))
