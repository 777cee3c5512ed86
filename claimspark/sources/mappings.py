"""Column-mapping files: JSON arrays or CSV with six text fields."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = ("source_schema", "source_table", "source_column", "target_schema", "target_table", "target_column")
SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])


def read_mappings(spark: SparkSession, path: str | None) -> DataFrame:
    """The mapping rows with their file order as ``pos``; empty when there is no such file.

    CSV fields are trimmed and absent ones become ``''``. Any other suffix is an error.
    """
    empty = spark.createDataFrame([], T.StructType([*SCHEMA.fields, T.StructField("pos", T.LongType())]))
    if path is None:
        return empty
    try:
        if path.endswith(".json"):
            rows = spark.read.schema(SCHEMA).option("multiLine", True).json(path).withColumn("_file", F.col("_metadata.file_path"))
        elif path.endswith(".csv"):
            rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).withColumn("_file", F.col("_metadata.file_path"))
            have = set(rows.columns)
            rows = rows.select(
                *[(F.coalesce(F.trim(f), F.lit("")) if f in have else F.lit("")).alias(f) for f in FIELDS], "_file"
            )
        else:
            raise ValueError(f"unsupported mapping format: {path}")
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    # a multi-line file is one split, so ids rise along it; files come in the order of their names
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    # a row for each file, so the file list alone is numbered in one place
    files = rows.groupBy("_file").agg(F.min("_row").alias("_first"))
    order = files.withColumn("_place", F.row_number().over(Window.orderBy("_file")) - 1)
    placed = rows.join(order, "_file")
    return placed.select(*FIELDS, (F.col("_place") * F.lit(1 << 33) + F.col("_row") - F.col("_first")).alias("pos"))
