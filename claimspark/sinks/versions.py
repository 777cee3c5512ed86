"""Tables that switch in one step: rows are written beside the current version, then one manifest entry makes them current.

A table is a folder with ``data``, where each load has a folder of its own, and ``manifest``, to which a load appends one file
once its rows are written. An entry names, for each partition, the load that holds its rows; the entry with the greatest number
is the current version. A load that fails before its entry leaves the old version as it is, whole and readable, and a folder
that no entry names; ``vacuum`` deletes those and what only older versions need. Readers of an older version are not disturbed
until then. Loads of one table are meant to come one after the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.session import delete_folder
from claimspark.sinks.load import clustered

#: One row for each partition of a version, and one with no values for the version as a whole, which holds the schema.
MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("partition", T.ArrayType(T.StringType())),
        T.StructField("load", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("schema", T.StringType()),
    ]
)
Partition = tuple[str | None, ...]


class VersionedTable:
    """A table at ``path``, whole or in partitions by some of its columns, which are texts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # --------------------------------------------------------------------- reading
    def _entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _current(self) -> tuple[int, T.StructType | None, list[str], dict[Partition, tuple[str, int]]]:
        """Number, schema and partition columns of the current version, and for each partition its load and its rows."""
        entries = self._entries()
        rows = entries.where(F.col("version") == entries.agg(F.max("version")).first()[0]).collect() if entries is not None else []
        if not rows:
            return 0, None, [], {}
        head = next(r for r in rows if r["partition"] is None)
        parts = {tuple(r["partition"]): (r["load"], r["row_count"]) for r in rows if r["partition"] is not None}
        return head["version"], T.StructType.fromJson(json.loads(head["schema"])), list(head["columns"]), parts

    def version(self) -> int:
        """Number of the current version, 0 if there is none."""
        return self._current()[0]

    def counts(self) -> dict[Partition, int]:
        """Rows of each partition of the current version; a table without partitions has one, of no values."""
        return {p: n for p, (_, n) in self._current()[3].items()}

    def read(self) -> DataFrame | None:
        """The current version, None if there is none. Later loads don't change what has been read."""
        _, schema, columns, parts = self._current()
        if schema is None:
            return None
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data"
        # a load whose partitions are all current is one folder, so a plan names few paths
        held: dict[str, list[Partition]] = {}
        for p, (load, _) in parts.items():
            held.setdefault(load, []).append(p)
        full = T.StructType([*schema.fields, T.StructField("_load", T.StringType())])
        rows = self.spark.read.schema(full).option("basePath", base).parquet(*(f"{base}/_load={load}" for load in held))
        if columns:  # partitions are pruned by these constants before any file is read
            keep = F.lit(False)
            for load, ps in held.items():
                some = F.lit(False)
                for p in ps:
                    same = F.lit(True)
                    for c, v in zip(columns, p):
                        same = same & F.col(c).eqNullSafe(F.lit(v))
                    some = some | same
                keep = keep | ((F.col("_load") == load) & some)
            rows = rows.where(keep)
        return rows.select(*schema.names)

    # --------------------------------------------------------------------- loads
    def _write(self, df: DataFrame, columns: Sequence[str]) -> tuple[str, dict[Partition, int]]:
        """Write the rows as a load of its own; returns it with the rows of each partition, which come from file footers."""
        load = uuid.uuid4().hex
        folder = f"{self.path}/data/_load={load}"
        if not columns:
            df.write.parquet(folder)
            return load, {(): self.spark.read.schema(df.schema).parquet(folder).count()}
        df.hint("rebalance", *columns).write.partitionBy(*columns).parquet(folder)
        counts = self.spark.read.schema(df.schema).parquet(folder).groupBy(*columns).count().collect()
        return load, {tuple(r[c] for c in columns): r["count"] for r in counts}

    def _switch(self, version: int, schema: T.StructType, columns: Sequence[str], parts: Mapping[Partition, tuple[str, int]]) -> None:
        """Append the entry of a version: one file, so that readers see all of it or nothing."""
        rows = [(version, None, None, None, list(columns), schema.json())]
        rows += [(version, list(p), load, n, None, None) for p, (load, n) in parts.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def replace(self, df: DataFrame, cluster_by: Sequence[str] = ()) -> int:
        """Make these rows the table, laid out by ``cluster_by`` if given; returns how many they are."""
        version = self.version() + 1
        df = clustered(df, cluster_by) if cluster_by else df
        load, counts = self._write(df, [])
        self._switch(version, df.schema, [], {p: (load, n) for p, n in counts.items()})
        return sum(counts.values())

    def replace_partitions(self, df: DataFrame, columns: Sequence[str], emptied: Sequence[Partition] = ()) -> dict[Partition, int]:
        """Replace the partitions that ``df`` has rows of, and empty those of ``emptied`` that it has none of; all others stay.

        Returns the rows of each replaced partition. Partition columns are texts and come last in the table.
        """
        version, schema, old_columns, parts = self._current()
        names = [*(c for c in df.columns if c not in columns), *columns]
        df = df.select(*names)
        if schema is not None and (old_columns != list(columns) or [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in df.schema]):
            raise ValueError(f"{self.path} has other columns or partitions than the rows to load")
        if any(not isinstance(df.schema[c].dataType, T.StringType) for c in columns):
            raise ValueError("partition columns must be texts")
        load, counts = self._write(df, columns)
        kept = {p: x for p, x in parts.items() if p not in set(emptied)}
        self._switch(version + 1, df.schema, columns, {**kept, **{p: (load, n) for p, n in counts.items()}})
        return counts

    def vacuum(self) -> int:
        """Delete the loads that the current version does not need; returns how many."""
        _, schema, _, parts = self._current()
        if schema is None:
            return 0
        needed = {load for load, _ in parts.values()}
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        unused = [f for f in found if f.startswith("_load=") and f.removeprefix("_load=") not in needed]
        for name in unused:
            delete_folder(self.spark, f"{self.path}/data/{name}")
        return len(unused)
