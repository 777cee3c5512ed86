"""Load control: overwrites, row counts taken during the write, run and error logs."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("payer", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("date_through_type", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("load_dt", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)
ERROR_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("payer", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("error_time", T.TimestampType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("load_dt", T.DateType()),
        T.StructField("reprocessed", T.StringType()),
    ]
)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def clustered(df: DataFrame, cols: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows laid out by ``cols``: each file holds a range of them, and its row groups follow on each other.

    A reader that filters on the first of these columns passes over files and row groups by their least and greatest values.
    Rows with one value may fill several files, so a frequent value is not one task.
    """
    order = [F.col(c).asc_nulls_last() for c in cols]
    spread = [*order, F.xxhash64(*df.columns)]
    dealt = df.repartitionByRange(files, *spread) if files else df.repartitionByRange(*spread)
    return dealt.sortWithinPartitions(*order)


def overwrite(df: DataFrame, path: str, cluster_by: Sequence[str] = (), **options: str) -> int:
    """Full refresh, laid out by ``cluster_by`` if given; returns the rows written, counted during the write."""
    # counted behind the layout, whose ranges are sampled by reading the rows once before
    counted, seen = _counted(clustered(df, cluster_by) if cluster_by else df)
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**options).parquet(path)
    return int(seen.get["n"])


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str]) -> int:
    """Replace only the partitions present in ``df``; all others survive.

    Rows are rebalanced by the partition columns: small partitions become few files, and a payer
    with a large share of the rows is split over several tasks.
    """
    counted, seen = _counted(df.hint("rebalance", *cols))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    return int(seen.get["n"])


def append(df: DataFrame, path: str) -> int:
    counted, seen = _counted(df)
    counted.write.mode("append").parquet(path)
    return int(seen.get["n"])


@dataclass
class JobLog:
    """Append-only run and error logs; the current state is the latest entry of each run."""

    spark: SparkSession
    root: str
    category: str
    clock: Callable[[], dt.datetime] = dt.datetime.now
    held: list[Exception] = field(default_factory=list)

    @property
    def runs_path(self) -> str:
        return f"{self.root}/run_log"

    @property
    def errors_path(self) -> str:
        return f"{self.root}/error_log"

    def _add(self, path: str, schema: T.StructType, *rows: tuple) -> None:
        if rows:
            self.spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)

    def _head(self, table: str, payer: str, category: str, start: dt.datetime) -> tuple:
        return (table, payer, category, "N/A", start)

    def _error(self, head: tuple, err: Exception) -> dt.datetime:
        table, payer, category, _, start = head
        now = self.clock()
        detail = "".join(traceback.format_exception(err))
        self._add(self.errors_path, ERROR_LOG, (table, payer, category, start, now, type(err).__name__, detail, now.date(), "N"))
        return now

    def _failed(self, head: tuple, err: Exception) -> None:
        now = self._error(head, err)
        self._add(self.runs_path, RUN_LOG, (*head, now, None, now.date(), "Failed", now))

    def run(self, table: str, fn: Callable[[], int], payer: str = "ALL", raise_at_end: bool = False) -> bool:
        """Log a start, run ``fn`` (it returns its row count), log the outcome. A failure does not stop the caller.

        With ``raise_at_end`` the failure is also held, for ``finish`` to raise after the last block.
        """
        start = self.clock()
        head = self._head(table, payer, self.category, start)
        self._add(self.runs_path, RUN_LOG, (*head, None, None, None, None, start))
        try:
            count = fn()
        except Exception as err:  # noqa: BLE001  any failure of one block is logged and isolated
            self._failed(head, err)
            if raise_at_end:
                self.held.append(err)
            return False
        now = self.clock()
        self._add(self.runs_path, RUN_LOG, (*head, now, count, now.date(), "Completed", now))
        return True

    def run_pairs(
        self,
        table: str,
        pairs: Sequence[tuple[str, str]],
        write_all: Callable[[], Mapping[tuple[str, str], int]],
        write_one: Callable[[tuple[str, str]], int],
    ) -> dict[tuple[str, str], bool]:
        """One load of many (payer, LOB) pairs, logged pair by pair; the category of a row is its LOB.

        All pairs are written by ``write_all``, which returns the rows of each. Only if that fails, which is logged as an
        error of payer ``ALL``, is each pair written on its own, so that the bad one is found and the others are loaded.
        """
        start = self.clock()
        heads = {p: self._head(table, p[0], p[1], start) for p in pairs}
        self._add(self.runs_path, RUN_LOG, *((*h, None, None, None, None, start) for h in heads.values()))
        try:
            counts = write_all()
        except Exception as err:  # noqa: BLE001  the pair at fault is found below and logged with its own error
            self._error(self._head(table, "ALL", self.category, start), err)
            return {p: self._one_pair(heads[p], p, write_one) for p in pairs}
        now = self.clock()
        self._add(self.runs_path, RUN_LOG, *((*heads[p], now, counts.get(p, 0), now.date(), "Completed", now) for p in pairs))
        return {p: True for p in pairs}

    def _one_pair(self, head: tuple, pair: tuple[str, str], write_one: Callable[[tuple[str, str]], int]) -> bool:
        try:
            count = write_one(pair)
        except Exception as err:  # noqa: BLE001  one bad pair does not stop the others
            self._failed(head, err)
            return False
        now = self.clock()
        self._add(self.runs_path, RUN_LOG, (*head, now, count, now.date(), "Completed", now))
        return True

    def finish(self) -> None:
        """Raise what the blocks held back, all together; call it after the last block."""
        held, self.held = self.held, []
        if held:
            raise ExceptionGroup("blocks failed", held)

    def state(self) -> DataFrame:
        return latest_runs(self.spark.read.schema(RUN_LOG).parquet(self.runs_path))


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest entry of each run, keyed by table, payer, category and start time."""
    key = ("table_name", "payer", "category", "start_time")
    rest = [f.name for f in RUN_LOG.fields if f.name not in key]
    newest = F.max_by(F.struct(*rest), F.struct("logged_at", F.col("status").isNotNull()))
    return (
        runs.groupBy(*key)
        .agg(newest.alias("_s"))
        .select(*key, *[F.col(f"_s.{n}").alias(n) for n in rest])
    )
