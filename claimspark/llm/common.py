"""Helpers shared by the operators: intermediates in the shared folder, and texts as Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.session import shared_folder

#: Texts handled together in one step of a task, in bytes; a longer text is a step of its own.
STEP_BYTES = 1 << 19
#: Part of an Arrow batch that row by row work takes at a time; a whole batch, its texts as Python objects and its results are
#: several times a worker's own memory.
ROW_BYTES = 1 << 22
#: The operator (its module) that this worker did last, and what empties the caches made for it.
_done_last: list[str] = []
_caches: list[Callable[[], object]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate that later steps read more than once; its rows survive the loss of any executor."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides, whatever size Spark takes them for.

    It takes an explode for one row a row and a file for its compressed bytes, and so would collect at the driver, to send it to
    every task, what is many times the size that it allows for that.
    """
    return df.hint("merge")


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``; other columns may have any name."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def row_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes; NULL is empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def row_texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    return [v or "" for v in column.to_pylist()]


def steps(sizes: list[int], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Cut consecutive rows into ranges of at most ``most`` bytes, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def parts(batch: pa.RecordBatch, most: int | None) -> Iterator[pa.RecordBatch]:
    """The batch in runs of equally many rows, of about ``most`` bytes by its mean; whole without ``most``. No rows give none."""
    n = batch.num_rows
    width = n if most is None else max(1, n * most // max(batch.nbytes, 1))
    for start in range(0, n, max(width, 1)):
        yield batch.slice(start, width)


def release() -> None:
    """Give the system back what this worker has freed; numpy's and Python's lie in the C library until it is told to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def begin(operator: str) -> None:
    """Caches last from task to task of one operator; when its worker goes on to another, they are emptied."""
    if _done_last == [operator]:
        return
    _done_last[:] = [operator]
    if _caches:
        while _caches:
            _caches.pop()()
        release()


def cached(empty: Callable[[], object]) -> None:
    """Have ``empty`` called when this worker goes on to another operator."""
    _caches.append(empty)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, most: int | None = None) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; a batch without rows is passed over.

    With ``most``, for work that goes row by row, ``fn`` gets parts of a batch of about so many bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(fn.__module__)
        for batch in batches:
            for part in parts(batch, most):
                yield fn(part)
        release()  # workers serve other operators after this one

    return df.mapInArrow(run, schema)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hex64(col) -> F.Column:
    return F.lpad(F.lower(F.hex(col)), 16, "0")
