"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

# What the jobs in this package rely on. A cluster sets its own memory, cores and
# shuffle width; AQE coalesces the width down, so it should be set generously.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even if a later step then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide jobs build thousands of column objects; recording a call site for each is most of that time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_own_folders: dict[str, str] = {}


def build_session(app_name: str = "claimspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as ``spark.checkpoint.dir`` names it.

    Only a session within one process (``local`` or ``local[...]``) that lacks the setting gets a folder of its own, which
    is deleted when the process ends.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _own_folders:
        _own_folders[sc.applicationId] = folder = tempfile.mkdtemp(prefix="claimspark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _own_folders[sc.applicationId]


#: Seconds that Spark's cleaner is given after a collection.
FREE_S = 0.2


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of steps that are done.

    It does so once the driver's collector finds that nothing refers to them, which a driver with memory left may not look for
    until the end; until then each step's files would lie beside those of all steps before. Files still needed stay. The
    first collection often finds the last step still held, the second doesn't.
    """
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(FREE_S)


#: Database of bucketed intermediates; its folder is in the shared folder.
SCRATCH = "claimspark_scratch"
#: What the open ``scratch`` blocks have written, the innermost last: folders and tables.
_scopes: list[list[tuple[str, str]]] = []


def _noted(kind: str, what: str) -> None:
    if _scopes:
        _scopes[-1].append((kind, what))


def stored(df: DataFrame, label: str) -> DataFrame:
    """A small or reused intermediate as a written table, so that later plans know its size and prune its columns."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    _noted("folder", path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows go to their buckets in up to so many parts of at least so many bytes as files.
PARTS = 8
PART_BYTES = 32 << 20


def bucketed(df: DataFrame, keys: Sequence[str], label: str, buckets: int | None = None, placed: bool = False) -> DataFrame:
    """The rows as a table in buckets of ``keys``, a file a bucket and part.

    Tables with the same keys and number of buckets meet, group and rank on these keys (and any further ones) where they lie:
    without a shuffle. ``buckets`` is the session's shuffle width unless given. Rows that the last step of ``df`` has put
    together by these keys are ``placed``: they are written as they lie. Others are written as they come first, and go to the
    buckets part by part, so that neither what made them nor all of them are shuffle files beside the table.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"create database if not exists {SCRATCH} location '{shared_folder(spark)}/{SCRATCH}'")
    name = f"{SCRATCH}.{label}_{uuid.uuid4().hex}"
    _noted("table", name)

    def add(rows: DataFrame) -> None:
        # not sorted by the keys: Spark does not rely on the order of the files that it reads
        rows.write.mode("append").option("compression", "zstd").bucketBy(n, *keys).saveAsTable(name)
        free_shuffles(spark)

    if placed:
        add(df)
        return spark.table(name)
    folder = f"{shared_folder(spark)}/{label}-rows-{uuid.uuid4().hex}"
    _noted("folder", folder)
    df.write.option("compression", "zstd").parquet(folder)
    free_shuffles(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    sizes = {s.getPath().getName(): s.getLen() for s in found if s.getPath().getName().startswith("part-")}
    files = [f"{folder}/{f}" for f in sorted(sizes, key=sizes.get)]
    parts = min(PARTS, len(files), 1 + sum(sizes.values()) // PART_BYTES)
    for i in range(parts):
        add(spark.read.schema(df.schema).parquet(*files[i::parts]).repartition(n, *keys))
        for f in files[i::parts]:
            delete_folder(spark, f)
    delete_folder(spark, folder)
    return spark.table(name)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark knows; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediates written inside the block are deleted at its end, whether it succeeds or fails.

    For jobs that end with a write: a DataFrame that leaves the block unread would lose what it reads.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for kind, what in _scopes.pop():
            if kind == "table":
                spark.sql(f"drop table if exists {what}")
            else:
                delete_folder(spark, what)
