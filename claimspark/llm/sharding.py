"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

A uniformly random order of all rows, cut into shards of given sizes, sends a random number of each partition's rows to each
shard. These numbers are drawn first, exactly: the rooms of the shards are dealt to halves of the partitions, and so on down,
each time by hypergeometric draws. Then each partition permutes its rows locally and gives the first so many to the first
shard, the next to the second; rows go to their shards; and each shard permutes what it has got.

Partitions are runs of at most ``RUN_ROWS`` rows of a task, so none is large. The rows are written once with their run and
place, so that a lost executor cannot change what has been drawn. Only counts are on the driver, one for about ``RUNS_A_BLOCK``
runs; inside such a block a task draws on. A shard of many rows is permuted in cells: a random key deals its rows to cells, and
orders each of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import written

SHARDS = 16
SEED = 42
#: Bits of a row's place in its run.
RUN_BITS = 16
RUN_ROWS = 1 << RUN_BITS
RUNS_A_BLOCK = 1 << 10
#: Rows of a shard that are expected to be ordered in one task.
CELL_ROWS = 1 << 16
#: numpy draws from fewer than this many rows.
_DRAWN = 10**9


def draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many good rows a sample without replacement holds."""
    least, most = max(0, sample - bad), min(good, sample)
    if least == most:
        return least
    if good + bad < _DRAWN:
        return int(rng.hypergeometric(good, bad, sample))
    # too many for numpy: weigh the numbers around the likeliest one, which hold all but a 1e-40th
    total = good + bad
    spread = math.sqrt(sample * (good / total) * (bad / total) * ((total - sample) / max(1, total - 1)))
    mode = (sample + 1) * (good + 1) // (total + 2)
    wide = int(14 * spread) + 64
    k = np.arange(max(least, mode - wide), min(most, mode + wide) + 1, dtype=np.float64)
    ratios = np.log((good - k[:-1]) * (sample - k[:-1])) - np.log((k[:-1] + 1) * (bad - sample + k[:-1] + 1))
    logs = np.concatenate(([0.0], np.cumsum(ratios)))
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(np.searchsorted(weights, rng.random() * weights[-1], side="right"), len(k) - 1)])


def deal(sizes: list[int], rooms: list[int], rng: np.random.Generator) -> np.ndarray:
    """The communication matrix, a row for each part and a column for each shard; sums of rows and columns are as given."""
    out = np.zeros((len(sizes), len(rooms)), np.int64)
    ends = [0, *np.cumsum(np.array(sizes, np.int64)).tolist()]
    todo = [(0, len(sizes), list(rooms))] if len(sizes) else []
    while todo:
        lo, hi, room = todo.pop()
        if hi - lo == 1:
            out[lo] = room
            continue
        mid = (lo + hi) // 2
        sample, rest, left = ends[mid] - ends[lo], sum(room), []
        for size in room:
            got = draw(rng, size, rest - size, sample)
            left.append(got)
            sample, rest = sample - got, rest - size
        todo += [(lo, mid, left), (mid, hi, [a - b for a, b in zip(room, left)])]
    return out


def even_rooms(n: int, shards: int) -> list[int]:
    """Sizes of shards that differ by one row at most."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def _matrix(runs: DataFrame, shards: int, seed: int) -> tuple[DataFrame, int]:
    """Rows (run, n, ends): how many rows the run has, and up to which of them each shard takes; and the number of all rows."""
    spark = runs.sparkSession
    n_blocks = max(1, -(-runs.count() // RUNS_A_BLOCK))
    runs = runs.withColumn("block", F.pmod(F.xxhash64("run"), F.lit(n_blocks)).cast("int"))
    totals = sorted((r["block"], r["n"]) for r in runs.groupBy("block").agg(F.sum("n").alias("n")).collect())
    n = sum(size for _, size in totals)
    top = deal([size for _, size in totals], even_rooms(n, shards), np.random.default_rng([seed, 0]))
    rooms = spark.createDataFrame([(block, row.tolist()) for (block, _), row in zip(totals, top)], "block int, rooms array<long>")

    def below(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("run")
        rng = np.random.default_rng([seed, 1, int(block["block"].iloc[0])])
        dealt = deal(block["n"].tolist(), [int(x) for x in block["rooms"].iloc[0]], rng)
        return pd.DataFrame({"run": block["run"], "n": block["n"], "ends": np.cumsum(dealt, axis=1).tolist()})

    return runs.join(rooms, "block").groupBy("block").applyInPandas(below, "run long, n long, ends array<long>"), n


@lru_cache(maxsize=4)
def _order(seed: int, run: int, n: int) -> np.ndarray:
    return np.random.default_rng([seed, 2, run]).permutation(n)


def _permuted(seed: int):
    """A row's place in the random order of its run."""

    @F.pandas_udf("long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for run, n, at in batches:
            out = np.empty(len(run), np.int64)
            run, n, at = run.to_numpy(), n.to_numpy(), at.to_numpy()
            for r in np.unique(run):
                mine = np.flatnonzero(run == r)
                out[mine] = _order(seed, int(r), int(n[mine[0]]))[at[mine]]
            yield pd.Series(out)

    return place


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """The rows with their shard, from 0, and their slot in it, gapless from 0: a uniformly random order of all of them.

    Numbers of rows of two shards differ by one at most; with fewer rows than shards the last shards are empty. Rows are told
    apart by where they stand, so NULLs, repeated rows and any other values are shuffled alike, and equal rows are not kept
    together. The order depends on ``seed`` and on how the input is partitioned. A column that is named as one of the two new
    ones is replaced. An empty table gives no rows.
    """
    given = rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id"))
    given = written(given.select("row", F.shiftright("id", RUN_BITS).alias("run"), F.col("id").bitwiseAND(RUN_ROWS - 1).alias("at")), "runs")
    runs = written(given.groupBy("run").agg(F.count("*").alias("n")), "run-sizes")
    matrix, n = _matrix(runs, shards, seed)
    matrix = written(matrix, "communication-matrix")
    cells = max(1, -(-n // (shards * CELL_ROWS)))
    placed = given.join(matrix, "run").withColumn("place", _permuted(seed)("run", "n", "at"))
    placed = placed.withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("place"))))
    placed = placed.withColumn("key", F.xxhash64("run", "at", F.lit(seed))).withColumn("cell", F.pmod("key", F.lit(cells)).cast("int"))
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("size"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select("shard", "cell", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")), "cell-starts")
    inside = Window.partitionBy("shard", "cell").orderBy("key", "run", "at")
    numbered = placed.select("row", "shard", "cell", (F.row_number().over(inside) - 1).alias("nth")).join(starts, ["shard", "cell"])
    taken = {shard_col.lower(), slot_col.lower()}
    columns = [F.col("row")[c].alias(c) for c in rows.columns if c.lower() not in taken]
    return numbered.select(*columns, F.col("shard").alias(shard_col), (F.col("start") + F.col("nth")).cast("long").alias(slot_col))


def write_shards(rows: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the shuffled rows as Parquet, a folder ``shard=k`` for each shard, files and rows within by slot."""
    placed = shuffle_into_shards(rows, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def shard_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard) of ``shuffle_into_shards``; a NULL text counts as empty."""
    text = F.coalesce(docs[text_col], F.lit(""))
    narrow = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shuffle_into_shards(narrow, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
