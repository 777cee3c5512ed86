"""SimHash near-dedup with anchor points of a covering code.

A fingerprint is cut into two halves of 32 bits. Two fingerprints that differ in at most two bits differ in at most one
bit of one half. The anchors of a half are the words of the perfect [31, 26] Hamming code with one free bit; their
covering radius is 1, so each half has one home anchor, found from its syndrome. Each fingerprint is copied to every anchor
within covering radius plus threshold (1 + 1) of its halves, which meets the home anchor of every half one bit away, and
is compared there with the fingerprints at home. That is at most 17 copies a half, whatever the table holds.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import ROW_BYTES, hex64, map_batches, row_bytes, shuffled, texts, written
from claimspark.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BLOCK = 31
_STEP = 1 << 14
#: Bit j of the syndrome is the parity of these bits of a block: those whose position has bit j.
SYNDROME_MASKS = tuple(sum(1 << (p - 1) for p in range(1, BLOCK + 1) if p >> j & 1) for j in range(5))


def shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """Hashes of the word shingles in order, repeats included; a text of fewer words is one shingle, without words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = iter([tuple(words)]) if len(words) < shingle_words else zip(*(islice(words, k, None) for k in range(shingle_words)))
    join, digest = b" ".join, xxhash.xxh64_intdigest
    return np.fromiter((digest(join(s), SEED) for s in shingles), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _STEP):
        bits = np.unpackbits(hashes[start : start + _STEP].astype(">u8").view(np.uint8))
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the whole text over its word shingles, repeats included; 0 for a text without words."""
    return majority(shingle_hashes(text, shingle_words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp): one for each document, NULL and empty texts with fingerprint 0."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([simhash(t, shingle_words) for t in row_bytes(rows.column(1))], np.uint64).view(np.int64)
        return pa.record_batch([rows.column(0), pa.array(prints)], ["doc_id", "fp"])

    return map_batches(texts(docs, id_col, text_col), batch, "doc_id long, fp long", ROW_BYTES)


def _halves(prints: DataFrame) -> DataFrame:
    """One row for each half: the block of 31 bits, the free bit, the syndrome and the block's nearest code word."""
    halves = prints.select(
        "fp",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("side"), F.col("fp").bitwiseAND(0xFFFFFFFF).alias("bits")),
                F.struct(F.lit(1).cast("long").alias("side"), F.shiftrightunsigned("fp", 32).alias("bits")),
            )
        ).alias("h"),
    ).select("fp", "h.*")
    halves = halves.select("fp", "side", F.col("bits").bitwiseAND((1 << BLOCK) - 1).alias("block"), F.shiftrightunsigned("bits", BLOCK).alias("free"))
    syndrome = sum(
        (F.bit_count(F.col("block").bitwiseAND(m)).bitwiseAND(1) * (1 << j) for j, m in enumerate(SYNDROME_MASKS)), F.lit(0)
    )
    return halves.withColumn("syndrome", syndrome.cast("int")).withColumn("word", F.col("block").bitwiseXOR(_bit(F.col("syndrome"))))


def _bit(position: Column) -> Column:
    """The bit at a position from 1; nothing for position 0."""
    one = F.lit(1).cast("long")
    return F.when(position == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", one, position - 1))


def _anchor(word: Column, free: Column) -> Column:
    return F.call_function("shiftleft", F.col("side"), F.lit(32)).bitwiseOR(F.call_function("shiftleft", free, F.lit(BLOCK))).bitwiseOR(word)


def links(prints: DataFrame) -> DataFrame:
    """Rows (a, b), a < b: all pairs of different fingerprints within two bits; ``prints`` has each fingerprint once."""
    halves = _halves(prints)
    home = halves.select(_anchor(F.col("word"), F.col("free")).alias("anchor"), F.col("fp").alias("a"))
    # step 0 is the home anchor, step 32 the home anchor with the free bit changed, steps 1..31 change two bits whose
    # positions give the syndrome: those are all the code words two bits away
    moves = halves.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(BLOCK + 1))))
    other = F.col("step").bitwiseXOR(F.col("syndrome"))
    pair = F.col("step").between(1, BLOCK) & (F.col("syndrome") != 0) & (F.col("step") < other)
    moves = moves.where(pair | F.col("step").isin(0, BLOCK + 1))
    word = F.when(pair, F.col("block").bitwiseXOR(_bit(F.col("step"))).bitwiseXOR(_bit(other))).otherwise(F.col("word"))
    free = F.when(F.col("step") == BLOCK + 1, F.col("free").bitwiseXOR(1)).otherwise(F.col("free"))
    near = moves.select(_anchor(word, free).alias("anchor"), F.col("fp").alias("b"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    return home.join(shuffled(near), "anchor").where(close).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id): one for each document.

    Documents link if their fingerprints differ in at most two bits; component_id is the least id reachable. NULL and
    empty texts have fingerprint zero and link like any other. Rows with a NULL id are classed too, and their own class
    id is NULL if no row of the class has an id. Repeated rows come back as often as they are given. An empty table gives
    no rows. Equal fingerprints are one node, so a large group of copies costs one row.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes.select("fp")), "a", "b")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents without near copies: of each class only the document with the least id stays, all columns unchanged.

    A row without an id cannot be told from its copies by an id and stays. Repeated rows of the id that stays are one row.
    """
    kept = near_duplicates(docs, id_col, text_col, shingle_words).where("doc_id = component_id").select(F.col("doc_id").alias("__kept_id"))
    named = docs.where(docs[id_col].isNotNull())
    stay = named.join(kept, named[id_col] == kept["__kept_id"], "left_semi").dropDuplicates([id_col])
    return stay.unionByName(docs.where(docs[id_col].isNull()))
