"""Order-independent document fingerprints: a homomorphic multiset hash of paragraphs.

Each paragraph (the text between line breaks) is hashed to a wide vector, and the vectors of a document are summed lane
by lane modulo a power of two. The sum does not depend on the order of the paragraphs, and paragraphs can be put in or
taken out of a fingerprint without the document: see ``insert`` and ``delete``. A vector has three parts:

- ``count``: 1, modulo 2^64;
- ``exact``: eight 32-bit lanes of the paragraph's hash, modulo 2^32, for equality;
- ``sketch``: 64 lanes of the paragraph's sentences, each hashed to one bit a lane, summed with the number of sentences
  modulo 2^32. Twice a lane less the number of sentences is a sum of random signs, so that the angle between the signs of
  two documents estimates what share of their sentences is common.

All of it is DataFrame functions; nothing leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import shuffle_width, texts

EXACT_LANES = 8
SKETCH_LANES = 64
LOW32 = 0xFFFFFFFF
#: Sentences end at a full stop, exclamation or question mark that white space follows.
SENTENCE_END = r"(?<=[.!?])\s+"
_SKETCH_SALT = 97


def _word(h: Column, high: bool) -> Column:
    return F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(LOW32)


def vectors(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows (keys, count, exact, sketch): the summed vector of each row's text; keys must tell the rows apart.

    ``sketch`` has the number of sentences first. A NULL text counts as empty; an empty text is one empty paragraph.
    """
    paragraphs = rows.select(*keys, F.explode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("paragraph"))
    sentences = paragraphs.select(*keys, "paragraph", F.posexplode(F.split("paragraph", SENTENCE_END, -1)).alias("at", "sentence"))
    first = F.col("at") == 0
    lanes = [F.when(first, F.lit(1)).otherwise(0).cast("long").alias("l0")]
    for j in range(EXACT_LANES // 2):
        h = F.when(first, F.xxhash64("paragraph", F.lit(j)))
        lanes += [F.coalesce(_word(h, high), F.lit(0)).cast("long").alias(f"l{len(lanes) + high}") for high in (False, True)]
    n_exact = len(lanes)
    sentences = sentences.select(*keys, *lanes, F.xxhash64("sentence", F.lit(_SKETCH_SALT)).alias("signs"))
    # two lanes of 32 bits in each long: bit j in the low half and bit j + 32 in the high half
    packed = [F.shiftrightunsigned("signs", j).bitwiseAND(0x1_0000_0001) for j in range(32)]
    sums = [F.sum(f"l{j}").alias(f"l{j}") for j in range(n_exact)] + [F.count("*").alias("n")]
    sums += [F.sum(p).alias(f"s{j}") for j, p in enumerate(packed)]
    added = sentences.groupBy(*keys).agg(*sums)
    halves = [_word(F.col(f"s{j}"), high) for high in (False, True) for j in range(32)]
    return added.select(
        *keys,
        F.col("l0").alias("count"),
        F.array(*(F.col(f"l{j}").bitwiseAND(LOW32) for j in range(1, n_exact))).alias("exact"),
        F.array(F.col("n").bitwiseAND(LOW32), *halves).alias("sketch"),
    )


def _added(a: Column, b: Column, sign: int) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + sign * y).bitwiseAND(LOW32))


def insert(a: Column, b: Column) -> Column:
    """The lanes of a document with the paragraphs of both; for ``exact`` and ``sketch``."""
    return _added(a, b, 1)


def delete(a: Column, b: Column) -> Column:
    """The lanes of a document without the paragraphs of ``b``."""
    return _added(a, b, -1)


def as_text(count: Column, exact: Column, sketch: Column) -> Column:
    """The fingerprint as lowercase hex: 16 digits of the count, then 8 for each lane."""
    lanes = F.transform(F.concat(exact, sketch), lambda x: F.lpad(F.hex(x), 8, "0"))
    return F.lower(F.concat(F.lpad(F.hex(count), 16, "0"), F.array_join(lanes, "")))


def _signs(sketch: Column) -> Column:
    """Sums of random signs, from -2^31 on."""
    size = F.get(sketch, F.lit(0))

    def signed(x: Column) -> Column:
        v = (2 * x - size).bitwiseAND(LOW32)
        return F.when(v >= 1 << 31, v - (1 << 32)).otherwise(v).cast("double")

    return F.transform(F.slice(sketch, 2, SKETCH_LANES), signed)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two structs' sketches, from 0 to 1; 1 for equal fingerprints."""
    equal = (a["count"] == b["count"]) & (a["exact"] == b["exact"]) & (a["sketch"] == b["sketch"])
    u, v = _signs(a["sketch"]), _signs(b["sketch"])
    norm = F.sqrt(_dot(u, u) * _dot(v, v))
    cosine = F.when(norm > 0, _dot(u, v) / norm).otherwise(0.0)
    return F.when(equal, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, count, exact, sketch, fingerprint), one for each row of ``docs``.

    Equal texts, and texts with the same paragraphs in any order, have equal fingerprints. A NULL text counts as empty.
    NULL and repeated ids keep their rows apart. An empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return vectors(rows, ["row", "doc_id"], "text").select("doc_id", "count", "exact", "sketch", as_text(F.col("count"), F.col("exact"), F.col("sketch")).alias("fingerprint"))


def _bucket(value: Column, cuts: list[int]) -> Column:
    """How many of the cuts are less than a value, 0 for NULL; found among every so many of them first, then between two of those."""
    step = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    longs = lambda xs: F.array(*(F.lit(int(x)) for x in xs)).cast("array<long>")
    below = lambda xs: F.size(F.filter(xs, lambda c: c < value))
    block = below(longs(b[-1] for b in blocks))  # all cuts of these blocks are less
    inside = F.get(F.array(*(longs(b) for b in blocks), longs([])), block)
    return F.when(value.isNull(), 0).otherwise(block * step + below(inside)).cast("int")


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (bucket, place, doc_id, text, next_text): the next text by ascending id; after the last comes the first.

    Order: NULL ids first, equal ids by text (NULL as empty). The table is dealt once, into ranges of ids of about equal
    size; a range's last row gets the first text of the next range by a join, so no task sorts the whole table.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    n = shuffle_width(spark)
    shares = [k / n for k in range(1, n)] or [1.0]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * n))).first()[0]
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), sorted(set(cuts or []))))
    order = Window.partitionBy("bucket").orderBy(F.asc_nulls_first("doc_id"), "text")
    held = rows.withColumn("place", F.row_number().over(order)).withColumn("after", F.lead("text").over(order))
    # the first text of each bucket, fetched by its id: as many ids as buckets reach the driver
    filled = rows.groupBy("bucket").agg(F.min("doc_id").alias("id"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).orderBy("bucket").collect()
    before = [(filled[k - 1]["bucket"], None if r["nulls"] else r["id"]) for k, r in enumerate(filled)]
    firsts = spark.createDataFrame(before, "bucket int, first_id long")
    heads = rows.withColumnRenamed("bucket", "own").join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")))
    heads = heads.groupBy("bucket").agg(F.min("text").alias("head"))
    out = held.join(heads, "bucket", "left")
    return out.select("bucket", "place", "doc_id", "text", F.coalesce("after", "head").alias("next_text"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document, its edit and its successor, fingerprinted: one row for each row of ``docs``.

    The edit replaces the last quarter of the code points (rounded down) by as many of the next document's first, or by
    all of them. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. NULL
    texts are empty; ids, ties and the empty table as in ``with_next_text``.
    """
    rows = with_next_text(docs, id_col, text_col)
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.expr("left(text, cast(n_chars - floor(n_chars / 4) as int))"), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    keys = ["bucket", "place", "doc_id", "n_chars", "edited_sha256"]
    three = rows.select(*keys, F.posexplode(F.array("text", "edited", "next_text")).alias("which", "part"))
    sums = vectors(three, [*keys, "which"], "part")
    trio = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("which", "count", "exact", "sketch"))).alias("v"))
    own, edit, after = (F.get("v", F.lit(k)) for k in range(3))
    text = lambda v: as_text(v["count"], v["exact"], v["sketch"])
    return trio.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text(own).alias("fingerprint"),
        text(edit).alias("edited_fingerprint"),
        likeness(own, edit).alias("near_edited"),
        likeness(own, after).alias("near_next"),
    )
