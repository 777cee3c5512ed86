"""Language ID by Bloom filters that answer for all languages at once.

The filter is bit-sliced: a slot holds one bit for each language, and the slots of an n-gram, combined by AND, are the mask of
all languages that have it. A text's n-grams are looked up once; the set bits are counted for each language, the count
that false positives alone would give is taken off, and the language with the largest share decides.

What a language has is learned from a bounded sample of labelled rows: at most about ``TRAIN_DOCUMENTS`` documents a
language, chosen by the hash of their text. An n-gram belongs to a language if its share there is at least ``SHARE_OF_MOST``
of its share in the language that has most of it, so that stray passages in another language do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import ROW_BYTES, begin, map_batches, parts, release, row_texts, steps, texts

TRAIN_DOCUMENTS = 2_000
#: N-grams of a language that the filters hold, the most frequent ones of the sample: it bounds what every task is sent.
GRAMS_A_LANGUAGE = 40_000
ORDERS = (1, 2, 3, 4)
SHARE_OF_MOST = 0.15
LEAST_SEEN = 2
#: Texts whose n-grams are counted together, in bytes.
COUNT_BYTES = 1 << 20
SLOTS_LOG2 = 20
UNKNOWN = "und"
#: A text of which less than this share is known in the best language is rejected by the pipeline.
LEAST_SHARE = 0.2
_SPACE = 32
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once in each worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _prepared(texts_: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with each run of other than letters as one space, two spaces between texts; each text's start and letters."""
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts_]
    sizes = np.array([len(c) for c in codes])
    joined = np.concatenate(codes)
    letter = _letters()[joined]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first of a run of other characters stays, as a space
    kept[starts] = True
    kept[starts + sizes - 1] = True
    counts = np.add.reduceat(kept, starts, dtype=np.int64)
    n_letters = np.add.reduceat(letter, starts, dtype=np.int64)
    out = np.where(letter, joined, _SPACE)[kept].astype(np.uint64)
    return out, np.concatenate([[0], np.cumsum(counts)[:-1]]), n_letters


def _grams(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each n-gram and whether it counts: one without two spaces together, and not a space alone."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h = np.full(n, order, np.uint64)
    for k in range(order):
        h = h * np.uint64(0x100000001B3) + codes[k : n + k]
    h ^= h >> np.uint64(29)
    space = codes == _SPACE
    bad = space[:n].copy() if order == 1 else np.zeros(n, bool)
    for k in range(order - 1):
        bad |= space[k : n + k] & space[k + 1 : n + k + 1]
    return h, ~bad


@dataclass(frozen=True)
class Filters:
    """Bit-sliced filters: ``slots[i, l // 8]`` has bit ``l % 8`` if slot i is set for language l."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_rate: np.ndarray

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        out = None
        for m in _MULTIPLIERS:
            got = self.slots[(hashes * np.uint64(m)) >> np.uint64(64 - SLOTS_LOG2)]
            out = got if out is None else out & got
        return out

    def shares(self, texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language the corrected share of its n-grams; and each text's number of letters."""
        codes, starts, letters = _prepared(texts_)
        hits = np.zeros((len(texts_), len(self.languages)))
        total = np.zeros(len(texts_))
        for order in ORDERS:
            hashes, counts = _grams(codes, order)
            if not len(hashes):
                continue
            inside = np.minimum(starts, len(hashes) - 1)
            masks = self.masks(hashes)
            masks[~counts] = 0
            total += np.add.reduceat(counts, inside, dtype=np.int64)
            for i in range(len(self.languages)):
                hits[:, i] += np.add.reduceat((masks[:, i // 8] >> np.uint8(i % 8)) & np.uint8(1), inside, dtype=np.int64)
        expected = total[:, None] * self.false_rate
        shares = (hits - expected) / np.maximum(total[:, None] - expected, 1)
        return np.clip(shares, 0, 1), letters

    def predict(self, texts_: list[str]) -> list[tuple[str, float]]:
        if not self.languages or not texts_:
            return [(UNKNOWN, 0.0)] * len(texts_)
        shares, letters = self.shares(texts_)
        best = shares.argmax(axis=1)  # the first language in order among equals
        return [(self.languages[b], float(shares[i, b])) if letters[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(labelled: DataFrame, documents: int = TRAIN_DOCUMENTS) -> Filters:
    """Filters from rows (text, lang); rows with a NULL in either teach nothing, and so do texts without letters."""
    rows = labelled.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Filters((), np.zeros((1, 1), np.uint8), np.zeros(0))
    index = F.create_map(*(x for i, name in enumerate(languages) for x in (F.lit(name), F.lit(i))))
    share = F.create_map(*(x for name in languages for x in (F.lit(name), F.lit(min(1.0, documents / sizes[name])))))
    chosen = rows.where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    chosen = chosen.select(index[F.col("lang")].alias("lang"), "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, whole = np.asarray(batch.column(0)), row_texts(batch.column(1))
        out = []
        for lang in np.unique(langs):
            own = [t for t, k in zip(whole, langs) if k == lang]
            for a, b in steps([len(t) for t in own], COUNT_BYTES):
                codes, _, _ = _prepared(own[a:b])
                for order in ORDERS:  # one after the other: their hashes are eight times the text each, and sorted
                    hashes, counts = _grams(codes, order)
                    grams, seen = np.unique(hashes[counts], return_counts=True)
                    out.append((np.full(len(grams), lang, np.int32), grams.view(np.int64), seen.astype(np.int64)))
        columns = [pa.array(np.concatenate([x[k] for x in out])) for k in range(3)]
        return pa.record_batch(columns, ["lang", "gram", "seen"])

    counted = map_batches(chosen, count, "lang int, gram long, seen long").groupBy("lang", "gram").agg(F.sum("seen").alias("seen"))
    by_lang, by_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    counted = counted.withColumn("share", F.col("seen") / F.sum("seen").over(by_lang))
    counted = counted.withColumn("most", F.max("share").over(by_gram))
    own = counted.where((F.col("share") >= SHARE_OF_MOST * F.col("most")) & (F.col("seen") >= LEAST_SEEN))
    top = own.withColumn("place", F.row_number().over(by_lang.orderBy(F.desc("seen"), "gram"))).where(F.col("place") <= GRAMS_A_LANGUAGE)
    slots = np.zeros((1 << SLOTS_LOG2, -(-len(languages) // 8)), np.uint8)
    table = top.select("lang", "gram").toArrow()
    langs, grams = np.asarray(table.column("lang")), np.asarray(table.column("gram")).view(np.uint64)
    for m in _MULTIPLIERS:
        at = (grams * np.uint64(m)) >> np.uint64(64 - SLOTS_LOG2)
        np.bitwise_or.at(slots, (at, langs // 8), (1 << (langs % 8)).astype(np.uint8))
    fill = np.array([((slots[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))])
    return Filters(languages, slots, fill ** len(_MULTIPLIERS))


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score): one for each document, over its whole text.

    ``und`` with score 0 for a NULL text, a text without a letter, or if nothing was learned. Otherwise the learned language
    with the largest share of n-grams, the first in order among equals; the share is the score. Ids may be NULL or
    repeated; other columns are never read. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        whole = row_texts(rows.column(1))
        found: list[tuple[str, float]] = []
        for a, b in steps([len(t) for t in whole]):
            found += sent.value.predict(whole[a:b])
        return pa.record_batch([rows.column(0), pa.array([x[0] for x in found]), pa.array([x[1] for x in found])], ["doc_id", "lang_pred", "score"])

    return map_batches(texts(docs, id_col, text_col), batch, "doc_id long, lang_pred string, score double", ROW_BYTES)


def learn(docs: DataFrame) -> Filters:
    """Filters from the documents that are not held out; columns doc_id, text, lang."""
    return train(docs.where(~held_out(docs["doc_id"])).select("text", "lang"))


def identify(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score) of ``documents``, learned from its rows that are not held out."""
    return predict(docs, learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    """The documents, all columns unchanged, whose text has a letter and is known to some learned language.

    If no row is labelled there is nothing to judge by, and all documents stay. Else documents with a NULL or empty text go, and
    repeated rows stay or go together. An empty table gives no rows.
    """
    filters = learn(docs)
    if not filters.languages:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("boolean")
    def known(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin(__name__)
        for column in columns:
            out: list[bool] = []
            for part in parts(pa.record_batch([column], ["text"]), ROW_BYTES):
                whole = row_texts(part.column(0))
                for a, b in steps([len(t) for t in whole]):
                    out += [lang != UNKNOWN and score >= least for lang, score in sent.value.predict(whole[a:b])]
            yield pa.array(out, pa.bool_())
        release()

    return docs.where(known(docs["text"]))
