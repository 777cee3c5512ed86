"""Ranked lexical search: each item of a query set against every document, by hybrid term- and document-at-a-time evaluation.

Documents are read once for each block of items. A task cuts its documents into segments and keeps, for the terms of the items
alone, posting lists in the order of document ids. From the written segments come the counts of the whole corpus; with them
every segment is searched: the short lists of an item are summed term by term into accumulators, which then count as one list
with a bound of its own. That list and the long ones are evaluated document by document, a block of ids at a time: a block is
passed over if the sum of the lists' largest scores in it cannot reach the last of the best documents so far, and within a block
the lists whose bounds cannot reach it alone are only looked up for documents that others have brought up.

A task keeps the best documents of each item over its segments, so what is shuffled grows with tasks and items, not documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import row_bytes, texts, written

TOP = 10
#: Items of one reading of the documents, and so the terms that a task is sent: some hundred bytes an item.
ITEMS_A_BLOCK = 4_000
#: A segment is closed once it holds so many postings, 16 bytes each in a task.
SEGMENT_POSTINGS = 1 << 19
#: Ids of documents that are judged together.
BLOCK_DOCS = 1 << 10
#: A list is short in a segment if it names at most this share of its documents.
SHORT_SHARE = 1 / 16
#: Bytes of a long text whose terms are in memory together.
PIECE = 1 << 20

_LETTERS = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Digits, letters and everything beyond ASCII make terms; other bytes part them. Only A-Z change.
_PLAIN = bytes(_LETTERS[c] if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

_SEGMENT = "n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, ends array<int>, docs array<int>, counts array<int>"


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about ``PIECE`` bytes."""
    plain, start = text.translate(_PLAIN), 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE) if start + PIECE < len(plain) else -1
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def _item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their different terms in blocks; rows with one id are one item. Only a block is on the driver at once."""
    rows = items.select(items[item_col].alias("item_id"), items[text_col].alias("text")).orderBy(F.col("item_id").asc_nulls_first())
    block: list[tuple[int | None, set[bytes]]] = []
    for row in rows.toLocalIterator():
        found = {t for piece in term_pieces((row["text"] or "").encode()) for t in piece}
        if block and block[-1][0] == row["item_id"]:
            block[-1][1].update(found)
            continue
        if len(block) == ITEMS_A_BLOCK:
            yield [(i, sorted(ts)) for i, ts in block]
            block = []
        block.append((row["item_id"], found))
    if block:
        yield [(i, sorted(ts)) for i, ts in block]


class _Segment:
    """Postings of some documents, gathered row by row."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.held: list[int] = []
        self.terms: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, text: bytes, numbers: dict[bytes, int]) -> None:
        length, found = 0, Counter()
        for words in term_pieces(text):
            length += len(words)
            found.update(map(numbers.get, words))
        if not length:
            return
        found.pop(None, None)
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.held.append(len(found))
        self.terms.extend(found.keys())
        self.counts.extend(found.values())

    def batch(self) -> pa.RecordBatch:
        """One row: documents by id, NULL first, and for each term its documents and counts in that order."""
        rows = sorted(range(len(self.ids)), key=lambda r: (self.ids[r] is not None, self.ids[r] or 0))
        place = np.empty(len(rows), np.int32)
        place[rows] = np.arange(len(rows), dtype=np.int32)
        docs = np.repeat(place, self.held)
        terms = np.array(self.terms, np.int32)
        order = np.lexsort((docs, terms))
        names, starts = np.unique(terms[order], return_index=True)
        ends = np.append(starts[1:], len(order))[: len(names)]
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        columns = [
            pa.array([len(rows)], pa.int64()),
            pa.array([sum(self.lengths)], pa.int64()),
            one([self.ids[r] for r in rows], pa.int64()),
            one([self.lengths[r] for r in rows], pa.int64()),
            one(names, pa.int32()),
            one(ends.astype(np.int32), pa.int32()),
            one(docs[order], pa.int32()),
            one(np.array(self.counts, np.int32)[order], pa.int32()),
        ]
        return pa.record_batch(columns, ["n_docs", "n_terms", "doc_ids", "lengths", "terms", "ends", "docs", "counts"])


def segments(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Rows of posting lists: the documents of a task, a bounded number of postings to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Segment()
        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), row_bytes(rows.column(1))):
                held.add(doc_id, text, numbers)
                if len(held.terms) >= SEGMENT_POSTINGS:
                    yield held.batch()
                    held = _Segment()
        if held.ids:
            yield held.batch()

    return docs.mapInArrow(run, _SEGMENT)


def term_weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def _length_parts(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if int(lengths.max(initial=0)) * 90 * n_docs < 1 << 63:
        return 10 + 90 * lengths * n_docs // n_terms
    return np.array([10 + 90 * int(n) * n_docs // n_terms for n in lengths], np.int64)


class _List:
    """Documents in ascending order with their scores, and the largest score in each block of documents."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, n_blocks: int) -> None:
        self.docs, self.scores = docs, scores
        self.edges = np.searchsorted(docs, np.arange(n_blocks + 1) * BLOCK_DOCS)
        self.tops = np.zeros(n_blocks, np.int64)
        full = np.flatnonzero(self.edges[1:] > self.edges[:-1])
        if len(full):
            self.tops[full] = np.maximum.reduceat(scores, self.edges[full])


def _best(scores: np.ndarray, docs: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, -scores))[:top]
    return scores[order], docs[order]


def search_segment(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, least: int, top: int, make) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` documents of a segment with a score of ``least`` or more, as scores and documents, best first.

    ``lists`` holds (documents, scores) of each term; ``make(k)`` gives list ``k`` with its blocks, made once for all items.
    """
    n_blocks = -(-n_docs // BLOCK_DOCS)
    short = [x for x in lists if len(x[0]) <= n_docs * SHORT_SHARE]
    rows = [make(k) for k, x in enumerate(lists) if len(x[0]) > n_docs * SHORT_SHARE]
    if short:  # term at a time
        sums = np.zeros(n_docs, np.int64)
        for docs, scores in short:
            sums[docs] += scores
        at = np.flatnonzero(sums)
        if len(at) >= top:
            least = max(least, int(np.partition(sums[at], len(at) - top)[len(at) - top]))
        rows.append(_List(at.astype(np.int32), sums[at], n_blocks))
    best_scores, best_docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not rows:
        return best_scores, best_docs
    bounds = np.array([r.tops for r in rows])
    reach = bounds.sum(axis=0)
    for block in np.flatnonzero(reach >= least):  # document at a time
        if reach[block] < least:
            continue
        order = np.argsort(bounds[:, block], kind="stable")
        below = np.cumsum(bounds[order, block])
        first = int(np.searchsorted(below, least))  # the lists before it cannot reach ``least`` together
        start = int(block) * BLOCK_DOCS
        sums = np.zeros(min(BLOCK_DOCS, n_docs - start), np.int64)
        for k in order[first:]:
            a, b = rows[k].edges[block], rows[k].edges[block + 1]
            sums[rows[k].docs[a:b] - start] += rows[k].scores[a:b]
        docs = np.flatnonzero(sums)
        scores = sums[docs]
        for i in range(first - 1, -1, -1):
            keep = scores + below[i] >= least
            docs, scores = docs[keep], scores[keep]
            if not len(docs):
                break
            x = rows[order[i]]
            a, b = x.edges[block], x.edges[block + 1]
            if a < b:  # skip ahead to the documents that are left
                at = np.minimum(np.searchsorted(x.docs[a:b], docs + start), b - a - 1)
                scores = scores + np.where(x.docs[a:b][at] == docs + start, x.scores[a:b][at], 0)
        keep = scores >= least
        if keep.any():
            best_scores, best_docs = _best(np.append(best_scores, scores[keep]), np.append(best_docs, docs[keep] + start), top)
            if len(best_docs) == top:
                least = max(least, int(best_scores[-1]))
    return best_scores, best_docs


def _search(found: DataFrame, items: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """Rows (item, doc_id, score): of each item and task the best documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in items]  # (-score, has an id, id)
        for rows in batches:
            for r in range(rows.num_rows):
                ids = rows.column(2)[r].as_py()
                lengths, names, ends, docs, counts = (rows.column(c)[r].values.to_numpy() for c in range(3, 8))
                part = _length_parts(lengths, n_docs, n_terms)
                counts = counts.astype(np.int64)
                shares = 1_000_000_000 * counts // (1000 * counts + 8 * part[docs])
                scores = shares * np.repeat(weights[names], np.diff(ends, prepend=0))
                where = {int(t): (int(a), int(b)) for t, a, b in zip(names, np.append(0, ends[:-1]), ends)}
                n_blocks, made = -(-len(ids) // BLOCK_DOCS), {}
                for number, terms in enumerate(items):
                    mine = [(t, *where[t]) for t in terms if t in where and weights[t] > 0]
                    if not mine:
                        continue

                    def make(k: int, mine: list = mine) -> _List:
                        t, a, b = mine[k]
                        if t not in made:
                            made[t] = _List(docs[a:b], scores[a:b], n_blocks)
                        return made[t]

                    held = best[number]
                    least = -held[-1][0] if len(held) == top else 1
                    got = search_segment([(docs[a:b], scores[a:b]) for _, a, b in mine], len(ids), least, top, make)
                    new = [(-int(s), ids[d] is not None, ids[d] or 0) for s, d in zip(*got)]
                    best[number] = sorted(held + new)[:top]
        flat = [(n, i if has else None, -s) for n, rows in enumerate(best) for s, has, i in rows]
        if flat:
            item, doc, score = zip(*flat)
            yield pa.record_batch([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return found.mapInArrow(run, "item int, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of each item: first among the tasks of a lot, then among all lots."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    lots = found.withColumn("lot", F.spark_partition_id() % 64).withColumn("rank", F.row_number().over(Window.partitionBy("item", "lot").orderBy(*order)))
    lots = lots.where(F.col("rank") <= top)
    ranked = lots.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).drop("lot")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``top`` documents of each item with a score above zero, best first from 1.

    A term's weight grows with how few documents hold it, its part in a document with how often it occurs there against the
    document's length; a document's score sums them over the item's terms. Equal scores rank by ascending id, NULL first. All
    documents are searched. NULL and empty texts have no terms: such a document counts for nothing, such an item has no rows.
    Rows of ``items`` with one id, NULL included, are one item with the terms of all of them; rows of ``docs`` with one id are
    documents each. An empty table on either side gives no rows. Other columns are left aside.
    """
    spark = docs.sparkSession
    given, out = texts(docs, id_col, text_col), []
    for block in _item_blocks(items, item_col, item_text_col):
        terms = sorted({t for _, ts in block for t in ts})
        numbers = {t: i for i, t in enumerate(terms)}
        found = written(segments(given, numbers), "postings")
        n_docs, n_terms = (x or 0 for x in found.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        sizes = F.transform("ends", lambda end, i: end - F.when(i > 0, F.get("ends", i - 1)).otherwise(0))
        holding = found.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), sizes.alias("size"))).alias("x"))
        weights = np.zeros(len(terms), np.int64)
        for term, n in holding.groupBy("x.term").agg(F.sum("x.size")).collect():  # a row for each term of the block at most
            weights[term] = term_weight(n_docs, n)
        rows = _search(found, [[numbers[t] for t in ts] for _, ts in block], weights, n_docs, n_terms, top)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item int, item_id long")
        out.append(_ranked(rows, top).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
