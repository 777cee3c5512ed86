"""Exact repeats of a fixed length in a corpus, dealt to shards by anchors.

A window is ``window`` consecutive symbols of one document. Its anchor is the least hash of its n-grams, so equal windows have
equal anchors, wherever they stand. A piece is a longest run of windows with one anchor, with all the symbols they cover;
every window is in one piece. All windows that could be equal meet in the shard of their anchor, and an operator's solver
finds the repeats there. Before that, equal pieces are counted and become one row, so that a large group of copies costs
little; the pieces of an anchor seen once are dropped. An anchor with very many symbols is dealt out again by second
anchors of another hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import row_bytes, steps, texts, written

#: Symbols that one solver call takes, if one anchor's pieces don't hold more.
SHARD_SYMBOLS = 1 << 20
#: Anchors with more symbols than this in their different pieces are dealt out by second anchors.
HEAVY_SYMBOLS = 1 << 19
CACHE_WORDS = 200_000
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ALL_BITS = (1 << 64) - 1


class _Codes(dict):
    """A 64-bit code for each word; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


@dataclass(frozen=True)
class Unit:
    """What a text is a sequence of. ``joint`` stands between symbols."""

    window: int
    gram: int
    words: bool
    codes: dict = field(default_factory=_Codes, compare=False)

    def __reduce__(self):
        return Unit, (self.window, self.gram, self.words)

    def split(self, text: bytes):
        return text.split() if self.words else text

    def join(self, symbols) -> bytes:
        return b" ".join(symbols) if self.words else bytes(symbols)

    def coded(self, symbols) -> np.ndarray:
        if self.words:
            return np.fromiter(map(self.codes.__getitem__, symbols), np.uint64, len(symbols))
        return np.frombuffer(symbols, np.uint8)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def cut(codes: np.ndarray, sizes: list[int], unit: Unit, seed: int = 0) -> tuple[np.ndarray, ...]:
    """Pieces of consecutive documents: document, first symbol counted from ``codes``, number of symbols, anchor, and whether
    the anchor stands in the piece more than once, without which its windows are all different."""
    window, gram = unit.window, unit.gram
    sizes = np.asarray(sizes, np.int64)
    ends = np.cumsum(sizes)
    n_windows = np.maximum(sizes - window + 1, 0)
    total = int(n_windows.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    h, have = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD[seed % 2]), 1
    factor = _ODD[(seed + 1) % 2]
    while have < gram:
        step = min(have, gram - have)
        h = h[: len(h) - step] * np.uint64(factor) + h[step:]  # step <= have: both parts together cover have + step symbols
        have += step
        factor = factor * factor & _ALL_BITS
    grams, span = _mixed(h), window - gram + 1
    low = _sliding(grams, span, np.minimum)
    at = np.arange(total) + np.repeat(ends - sizes - (np.cumsum(n_windows) - n_windows), n_windows)
    doc = np.repeat(np.arange(len(sizes)), n_windows)
    anchor = low[at]
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    runs = np.diff(first, append=total)
    starts, anchors = at[first], anchor[first]
    return doc[first], starts, runs + window - 1, anchors, _often(grams, low, span, starts, runs, anchors)


def _sliding(x: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    have = 1
    while have < span:
        step = min(have, span - have)
        x = pick(x[: len(x) - step], x[step:])
        have += step
    return x


def _often(grams: np.ndarray, low: np.ndarray, span: int, starts: np.ndarray, runs: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Whether each piece has its anchor at more than one place."""
    # a gram is some window's anchor if it equals the largest of the anchors of the windows that hold it
    edge = np.zeros(span - 1, np.uint64)
    places = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), span, np.maximum) == grams)
    lo, hi = np.searchsorted(places, starts), np.searchsorted(places, starts + runs + span - 1)
    count = hi - lo
    inside = np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)
    own = grams[places[inside]] == np.repeat(anchors, count)
    piece = np.repeat(np.arange(len(starts)), count)
    return np.bincount(piece[own], minlength=len(starts)) > 1


def _digests(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    view, width = memoryview(np.ascontiguousarray(codes)).cast("B"), codes.itemsize
    digest = xxhash.xxh3_64_intdigest
    pairs = zip((starts * width).tolist(), ((starts + sizes) * width).tolist())
    return np.fromiter((digest(view[a:b]) for a, b in pairs), np.uint64, len(starts))


def _batch_pieces(batch: pa.RecordBatch, unit: Unit) -> Iterator[tuple[np.ndarray, ...]]:
    """(row of the batch, start in the document, symbols, anchor, digest of the symbols, anchor stands there more than once)."""
    whole = row_bytes(batch.column(1))
    for a, b in steps([len(t) for t in whole], 1 << 18):
        split = [unit.split(t) for t in whole[a:b]]
        sizes = [len(s) for s in split]
        codes = np.concatenate([unit.coded(s) for s in split])
        doc, at, n, anchor, often = cut(codes, sizes, unit)
        begins = np.cumsum(sizes) - np.asarray(sizes)
        yield doc + a, at - begins[doc] if len(doc) else at, n, anchor, _digests(codes, at, n), often


def _gathered(batch: pa.RecordBatch, unit: Unit) -> list[np.ndarray]:
    parts = list(_batch_pieces(batch, unit))
    return [np.concatenate([p[k] for p in parts]) for k in range(6)]


def _keyed(docs: DataFrame) -> DataFrame:
    """A document is known by its id and the hash of its text; rows equal in both get equal results."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))


def _counted(docs: DataFrame, unit: Unit) -> DataFrame:
    """Rows (anchor, digest, n, copies, often, doc_id, text_hash, start): equal pieces of a batch are one row with one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, start, n, anchor, digest, often = _gathered(batch, unit)
            order = np.lexsort((digest, anchor))
            new = np.ones(len(order), bool)
            new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (digest[order][1:] != digest[order][:-1])
            first = np.flatnonzero(new)
            copies, one = np.diff(first, append=len(order)), order[first]
            yield pa.record_batch(
                [
                    pa.array(anchor[one].view(np.int64)),
                    pa.array(digest[one].view(np.int64)),
                    pa.array(n[one]),
                    pa.array(copies.astype(np.int64)),
                    pa.array(often[one]),
                    batch.column(0).take(pa.array(row[one])),
                    batch.column(2).take(pa.array(row[one])),
                    pa.array(start[one]),
                ],
                ["anchor", "digest", "n", "copies", "often", "doc_id", "text_hash", "start"],
            )

    schema = "anchor long, digest long, n long, copies long, often boolean, doc_id long, text_hash long, start long"
    return docs.select("doc_id", "text", "text_hash").mapInArrow(run, schema)


def _placed(docs: DataFrame, unit: Unit) -> DataFrame:
    """Rows (anchor, digest, doc_id, text_hash, start): every piece in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, start, _, anchor, digest, _ = _gathered(batch, unit)
            at = pa.array(row)
            yield pa.record_batch(
                [pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)), batch.column(0).take(at), batch.column(2).take(at), pa.array(start)],
                ["anchor", "digest", "doc_id", "text_hash", "start"],
            )

    return docs.select("doc_id", "text", "text_hash").mapInArrow(run, "anchor long, digest long, doc_id long, text_hash long, start long")


def _bodies(wanted: DataFrame, docs: DataFrame, unit: Unit) -> DataFrame:
    """Rows (shard, anchor, digest, shift, once, body): the symbols of each wanted piece, heavy anchors' pieces cut again."""
    per_doc = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "digest", "start", "n", "once", "heavy")).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, pieces in zip(row_bytes(batch.column(0)), batch.column(1).to_pylist()):
                symbols = unit.split(text)
                for p in pieces:
                    own = symbols[p["start"] : p["start"] + p["n"]]
                    name = (p["anchor"], p["digest"])
                    if not p["heavy"]:
                        out.append((p["anchor"], *name, 0, p["once"], unit.join(own)))
                        continue
                    _, at, n, second, _ = cut(unit.coded(own), [len(own)], unit, seed=1)
                    shards = _mixed(second ^ np.uint64(p["anchor"] % (1 << 64))).view(np.int64)
                    out += [(s, *name, a, p["once"], unit.join(own[a : a + k])) for s, a, k in zip(shards.tolist(), at.tolist(), n.tolist())]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["shard", "anchor", "digest", "shift", "once", "body"])

    joined = per_doc.join(docs, per_doc["doc_id"].eqNullSafe(docs["doc_id"]) & (per_doc["text_hash"] == docs["text_hash"]))
    # rows equal in id and text give each piece as often; the solver's task takes such a piece once
    joined = joined.select(docs["text"], "pieces", docs["doc_id"], docs["text_hash"])
    return joined.select("text", "pieces").mapInArrow(run, "shard long, anchor long, digest long, shift long, once boolean, body binary")


#: From the bodies of a shard, the runs of symbols of each that repeated windows cover, as flat lists of first and end.
Solver = Callable[[list[bytes]], list[list[int]]]


def _solved(bodies: DataFrame, unit: Unit, solver: Solver) -> DataFrame:
    """Rows (anchor, digest, spans) of the pieces seen once; a task holds the different bodies of whole shards up to a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bool, bytes]] = []
        ready: list[tuple[int, int, list[int]]] = []
        size, last_shard, last_body, last_owner, twice = 0, None, None, None, False

        def solve() -> None:
            for (anchor, digest, shift, once, _), spans in zip(held, solver([h[4] for h in held])):
                if once and spans:
                    ready.append((anchor, digest, [x + shift for x in spans]))
            held.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*ready)) or [(), (), ()]
            ready.clear()
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "digest", "spans"])

        for batch in batches:
            for shard, anchor, digest, shift, once, body in zip(*(c.to_pylist() for c in batch.columns)):
                owner = (anchor, digest, shift)
                if shard == last_shard and body == last_body:
                    # the same symbols: a row given twice, or another piece, and then all of them repeat
                    if owner != last_owner:
                        n = len(unit.split(body))
                        first = held[-1]
                        if not twice and first[3]:
                            ready.append((first[0], first[1], [first[2], first[2] + n]))
                        if once:
                            ready.append((anchor, digest, [shift, shift + n]))
                        twice, last_owner = True, owner
                    continue
                if shard != last_shard and size >= SHARD_SYMBOLS:
                    solve()
                    size = 0
                held.append((anchor, digest, shift, once, body))
                size += len(body)
                last_shard, last_body, last_owner, twice = shard, body, owner, False
                if len(ready) > 10_000:
                    yield flush()
        if held:
            solve()
        yield flush()

    dealt = bodies.repartition("shard").sortWithinPartitions("shard", "body", "anchor", "digest", "shift")
    return dealt.mapInArrow(run, "anchor long, digest long, spans array<long>")


def repeated_spans(docs: DataFrame, unit: Unit, solver: Solver) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, rows (doc_id, text_hash, found)): what repeats in each document, as starts with flat spans."""
    docs = _keyed(docs)
    counted = _counted(docs, unit).repartition("anchor")
    pieces = counted.groupBy("anchor", "digest", "n").agg(
        F.sum("copies").alias("copies"), F.max("often").alias("often"), F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("start").alias("start")
    )
    # the anchor's pieces are together already; they are summed up without another deal or reading
    own = Window.partitionBy("anchor")
    sums = {"seen": F.sum("copies"), "kinds": F.count("*"), "symbols": F.sum("n"), "any_often": F.max("often")}
    again = pieces.withColumns({name: total.over(own) for name, total in sums.items()}).where("seen > 1 or any_often")
    again = written(again.drop("seen", "often"), "pieces")
    mixed = again.where("kinds > 1 or any_often").select(
        "anchor", "digest", "n", "doc_id", "text_hash", "start", (F.col("copies") == 1).alias("once"), (F.col("symbols") > HEAVY_SYMBOLS).alias("heavy")
    )
    solved = _solved(_bodies(mixed, docs, unit), unit, solver)
    whole = again.where("copies > 1").select("anchor", "digest", F.array(F.lit(0).cast("long"), "n").alias("spans"))
    placed = _placed(docs, unit)
    found = placed.join(whole.unionByName(solved), ["anchor", "digest"]).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "spans")).alias("found"))
    return docs, found


def merged(found: list[dict] | None, n: int) -> list[tuple[int, int]]:
    """Removed runs of one document, in order, none touching the next."""
    if not found:
        return []
    edge = np.zeros(n + 1, np.int64)
    flat = np.array([x["start"] + v for x in found for v in x["spans"]], np.int64)
    np.add.at(edge, flat[::2], 1)
    np.add.at(edge, flat[1::2], -1)
    inside = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def kept_symbols(symbols, runs: list[tuple[int, int]]) -> list:
    """What is left, as slices in order."""
    out, at = [], 0
    for a, b in runs:
        out.append(symbols[at:a])
        at = b
    return [*out, symbols[at:]]


def per_document(docs: DataFrame, unit: Unit, solver: Solver, one: Callable, schema: str, id_col: str, text_col: str) -> DataFrame:
    """Apply ``one(text, runs) -> tuple`` to each document with its removed runs; one row for each row of ``docs``."""
    docs, found = repeated_spans(texts(docs, id_col, text_col), unit, solver)
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]) & (docs["text_hash"] == found["text_hash"]), "left")
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(text, merged(f, len(unit.split(text)))) for text, f in zip(row_bytes(batch.column(1)), batch.column(2).to_pylist())]
            columns = [batch.column(0), *(pa.array(c) for c in zip(*rows))] if rows else []
            if columns:
                yield pa.record_batch(columns, names)

    return joined.select(docs["doc_id"], docs["text"], found["found"]).mapInArrow(run, schema)
