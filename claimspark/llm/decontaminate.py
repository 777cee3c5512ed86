"""Benchmark decontamination by windows of canonical templates.

Words are lower-cased and freed of punctuation; numbers, capitalised names, and units behind a number become typed
placeholders, so that a question with other numbers and names has the same template. Windows of five such tokens are hashed
and joined to those of the benchmark. A matching window is evidence only if what fills its placeholders is consistent: over
all matches of one occurrence of the item, each slot of the item must be filled by one value of the document and the other
way round. A document is contaminated by an item if consistent windows of one occurrence, or of the document as a whole,
cover at least 0.8 of the item's windows.

A window with fewer than two words of its own is too general as a template and is hashed by what fills it. Every other window
has that hash too, so that a copy in other letter case, whose names are told from words otherwise, still matches.

An item of under five tokens may be a word that most documents hold. It is one window, hashed by what fills it, and only met
by lines that have no other tokens; such matches are reported, but no document is cleaned away for them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import ROW_BYTES, begin, map_batches, parts, release, row_texts, steps, texts, written

WINDOW = 5
COVERAGE = 0.8
LEAST_WORDS = 2
#: Benchmark windows up to this number are sent to every task, 8 bytes each; above it both sides are shuffled.
BROADCAST_WINDOWS = 1_000_000
#: Units of measure in the singular and plural, as words and symbols.
UNITS = frozenset(
    (
        "mm cm m km in inch inches ft foot feet yd yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres"
        " mg g kg t oz lb lbs gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces"
        " ml cl l liter liters litre litres gallon gallons"
        " s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years"
        " % ° c f percent degree degrees cent cents dollar dollars euro euros usd eur"
        " kb mb gb tb hz khz mhz ghz w kw kwh v mph kmh"
    ).split()
)
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|(?<=\d)[%°]|[^\W\d_]+(?:['’-][^\W\d_]+)*").findall
_WORD, _NUMBER, _NAME, _UNIT = range(4)
_KINDS = np.array([0x51, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_BITS = 20
_CACHE = 200_000


class _Coded(dict):
    """For each token the hash of its lower case, with its kind in the last two bits."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token[0].isdigit():
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT  # if a number stands before it
        elif len(token) > 1 and token[0].isupper() and not token.isupper():
            kind = _NAME
        else:
            kind = _WORD
        if len(self) >= _CACHE:
            self.clear()
        code = self[token] = xxhash.xxh3_64_intdigest(low.encode()) & ~3 | kind
        return code


_coded = _Coded()


def _places(sizes: np.ndarray, begins: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first token in the joined texts) of every window of ``width`` tokens."""
    count = np.maximum(sizes - width + 1, 0)
    at = np.arange(count.sum()) + np.repeat(begins - (np.cumsum(count) - count), count)
    return np.repeat(np.arange(len(sizes)), count), at


def _chain(codes: np.ndarray, width: int, start: int) -> np.ndarray:
    """A hash of the ``width`` codes from each place on."""
    n = len(codes) - width + 1
    h = np.full(n, start, np.uint64)
    for k in range(width):
        h = h * _FACTOR + codes[k : n + k]
    h = (h ^ (h >> np.uint64(31))) * _FACTOR
    return h ^ (h >> np.uint64(29))


def _windows(token_lists: list[list[str]], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token in the joined texts, tokens, hash) of every window, and whether each token is a slot.

    With ``whole`` a text of fewer tokens than a window is a window too.
    """
    sizes = np.array([len(t) for t in token_lists], np.int64)
    coded = np.fromiter((_coded[t] for tokens in token_lists for t in tokens), np.uint64, int(sizes.sum()))
    kind, own = coded & np.uint64(3), coded & ~np.uint64(3)
    begins = np.cumsum(sizes) - sizes
    after_number = np.zeros(len(kind), bool)
    after_number[1:] = kind[:-1] == _NUMBER
    after_number[begins[sizes > 0]] = False
    kind = np.where((kind == _UNIT) & ~after_number, _WORD, kind)
    slot = kind != _WORD
    parts = []
    text, at = _places(sizes, begins, WINDOW)
    if len(at):
        template = np.where(slot, _KINDS[kind], own)
        words = np.cumsum(np.concatenate([[0], ~slot]))
        general = ((words[WINDOW:] - words[:-WINDOW]) < LEAST_WORDS)[at]
        free, filled = _chain(template, WINDOW, 0)[at], _chain(own, WINDOW, WINDOW + 2)[at]
        parts.append((text, at, np.full(len(at), WINDOW), filled))
        parts.append((text[~general], at[~general], np.full(int((~general).sum()), WINDOW), free[~general]))
    for width in range(1, WINDOW) if whole else ():
        text, at = _places(np.where(sizes == width, sizes, 0), begins, width)
        if len(at):
            parts.append((text, at, np.full(len(at), width), _chain(own, width, width + 2)[at]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), slot
    return *(np.concatenate(p) for p in zip(*parts)), slot


def _found(texts_: list[str], only: tuple[np.ndarray, np.ndarray] | None, whole: bool) -> Iterator[tuple[int, int, int, list[str], list[bool], int]]:
    """(text, position, hash, tokens of the window in lower case, which are slots, windows of the text)."""
    for a, b in steps([len(t) for t in texts_]):
        token_lists = [_TOKEN(t) for t in texts_[a:b]]
        text, at, width, h, slot = _windows(token_lists, whole)
        if not len(at):
            continue
        hit = np.arange(len(at))
        if only is not None:
            coarse, exact = only
            hit = np.flatnonzero(coarse[h >> np.uint64(64 - _BITS)])
            place = np.minimum(np.searchsorted(exact, h[hit]), len(exact) - 1)
            hit = hit[exact[place] == h[hit]]
        begins = np.cumsum([0, *map(len, token_lists)])
        for i in hit.tolist():
            t = int(text[i])
            p = int(at[i] - begins[t])
            n = int(width[i])
            tokens = [x.lower() for x in token_lists[t][p : p + n]]
            yield t + a, p, int(h[i]), tokens, slot[at[i] : at[i] + n].tolist(), max(len(token_lists[t]) - WINDOW + 1, 1)


def _found_lines(texts_: list[str], only: tuple[np.ndarray, np.ndarray] | None) -> Iterator[tuple[int, int, int, list[str], list[bool], int]]:
    """As ``_found``, for the lines of fewer tokens than a window, each a text of its own."""
    for row, text in enumerate(texts_):
        for line in text.split("\n"):
            if len(_TOKEN(line)) < WINDOW:
                for _, *found in _found([line], only, True):
                    yield row, *found


def _window_table(rows: DataFrame, only=None, whole: bool = False, lines: bool = False) -> DataFrame:
    """Rows (id, text_hash, hash, pos, tokens, slots, windows) of the windows of (id, text, text_hash).

    A window may have two rows, for its template and for what fills it. ``whole`` as in ``_windows``; ``lines`` adds short lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        sought = only.value if only is not None else None
        for batch in chain.from_iterable(parts(b, ROW_BYTES) for b in batches):
            part: list[tuple] = []
            texts_ = row_texts(batch.column(1))
            for found in chain(_found(texts_, sought, whole), _found_lines(texts_, sought) if lines else ()):
                part.append(found)
                if len(part) >= 20_000:
                    yield packed(batch, part)
                    part = []
            if part:
                yield packed(batch, part)
        _coded.clear()  # workers serve other operators after this one
        release()

    def packed(batch: pa.RecordBatch, part: list[tuple]) -> pa.RecordBatch:
        row, pos, h, tokens, slots, windows = zip(*part)
        at = pa.array(row)
        columns = [
            batch.column(0).take(at),
            batch.column(2).take(at),
            pa.array(np.array(h, np.uint64).view(np.int64)),
            pa.array(pos, pa.int32()),
            pa.array(tokens, pa.list_(pa.string())),
            pa.array(slots, pa.list_(pa.bool_())),
            pa.array(windows, pa.int32()),
        ]
        return pa.record_batch(columns, ["id", "text_hash", "hash", "pos", "tokens", "slots", "windows"])

    schema = "id long, text_hash long, hash long, pos int, tokens array<string>, slots array<boolean>, windows int"
    return rows.select("id", "text", "text_hash").mapInArrow(run, schema)


def consistent_share(matches: list[dict], windows: int) -> float:
    """Share of an item's windows that are matched with consistent slots.

    Each match has the positions in item and document, the tokens of both and which of them are slots. A slot's value of the
    item goes with the value of the document that most matches give it, and the other way round; among equals the first in
    order. Matches that fill a slot otherwise don't count.
    """
    votes: Counter = Counter()
    for m in matches:
        votes.update({(a, b) for a, b, s in zip(m["own"], m["tokens"], m["slots"]) if s})
    to: dict[str, str] = {}
    back: dict[str, str] = {}
    for (a, b), _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
        if a not in to and b not in back:
            to[a], back[b] = b, a
    good = {m["item_pos"] for m in matches if all(to.get(a) == b for a, b, s in zip(m["own"], m["tokens"], m["slots"]) if s)}
    return len(good) / windows


def best_share(matches: list[dict], windows: int, least: float) -> float:
    """The best consistent share over all occurrences of the item in a document, and over the document as a whole.

    An occurrence is where matches put the item's first window. To it belong the matches that put it there, up to ``WINDOW``
    places beside it, or, as words may be added and left out, all matches in a stretch of the item's length. Occurrences
    with too few item windows for ``least`` are passed over, so a share below it need not be the best.
    """
    best = consistent_share(matches, windows)
    by_start = sorted(matches, key=lambda m: m["pos"] - m["item_pos"])
    by_pos = sorted(matches, key=lambda m: m["pos"])
    starts, places = [m["pos"] - m["item_pos"] for m in by_start], [m["pos"] for m in by_pos]
    for start in sorted(set(starts)):
        if best >= 1:
            break
        near = by_start[bisect_left(starts, start - WINDOW) : bisect_right(starts, start + WINDOW)]
        stretch = by_pos[bisect_left(places, start - WINDOW) : bisect_right(places, start + windows - 1 + WINDOW)]
        for group in (near, stretch):
            most = len({m["item_pos"] for m in group}) / windows
            if most >= least and most > best:
                best = max(best, consistent_share(group, windows))
    return best


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
    short_items: bool = True,
) -> DataFrame:
    """Rows (doc_id, text_hash, item_id, coverage): each document and each benchmark item that it contains.

    NULL and empty texts match nothing. Rows with a NULL id are judged like others. Items of fewer than five tokens are in a
    document if one of its lines has their tokens and no other; without ``short_items`` they are passed over.
    Items of one id and different texts are judged one by one; the best coverage counts. Repeated rows give one leak. Other
    columns are left aside. Empty tables give no rows.
    """
    rows = texts(docs, id_col, text_col).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("text_hash"))
    items = benchmark.select(benchmark[item_col].cast("long").alias("id"), benchmark[item_text_col].alias("text"), F.xxhash64(benchmark[item_text_col]).alias("text_hash"))
    bench = written(_window_table(items.distinct(), whole=short_items).select("id", "text_hash", "hash", "pos", "tokens", "windows"), "benchmark-windows")
    bench = bench.select(*(F.col(c).alias(f"item_{c}") for c in bench.columns))
    few = bench.count() <= BROADCAST_WINDOWS
    only = None
    if few:
        exact = np.sort(np.unique(np.asarray(bench.select("item_hash").toArrow().column(0))).view(np.uint64))
        if not len(exact):
            return docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, item_id long, coverage double")
        coarse = np.zeros(1 << _BITS, bool)
        coarse[exact >> np.uint64(64 - _BITS)] = True
        only = docs.sparkSession.sparkContext.broadcast((coarse, exact))
    lines = bench.where(F.size("item_tokens") < WINDOW).limit(1).count() > 0
    found = _window_table(rows, only, lines=lines).withColumnsRenamed({"id": "doc_id"}).drop("windows")
    met = found.join(F.broadcast(bench) if few else bench, F.col("hash") == F.col("item_hash"))
    match = F.struct("pos", "item_pos", F.col("item_tokens").alias("own"), "tokens", "slots")
    pairs = met.groupBy("doc_id", "text_hash", "item_id", "item_text_hash", "item_windows").agg(F.collect_set(match).alias("matches"))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        shares = [best_share(m, n, coverage) for n, m in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
        return pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(shares, pa.float64())], ["doc_id", "text_hash", "item_id", "coverage"])

    judged = map_batches(
        pairs.select("doc_id", "text_hash", "item_id", "item_windows", "matches"), judge, "doc_id long, text_hash long, item_id long, coverage double"
    )
    return judged.where(F.col("coverage") >= coverage).groupBy("doc_id", "text_hash", "item_id").agg(F.max("coverage").alias("coverage"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, contaminated, item_ids, coverage): one for each row of ``docs``.

    ``item_ids`` are the items it contains in ascending order, none for a clean document, whose coverage is 0. Items without
    an id contaminate but are not listed. Other cases as in ``leaks``.
    """
    found = leaks(docs, benchmark, id_col, text_col).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"))
    rows = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_hash"] == found["text_hash"]), "left")
    return joined.select(
        rows["doc_id"],
        F.col("coverage").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns unchanged, that contain no benchmark item of five tokens or more.

    Documents with NULL or empty texts stay. All rows that are equal in id and text go together. Items of fewer tokens remove
    nothing: ``contamination`` reports them. An empty benchmark removes nothing; an empty table gives no rows.
    """
    found = leaks(docs, benchmark, id_col, text_col, short_items=False).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash"))
    same = docs[id_col].eqNullSafe(found["leak_id"]) & (F.xxhash64(docs[text_col]) == found["leak_hash"])
    return docs.join(found, same, "left_anti")
