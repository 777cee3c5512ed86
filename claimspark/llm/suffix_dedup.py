"""Exact byte repeats across a corpus, by suffix arrays made with induced sorting.

Candidates are dealt to shards by ``pieces``. A shard's pieces are put behind one another and their suffix array is made by
induced sorting: suffixes are classed as smaller or larger than their successor, the leftmost smaller ones are sorted by
their substrings and, where names repeat, recursively by the string of names, and all others are induced from them in two
scans. The scans run bucket by bucket: what a bucket's suffixes induce is placed at once, so each is a few array steps.
Prefixes common to neighbours are computed in text order: only where the character before differs are they compared, at
every other place they are one less than at the place before. A window repeats if a neighbour shares all of it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from claimspark.llm.pieces import Unit, kept_symbols, per_document

WINDOW_BYTES = 200
GRAM_BYTES = 32
#: Names with fewer places each than this are sorted by doubling instead of one more induction with as many buckets.
FEW_PLACES = 48


def _smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one counts as smaller."""
    n = len(t)
    turn = np.sign(np.diff(t.astype(np.int64)))  # 1: the next character is larger
    known = np.flatnonzero(turn)
    out = np.ones(n, bool)
    if n > 1:
        after = np.searchsorted(known, np.arange(n - 1))  # equal characters take after the next change
        inner = after < len(known)
        out[:-1][inner] = turn[known[after[inner]]] > 0
    return out


def _place(sa: np.ndarray, free: np.ndarray, at: np.ndarray, chars: np.ndarray, step: int) -> None:
    """Put suffixes into the buckets of their characters, in order, from the free place on (step 1) or backwards (-1)."""
    order = np.argsort(chars, kind="stable")
    chars, at = chars[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
    sizes = np.diff(first, append=len(chars))
    within = np.arange(len(chars)) - np.repeat(first, sizes)
    sa[free[chars] + step * within] = at
    free[chars[first]] += step * sizes


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the leftmost smaller suffixes in the given order."""
    n = len(t)
    sa = np.full(n, -1, np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    used = np.flatnonzero(sizes)
    order = np.argsort(t[lms], kind="stable")
    lms_of, counts = lms[order], np.bincount(t[lms], minlength=len(sizes))
    lms_at = np.cumsum(counts) - counts
    free = starts.copy()
    for c in used.tolist():
        lo = starts[c]
        while lo < free[c]:
            hi = free[c]
            before = sa[lo:hi] - 1
            before = before[before >= 0]
            before = before[~small[before]]
            if len(before):
                _place(sa, free, before, t[before], 1)
            lo = hi
        if counts[c]:
            before = lms_of[lms_at[c] : lms_at[c] + counts[c]] - 1
            before = before[before >= 0]
            before = before[~small[before]]
            if len(before):
                _place(sa, free, before, t[before], 1)
    large_end = free.copy()
    free = ends - 1
    for c in used[::-1].tolist():
        hi = ends[c] - 1
        while hi > free[c]:
            lo = free[c]
            before = sa[lo + 1 : hi + 1][::-1] - 1
            before = before[before >= 0]
            before = before[small[before]]
            if len(before):
                _place(sa, free, before, t[before], -1)
            hi = lo
        before = sa[starts[c] : large_end[c]][::-1] - 1
        before = before[before >= 0]
        before = before[small[before]]
        if len(before):
            _place(sa, free, before, t[before], -1)
    # the end mark is smaller than all and induced by none
    sa[0] = n - 1
    return sa


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """A name for each leftmost smaller substring, by its place in the order; equal ones share it."""
    n = len(t)
    size = np.zeros(n, np.int64)
    size[lms[:-1]] = np.diff(lms) + 1
    size[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = size[a] == size[b]
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        differ = t[a[active] + k] != t[b[active] + k]
        same[active[differ]] = False
        active = active[~differ]
        k += 1
        active = active[size[a[active]] > k]
    name = np.concatenate([[0], np.cumsum(~same)])
    out = np.empty(n, np.int64)
    out[ordered] = name
    return out[lms]


def _doubled(t: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks, for a string of many different names that ends with its least."""
    rank, k, n = t.astype(np.int64), 1, len(t)
    sa = np.argsort(rank, kind="stable")
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + second
        sa = np.argsort(key, kind="stable")
        sorted_key = key[sa]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[sa] = new
        k *= 2
        if new[-1] == n - 1 or k >= n:
            return sa


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers whose last is 0 and the only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _smaller(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(t)
    if not len(lms) or len(lms) == 1:
        return _induce(t, small, lms, sizes)
    sa = _induce(t, small, lms, sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    names = _names(t, lms, sa[is_lms[sa]])
    kinds = int(names.max()) + 1
    if kinds == len(lms):
        order = np.empty(len(lms), np.int64)
        order[names] = np.arange(len(lms))
    elif kinds * FEW_PLACES > len(lms):
        order = _doubled(names)
    else:
        order = suffix_array(names)
    return _induce(t, small, lms[order], sizes)


def _words_at(t: np.ndarray) -> np.ndarray:
    """Eight characters below 2^16 from each place on, as two words of four; characters behind the end are 0."""
    padded = np.concatenate([t, np.zeros(4, t.dtype)]).astype(np.uint64)
    n = len(t)
    return padded[:n] | padded[1 : n + 1] << np.uint64(16) | padded[2 : n + 2] << np.uint64(32) | padded[3 : n + 3] << np.uint64(48)


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp) in text order: each suffix's predecessor in the suffix array, -1 for the first, and their common prefix."""
    n = len(t)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    here = np.arange(n)
    fresh = (phi <= 0) | (here == 0)
    rest = np.flatnonzero(~fresh)
    fresh[rest] = t[rest - 1] != t[phi[rest] - 1]
    active = np.flatnonzero(fresh & (phi >= 0))
    lcp = np.full(n, -n - 1, np.int64)
    lcp[fresh] = 0
    words = _words_at(t)
    i, j = active, phi[active]
    size = np.zeros(len(active), np.int64)
    while len(i):
        inside = (i < n) & (j < n)
        i, j, active, size = i[inside], j[inside], active[inside], size[inside]
        x = words[i] ^ words[j]
        equal = x == 0
        low = x[~equal] & (~x[~equal] + np.uint64(1))
        lcp[active[~equal]] = size[~equal] + np.log2(low.astype(np.float64)).astype(np.int64) // 16
        i, j, active, size = i[equal] + 4, j[equal] + 4, active[equal], size[equal] + 4
    plcp = np.maximum.accumulate(lcp + here) - here
    plcp[sa[0]] = 0
    return phi, plcp


def repeated_runs(bodies: list[bytes], window: int = WINDOW_BYTES) -> list[list[int]]:
    """For each body, the runs of bytes that are covered by windows starting more than once in the bodies."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    joined = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    t = joined.astype(np.int64) + 2
    marks = np.cumsum(sizes + 1) - 1
    t[marks] = 1  # between bodies
    t = np.concatenate([t, [0]])
    sa = suffix_array(t)
    phi, plcp = common_prefixes(t, sa)
    twice = plcp >= window
    twice[phi[twice]] = True
    left = np.repeat(marks, sizes + 1) - np.arange(len(joined))  # bytes to the end of the body
    starts = np.flatnonzero(twice[:-1] & (left >= window))
    edge = np.zeros(len(joined) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    inside = np.cumsum(edge) > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    firsts, lasts = turns[::2], turns[1::2]
    begins = marks - sizes
    owner = np.searchsorted(marks, firsts)
    out: list[list[int]] = [[] for _ in bodies]
    for k, a, b in zip(owner.tolist(), (firsts - begins[owner]).tolist(), (lasts - begins[owner]).tolist()):
        out[k] += [a, b]
    return out


def _unit() -> Unit:
    return Unit(WINDOW_BYTES, GRAM_BYTES, words=False)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, kept, runs): what is left of each text as bytes, and the removed runs as flat first and end."""
    one = lambda text, runs: (b"".join(kept_symbols(text, runs)), [x for r in runs for x in r])
    return per_document(docs, _unit(), repeated_runs, one, "doc_id long, kept binary, runs array<long>", id_col, text_col)


def _digest(text: bytes, runs: list[tuple[int, int]]) -> tuple:
    kept = hashlib.sha256(b"".join(kept_symbols(text, runs))).hexdigest()
    return len(text), sum(b - a for a, b in runs), len(runs), kept


def repeated_bytes_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256): one for each row of ``docs``.

    Removed is each byte covered by a string of ``WINDOW_BYTES`` bytes that starts anywhere else in the table too, in the
    same document or another; strings never cross documents and are judged on the input. A NULL text counts as empty, and
    a text shorter than the window keeps everything. Repeated rows repeat each other's text. Ids may be NULL. Other columns
    are left aside. An empty table gives no rows.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return per_document(docs, _unit(), repeated_runs, _digest, schema, id_col, text_col)
