"""Exact repeats of word windows across a corpus, by suffix automata of reference shards.

Candidates are dealt to shards by ``pieces``; the corpus is its own reference, so automata of all of it would grow with it
and are not broadcast: each shard's automaton stays in the task to which the pieces that it can match are sent. The pieces
are then streamed through it for their matching statistics: at each word the longest state not below the window's length,
whose number of occurrences tells whether the window ending there starts more than once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from claimspark.llm.pieces import Unit, kept_symbols, per_document

WINDOW_WORDS = 35
GRAM_WORDS = 8


class SuffixAutomaton:
    """All substrings of some sequences, with the number of times that each occurs; none crosses two sequences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.size: list[int] = [0]
        self.seen: list[int] = [0]
        self._marks = 0
        self._last = 0

    def add(self, sequence: list) -> None:
        state = self._start()
        for symbol in sequence:
            state = self._extend(state, symbol)

    def _start(self) -> int:
        """A mark of its own before each sequence keeps matches inside."""
        self._marks += 1
        return self._extend(self._last, (self._marks,))

    def _extend(self, last: int, symbol) -> int:
        nexts, link, size = self.next, self.link, self.size
        new = len(nexts)
        nexts.append({})
        link.append(0)
        size.append(size[last] + 1)
        self.seen.append(1)
        p = last
        while p >= 0 and symbol not in nexts[p]:
            nexts[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][symbol]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(nexts[q].copy())
                link.append(link[q])
                size.append(size[p] + 1)
                self.seen.append(0)
                while p >= 0 and nexts[p].get(symbol) == q:
                    nexts[p][symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self._last = new
        return new

    def count(self) -> None:
        """Add up occurrences, from the longest states to the shortest."""
        seen, link = self.seen, self.link
        for state in sorted(range(1, len(link)), key=self.size.__getitem__, reverse=True):
            if link[state] >= 0:
                seen[link[state]] += seen[state]

    def repeated_ends(self, sequence: list, window: int) -> list[int]:
        """Places behind each window of ``sequence`` that occurs at least twice in the automaton."""
        nexts, link, size, seen = self.next, self.link, self.size, self.seen
        out, state, length = [], 0, 0
        for i, symbol in enumerate(sequence, 1):
            while state and symbol not in nexts[state]:
                state = link[state]
                length = size[state]
            if symbol in nexts[state]:
                state = nexts[state][symbol]
                length += 1
            while state and size[link[state]] >= window:
                state = link[state]
                length = size[state]
            if length >= window and seen[state] > 1:
                out.append(i)
        return out


def repeated_runs(bodies: list[bytes], window: int = WINDOW_WORDS) -> list[list[int]]:
    """For each body, the runs of words that are covered by windows starting more than once in the bodies."""
    ids: dict[bytes, int] = {}
    sequences = [[ids.setdefault(w, len(ids)) for w in b.split()] for b in bodies]
    automaton = SuffixAutomaton()
    for sequence in sequences:
        automaton.add(sequence)
    automaton.count()
    out = []
    for sequence in sequences:
        spans: list[int] = []
        for end in automaton.repeated_ends(sequence, window):
            if spans and end - window <= spans[-1]:
                spans[-1] = end
            else:
                spans += [end - window, end]
        out.append(spans)
    return out


def _unit() -> Unit:
    return Unit(WINDOW_WORDS, GRAM_WORDS, words=True)


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, kept, runs): the kept words joined by one space, and the removed runs of words as flat first and end."""
    one = lambda text, runs: (_kept(text, runs).decode(), [x for r in runs for x in r])
    return per_document(docs, _unit(), repeated_runs, one, "doc_id long, kept string, runs array<long>", id_col, text_col)


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    return b" ".join([w for part in kept_symbols(text.split(), runs) for w in part])


def _digest(text: bytes, runs: list[tuple[int, int]]) -> tuple:
    return len(text.split()), sum(b - a for a, b in runs), hashlib.sha256(_kept(text, runs)).hexdigest()


def repeated_words_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256): one for each row of ``docs``.

    Removed is each word covered by ``WINDOW_WORDS`` consecutive words whose sequence starts anywhere else in the table too, in
    the same document or another; windows are judged on the input. Words are parted by space, tab, line feed, vertical
    tab, form feed and carriage return. A NULL text has no words, and a text shorter than the window keeps all of them.
    Repeated rows repeat each other's words. Ids may be NULL. Other columns are left aside. An empty table gives no rows.
    """
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return per_document(docs, _unit(), repeated_runs, _digest, schema, id_col, text_col)
