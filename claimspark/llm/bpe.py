"""BPE encoding by backtracking, and decoding by an offset table.

A word is encoded without replaying its merges. An Aho-Corasick automaton finds all tokens in it; from the left, the longest
token that starts at a place is taken if it may follow the token before it, else the next shorter one; a place from which
nothing fits is marked and never tried again, so the work is linear in the word. Two tokens may follow each other if no
merge joins what stands at their border while they are being made; answers are kept in a pair table. Since merges make a
unique sequence, the sequence found in this way is the one that merging gives.

The vocabulary is a public tokenizer file, read by the driver and sent to the tasks whole (its size does not depend on the
corpus). Words and their ids are kept in a bounded cache of each Python worker.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from claimspark.llm.common import ROW_BYTES, cached, map_batches, row_texts, texts

CACHE_WORDS = 150_000
CACHE_PAIRS = 500_000
#: Words longer than this are encoded anew each time, so that the cache stays small.
CACHE_WORD_CHARS = 64
_NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


class WordBpe:
    """A byte-level BPE vocabulary with word ends, as a tokenizer file states it."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self._special_rx = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._read_rules(spec)
        self._read_merges(model["merges"])
        self._read_offsets({**self.vocab, **special})
        del self.vocab, self._names  # each worker holds what encoding and decoding need, no more
        self._pairs: dict[tuple[int, int], bool] = {}
        self.words = WordCache(lambda w: (w,) if isinstance(w, int) else self.encode_word(w))

    def _read_rules(self, spec: dict) -> None:
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        first, second = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or first["type"] != "Split" or second["type"] != "ByteLevel":
            raise ValueError("the file states text rules other than those of a word-end vocabulary")
        # white space as Unicode defines it, which the file's own engine takes for \s
        self.find_words = regex.compile(first["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall

    def _read_merges(self, merges: list) -> None:
        """Every token as one character per symbol: a byte, or a byte that ends a word."""
        plain = byte_symbols()
        self._symbols = [chr(0x1000 + b) for b in range(256)]
        self._ends = [chr(0x2000 + b) for b in range(256)]
        spelled: dict[int, str] = {}
        for b in range(256):
            spelled[self.vocab[plain[b]]] = self._symbols[b]
            spelled[self.vocab[plain[b] + self.suffix]] = self._ends[b]
        self._rank: dict[tuple[int, int], int] = {}
        self._made: dict[int, tuple[int, int, int]] = {}
        self._names = {i: t for t, i in self.vocab.items()}
        usable = set(spelled)
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in merges):
            left, right = self.vocab[a], self.vocab[b]
            self._rank[left, right] = rank
        for (left, right), rank in self._rank.items():
            token = self.vocab[self._name(left, right)]
            if token in spelled or left not in usable or right not in usable or self._border_merges(left, right, rank):
                continue
            spelled[token] = spelled[left] + spelled[right]
            usable.add(token)
            self._made[token] = left, right, rank
        self._tokens = ahocorasick.Automaton()
        for token, text in spelled.items():
            self._tokens.add_word(text, (len(text), token))
        self._tokens.make_automaton()

    def _name(self, left: int, right: int) -> str:
        return self._names[left] + self._names[right]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at the left (0) or right (1) edge while the token is made, and the rank of the merge that takes it up."""
        out, until = [(token, _NEVER)], _NEVER
        while made := self._made.get(token):
            token, until = made[side], min(until, made[2])
            out.append((token, until))
        return out

    def _border_merges(self, left: int, right: int, own: int | None = None) -> bool:
        """Whether a merge other than ``own`` joins the border of two tokens before they are complete."""
        rank, spine = self._rank, self._edge(right, 0)
        for a, until_a in self._edge(left, 1):
            for b, until_b in spine:
                r = rank.get((a, b))
                # of equal ranks the leftmost goes first: the left token's own merge, then the border, then the right's
                if r is not None and r != own and r < until_a and r <= until_b:
                    return True
        return False

    def _read_offsets(self, names: dict[str, int]) -> None:
        """All token texts in one string, and where each begins; an id without a token is empty."""
        by_id = {i: t for t, i in names.items()}
        self._blob, self._offsets, at = "".join(by_id[i] for i in sorted(by_id)), [], 0
        for i in range(max(by_id) + 1):
            self._offsets.append(at)
            at += len(by_id.get(i, ""))
        self._offsets.append(at)
        self._texts = [self._blob[a:b] for a, b in zip(self._offsets, self._offsets[1:])]

    def follows(self, left: int, right: int) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = not self._border_merges(left, right)
        return known

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one normalised word."""
        raw = word.encode()
        symbols = self._symbols
        spelled = "".join([symbols[b] for b in raw[:-1]]) + self._ends[raw[-1]]
        n = len(spelled)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (size, token) in self._tokens.iter(spelled):
            starts[end - size + 1].append((size, token))  # by growing end, so the longest is last
        if starts[0][-1][0] == n:
            return (starts[0][-1][1],)
        tried = [len(s) for s in starts]  # tokens from here on are used up
        dead, out, at = bytearray(n + 1), [], 0
        while at < n:
            options, k = starts[at], tried[at]
            while k:
                k -= 1
                size, token = options[k]
                if not dead[at + size] and (not out or self.follows(out[-1][1], token)):
                    break
            else:
                dead[at] = 1
                at -= out.pop()[0]
                continue
            tried[at] = k
            out.append((size, token))
            at += size
            if at < n:
                tried[at] = len(starts[at])
        return tuple(token for _, token in out)

    def split(self, text: str) -> list[str | int]:
        """Words of the whole text in order; a special token's text gives its id."""
        if self._special_rx is None or not self._special_rx.search(text):
            return self._plain_words(text)
        out, at = [], 0
        for m in self._special_rx.finditer(text):
            out += self._plain_words(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._plain_words(text[at:])

    def _plain_words(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # letter by letter: the final sigma has no rule of its own
        return self.find_words(text.replace("Σ", "σ").lower())

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.words.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts, one space between them, special tokens kept."""
        return " ".join(map(self._texts.__getitem__, ids))


class WordCache(dict):
    """What a worker has made of words, in two generations: a full one becomes the old one, of which words in use come back."""

    def __init__(self, make: Callable[[str | int], object]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str | int):
        made = self.old.get(word)
        if made is None:
            made = self.make(word)
            if isinstance(word, int) or len(word) > CACHE_WORD_CHARS:
                return made
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = made
        return made


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def load(raw: bytes) -> WordBpe:
    """The vocabulary of a tokenizer file, made once in each Python worker, until it goes on to another operator."""
    cached(load.cache_clear)
    return WordBpe(raw)


def encode(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids): one for each document, the ids of its whole text, special tokens' texts as their ids.

    A NULL or empty text has no ids. Ids may be NULL or repeated; other columns are left aside. An empty table gives no rows.
    """

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        ids = pa.array([bpe.encode(t) for t in row_texts(rows.column(1))], pa.list_(pa.int32()))
        return pa.record_batch([rows.column(0), ids], ["doc_id", "ids"])

    return map_batches(texts(docs, id_col, text_col), batch, "doc_id long, ids array<int>", ROW_BYTES)


def decode(encoded: DataFrame, vocabulary: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (doc_id, text) of a table of ids. NULL ids give an empty text."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        out = pa.array([bpe.decode(ids or []) for ids in rows.column(1).to_pylist()], pa.string())
        return pa.record_batch([rows.column(0), out], ["doc_id", "text"])

    return map_batches(encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids")), batch, "doc_id long, text string", ROW_BYTES)


def round_trip(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, as digests.

    NULLs, repeated rows and the empty table as in ``encode``.
    """

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        counts, id_digests, text_digests = [], [], []
        for text in row_texts(rows.column(1)):
            ids = bpe.encode(text)
            counts.append(len(ids))
            id_digests.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            text_digests.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        columns = [rows.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
        return pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(texts(docs, id_col, text_col), batch, schema, ROW_BYTES)


def token_rows(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded_sha256): the ids of each text, and the digest of the text they decode to.

    NULLs, repeated rows and the empty table as in ``encode``.
    """

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        counts, digests, flat, ends = [], [], [], [0]
        for text in row_texts(rows.column(1)):
            ids = bpe.encode(text)
            counts.append(len(ids))
            digests.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            flat.append(np.array(ids, np.int32))
            ends.append(ends[-1] + len(ids))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
        return pa.record_batch([rows.column(0), pa.array(counts, pa.int64()), lists, pa.array(digests, pa.string())], ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return map_batches(texts(docs, id_col, text_col), batch, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string", ROW_BYTES)
