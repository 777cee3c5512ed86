"""Token counts by two tiers of lookup on the map side.

The first tier is a compact table of frequent words and their numbers of tokens, sent to all tasks: at most
``FREQUENT_WORDS`` entries, taken from a bounded sample of documents. It only saves work, counts do not depend on it. Words
it lacks are encoded by the task itself and kept in the worker's bounded cache. No word is shuffled.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.bpe import WordBpe, WordCache, load
from claimspark.llm.common import begin, map_batches, row_texts, texts

FREQUENT_WORDS = 16_384
SAMPLE_DOCUMENTS = 4_000
TOKEN_LIMIT = 2_048
_SEED = 11


def frequent_lengths(docs: DataFrame, vocabulary: bytes, words: int = FREQUENT_WORDS, sample: int = SAMPLE_DOCUMENTS) -> dict[str, int]:
    """Numbers of tokens of the sample's most frequent words. ``docs`` has the columns doc_id and text."""
    rows = docs.select("text")
    share = min(1.0, sample / max(1, rows.count()))

    def most(batches):
        begin(__name__)
        bpe, seen = load(vocabulary), Counter()
        for batch in batches:
            for text in row_texts(batch.column(0)):
                seen.update(w for w in bpe.split(text) if isinstance(w, str))
        top = [w for w, n in seen.most_common(words) if n > 1]
        yield pa.record_batch(
            [pa.array(top, pa.string()), pa.array([seen[w] for w in top], pa.int64()), pa.array([len(bpe.encode_word(w)) for w in top], pa.int32())],
            ["word", "seen", "tokens"],
        )

    found = rows.sample(share, seed=_SEED).mapInArrow(most, "word string, seen long, tokens int")
    total: Counter = Counter()
    tokens: dict[str, int] = {}
    for word, seen, n in found.toLocalIterator():
        total[word] += seen
        tokens[word] = n
        if len(total) > 8 * words:  # the rest is too rare to matter
            total = Counter(dict(total.most_common(4 * words)))
            tokens = {w: tokens[w] for w in total}
    return {w: tokens[w] for w, _ in total.most_common(words)}


class _Lengths(dict):
    """The first tier, the table as sent, and behind it the worker's own cache."""

    def __init__(self, bpe: WordBpe, frequent: dict[str, int]):
        super().__init__(frequent)
        self.met = WordCache(lambda w: 1 if isinstance(w, int) else len(bpe.encode_word(w)))

    def __missing__(self, word: str | int) -> int:
        return self.met[word]


_lengths: dict[str, _Lengths] = {}


def token_counts(
    docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT, sample: int = SAMPLE_DOCUMENTS
) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit): one for each document, over its whole text.

    A NULL or empty text has no bytes and no tokens. Ids may be NULL or repeated; other columns are left aside. An empty
    table gives no rows.
    """
    rows = texts(docs, id_col, text_col)
    table = rows.sparkSession.sparkContext.broadcast(frequent_lengths(rows, vocabulary, sample=sample))
    token = uuid.uuid4().hex  # names this table in the workers

    def batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        if token not in _lengths:
            _lengths.clear()
            _lengths[token] = _Lengths(bpe, table.value)
        lengths = _lengths[token]
        whole = row_texts(batch.column(1))
        counts = [sum(map(lengths.__getitem__, bpe.split(t))) for t in whole]
        sizes = [len(t.encode()) for t in whole]
        return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = map_batches(rows, batch, "doc_id long, n_bytes long, n_tokens long")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
