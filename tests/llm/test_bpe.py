import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimspark.llm import bpe, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
RAW = bpe.read_vocabulary(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", ["etaoinshrdlu", "aab", "abc xyz'st re ve\n\tÀéßΣσςİ́é한中😀12½!?<|>_\x1c\x85​", "0123456789 .,-%$"])
def test_encoder_against_the_library(alphabet):
    rng, own = random.Random(4), bpe.load(RAW)
    for _ in range(3_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.1:
            text = text[:5] + rng.choice(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"]) + text[5:]
        ids = own.encode(text)
        assert ids == library_ids(text)
        assert own.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_a_loaded_vocabulary_is_small():
    tracemalloc.start()
    try:
        held = bpe.WordBpe(RAW)
        assert tracemalloc.get_traced_memory()[0] < 32_000_000
    finally:
        tracemalloc.stop()
    assert held.encode("unrelated words") == library_ids("unrelated words")


def rows():
    rng = random.Random(9)
    out = [(i, " ".join("".join(rng.choice("thandere ") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    return out + [(None, "no id"), (3, "again"), (3, "again"), (70, None), (71, ""), (72, "<|endoftext|> x<|startoftext|>"), (73, "Word " * 30_000), (74, "x" * 5_000)]


def test_round_trip(make_docs):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text in rows():
        ids = library_ids(text)
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    docs = make_docs(rows())
    got = [tuple(r) for r in bpe.round_trip(docs, RAW).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    encoded = bpe.encode(docs, RAW)
    decoded = {(r["doc_id"], sha(r["text"])) for r in bpe.decode(encoded, RAW).collect()}
    assert decoded == {(w[0], w[3]) for w in want}
    assert bpe.round_trip(make_docs([]), RAW).collect() == [] and bpe.encode(make_docs([]), RAW).collect() == []


@pytest.mark.parametrize("sample", [1, 4_000])
def test_counts_do_not_depend_on_the_frequent_table(make_docs, sample):
    want = sorted(((d, len((t or "").encode()), n := len(library_ids(t)), n > 2048) for d, t in rows()), key=str)
    got = token_counts.token_counts(make_docs(rows()), RAW, sample=sample).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_counts_of_an_empty_table(make_docs):
    assert token_counts.token_counts(make_docs([]), RAW).collect() == []
