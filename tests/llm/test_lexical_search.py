import math
import random
import re
from collections import Counter

import cloudpickle_by_value
import numpy as np
import pytest

from claimspark.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    holding = Counter(t for _, c in found for t in c)
    pooled = {}
    for i, t in items:
        pooled.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in pooled.items():
        ranked = []
        for d, c in found:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                ranked.append((-score, d is not None, d or 0))
        out += [(item, k + 1, d if has else None, -s) for k, (s, has, d) in enumerate(sorted(ranked)[:top])]
    return sorted(out, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["ab", "Ça", "x9", "ŒU", "the", "K", "und"]) * rng.randint(1, 3) + str(k) for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    text = lambda k: rng.choice([" ", "-", "\n", "\x00"]).join(rng.choices(vocabulary, weights, k=k))
    docs = [(i, text(rng.randint(1, 80))) for i in rng.sample(range(10 * n), n)]
    docs += [(d, docs[0][1]) for d in (-5, 7, 7, None, None)] + [(1, None), (2, ""), (3, " .,!"), (4, "İ ẞ Σ"), (5, "the0 " * 30_000)]
    items = [(i, text(rng.randint(1, 20))) for i in range(30)] + [(40, None), (41, ""), (42, "nowhere"), (None, "the0 ab1"), (3, "x90 Σ"), (43, docs[0][1])]
    return docs, items


@pytest.fixture
def tables(spark):
    return lambda docs, items: (
        spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, item string, score long"),
        spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string"),
    )


@pytest.mark.parametrize("seed,postings,block", [(1, 1 << 19, 1 << 10), (2, 300, 16), (3, 2000, 7)])
def test_against_brute_force(tables, monkeypatch, seed, postings, block):
    docs, items = corpus(seed)
    monkeypatch.setattr(ls, "SEGMENT_POSTINGS", postings)
    monkeypatch.setattr(ls, "BLOCK_DOCS", block)
    for text in [t for _, t in docs if t]:
        assert [w for piece in ls.term_pieces(text.encode()) for w in piece] == [t.encode() for t in terms(text)]
    with cloudpickle_by_value.of(ls):
        rows = ls.search(*tables(docs, items)).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str) == brute(docs, items)


@pytest.mark.parametrize("seed", range(6))
def test_segment_against_full_sums(monkeypatch, seed):
    monkeypatch.setattr(ls, "BLOCK_DOCS", 8)
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    lists = []
    for _ in range(int(rng.integers(1, 9))):
        docs = np.flatnonzero(rng.random(n) < rng.choice([0.01, 0.05, 0.3, 0.9])).astype(np.int32)
        lists.append((docs, rng.integers(1, rng.choice([3, 50, 1000]), len(docs))))
    lists = [x for x in lists if len(x[0])]
    sums = np.zeros(n, np.int64)
    for docs, scores in lists:
        sums[docs] += scores
    for least in (1, int(np.median(sums)) + 1):
        want = sorted((-s, d) for d, s in enumerate(sums.tolist()) if s >= least)[:10]
        got = ls.search_segment(lists, n, least, 10, lambda k: ls._List(*lists[k], -(-n // 8)))
        assert [(-s, d) for s, d in zip(got[0].tolist(), got[1].tolist())] == want


def test_several_blocks_of_items(tables, monkeypatch):
    docs, items = corpus(4, 60)
    monkeypatch.setattr(ls, "ITEMS_A_BLOCK", 7)
    rows = ls.search(*tables(docs, items)).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str) == brute(docs, items)


def test_very_large_corpus_counts():
    lengths = np.array([1, 10**9, 5], np.int64)
    assert ls._length_parts(lengths, 10**10, 10**13).tolist() == [10 + 90 * int(n) * 10**10 // 10**13 for n in lengths]
    assert ls.term_weight(10**10, 1) == math.floor(1000 * math.log((2 * 10**10 + 2) / 3))


def test_empty(tables):
    docs, items = corpus(5, 10)
    assert ls.search(*tables([], items)).collect() == [] == ls.search(*tables(docs, [])).collect()
    assert ls.search(*tables([(1, None), (2, "..")], items)).collect() == []
