import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from claimspark.llm import pieces, substring_dedup, suffix_dedup


def covered(symbols, window, counts):
    inside = [False] * len(symbols)
    for i in range(len(symbols) - window + 1):
        if counts[tuple(symbols[i : i + window])] > 1:
            inside[i : i + window] = [True] * window
    return inside


def brute(rows, split, window):
    """(doc_id, symbols, whether each is removed) by counting every window."""
    split_rows = [(r[0], split((r[1] or "").encode())) for r in rows]
    counts = Counter(tuple(s[i : i + window]) for _, s in split_rows for i in range(len(s) - window + 1))
    return [(d, s, covered(s, window, counts)) for d, s in split_rows]


def want_bytes(rows):
    out = []
    for d, s, gone in brute(rows, lambda t: t, suffix_dedup.WINDOW_BYTES):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(s), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(s, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def want_words(rows):
    rule = lambda t: t.translate(bytes(32 if 9 <= c <= 13 else c for c in range(256))).replace(b"  ", b" ").split(b" ")
    out = []
    for d, s, gone in brute(rows, lambda t: [w for w in rule(t) if w], substring_dedup.WINDOW_WORDS):
        out.append((d, len(s), sum(gone), hashlib.sha256(b" ".join(c for c, g in zip(s, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(n) for n in (30, 40, 60, 120)]
    rows = []
    for i in range(40):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), text(rng.randint(0, 20))]
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    base = text(150)
    for i in range(30):  # near copies of one text
        at = rng.randrange(len(base))
        rows.append((100 + i, base[:at] + "#" + base[at:]))
    rows += [(200 + i, base) for i in range(20)]
    rows += [(300, "a" * 900), (301, "ab " * 400), (302, "x " * 36 + "x"), (303, None), (304, ""), (305, "short"), (None, shared[3]), (7, rows[7][1]), (7, "other text of id 7")]
    return rows


def test_bytes(make_docs):
    assert got(suffix_dedup.repeated_bytes_digest(make_docs(corpus()))) == want_bytes(corpus())


def test_words(make_docs):
    assert got(substring_dedup.repeated_words_digest(make_docs(corpus()))) == want_words(corpus())


def test_heavy_anchors_are_dealt_again(make_docs, monkeypatch):
    monkeypatch.setattr(pieces, "HEAVY_SYMBOLS", 300)
    assert got(suffix_dedup.repeated_bytes_digest(make_docs(corpus(5)))) == want_bytes(corpus(5))
    monkeypatch.setattr(pieces, "HEAVY_SYMBOLS", 60)
    assert got(substring_dedup.repeated_words_digest(make_docs(corpus(5)))) == want_words(corpus(5))


def test_general_results(make_docs):
    rows = [(1, "q" * 10 + "abcdefghij" * 30), (2, "abcdefghij" * 30 + "zz")]
    r = {x["doc_id"]: x for x in suffix_dedup.repeated_bytes(make_docs(rows)).collect()}
    assert bytes(r[1]["kept"]) == b"q" * 10 and r[1]["runs"] == [10, 310] and bytes(r[2]["kept"]) == b"zz"
    words = " ".join(f"w{i}" for i in range(40))
    r = {x["doc_id"]: x for x in substring_dedup.repeated_words(make_docs([(1, f"first {words}"), (2, f"{words} last")])).collect()}
    assert r[1]["kept"] == "first" and r[2]["runs"] == [0, 40] and r[2]["kept"] == "last"


@pytest.mark.parametrize("make", [suffix_dedup.repeated_bytes_digest, substring_dedup.repeated_words_digest])
def test_empty(make_docs, make):
    assert make(make_docs([])).collect() == []


def test_suffix_arrays_and_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(150):
        t = np.concatenate([rng.integers(1, rng.integers(2, 6), rng.integers(1, 150)), [0]])
        if trial % 3 == 0:
            t = np.concatenate([np.tile(rng.integers(1, 3, 5), rng.integers(1, 30)), [0]])
        text = t.tolist()
        sa = suffix_dedup.suffix_array(t)
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        _, plcp = suffix_dedup.common_prefixes(t, sa)
        for r in range(1, len(sa)):
            i, j = int(sa[r]), int(sa[r - 1])
            k = 0
            while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            assert plcp[i] == k


@pytest.mark.parametrize(("solver", "window", "joint"), [(suffix_dedup.repeated_runs, 5, b""), (substring_dedup.repeated_runs, 4, b" ")])
def test_solvers(solver, window, joint):
    rng = random.Random(2)
    for _ in range(150):
        bodies = [[bytes([rng.choice(b"ab\x01\xff")]) for _ in range(rng.randint(1, 40))] for _ in range(rng.randint(1, 6))]
        counts = Counter(tuple(b[i : i + window]) for b in bodies for i in range(len(b) - window + 1))
        for body, spans in zip(bodies, solver([joint.join(b) for b in bodies], window)):
            inside = [False] * len(body)
            for a, b in zip(spans[::2], spans[1::2]):
                inside[a:b] = [True] * (b - a)
            assert inside == covered(body, window, counts)
