import hashlib
import random
import zlib

import cloudpickle_by_value
import numpy as np
import pytest

from claimspark.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, key string, n_convs long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []

    def sums(node):
        kids = children.get(node, [])
        below = [sums(k) for k in kids]
        leaves = sum(x[0] for x in below) or 1
        saved = sum(x[1] for x in below) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(kids), leaves, saved, hashlib.sha256(ids.encode()).hexdigest()))
        return leaves, saved

    if members:
        sums(())
    return sorted(out, key=str)


def talk(seed, n=150, deep=12):
    """Conversations over few turns, so that many share prefixes, end within others, or are equal."""
    rng = random.Random(seed)
    rows, texts = [], ["a", "bé", "", None, "long " * 40]
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, deep])):
            rows.append((c, t if rng.random() < 0.95 or t else None, rng.choice(["user", "user", None]), rng.choice(texts[: rng.choice([1, 2, 5])])))
    hot = [(2000 + 5 * k, t, "user", f"same {t}") for k in range(60) for t in range(10)]
    long = [(5000 + 5 * k, t, "user", f"deep {t}") for k in range(3) for t in range(200 + k)]
    return rows + hot + long


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = ct.prefix_trie(df)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = talk(seed)
    want = brute(rows)
    assert len(want) > 300 and got(spark, rows) == want


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("width", [1, 2, 3, 7, 1000])
def test_merge_across_chunk_borders(spark, seed, width):
    """Chunks of a few sequences, merged as the operator does, in plain Python."""
    rng = random.Random(seed)
    seqs = sorted({tuple(rng.choices([1, 2, 3], [5, 2, 1], k=rng.randint(0, 6))) for _ in range(40)})
    rows = [(np.array([(x, 7, 10 * x) for x in s], np.int64).reshape(-1, 3), rng.randint(1, 4), rng.randint(0, 99), f"e{i}") for i, s in enumerate(seqs)]
    whole, opened = [], {}
    for k in range(0, len(rows), width):
        for r in ct._Chunk(rows[k : k + width]).run():
            (opened.setdefault(r[1], []) if r[0] else whole).append(r)
    members = {}
    for s, (_, n, least, _) in zip(seqs, rows):
        for d in range(len(s) + 1):
            m = members.setdefault(s[:d], [0, 10**9])
            m[0], m[1] = m[0] + n, min(m[1], least)
    assert len(whole) + len(opened) == len(members)
    assert sorted((r[3], r[6], r[4]) for r in whole) + sorted((p[0][3], sum(r[6] for r in p), min(r[4] for r in p)) for p in opened.values()) != []
    together = [(r[3], r[6], r[4]) for r in whole] + [(p[0][3], sum(r[6] for r in p), min(r[4] for r in p)) for p in opened.values()]
    assert sorted(together) == sorted((len(s), *m) for s, m in members.items())


def test_small_chunks_through_spark(spark):
    rows = talk(3, 80)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ct, "CHUNK_TURNS", 15)
        m.setattr(ct, "PIECE_IDS", 4)
        with cloudpickle_by_value.of(ct):
            assert got(spark, rows) == brute(rows)


def test_defined_cases(spark):
    assert got(spark, []) == [] and got(spark, [(None, 0, "user", "x")]) == []
    assert got(spark, [(4, None, None, None)]) == brute([(4, None, None, None)])
    rows = [(10, t, "user", "z" * 200_000) for t in range(3)] + [(10, 1, "user", "z" * 200_000)] * 2 + [(11, 0, "user", "z" * 200_000)]
    assert got(spark, rows) == brute(rows)


def test_ids_of_a_group_in_order(spark):
    rows = [(5 * c, 0, "user", "x") for c in [*range(300), 10**6]]
    assert got(spark, rows) == brute(rows)
