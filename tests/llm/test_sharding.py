import random
import zlib
from collections import Counter

import numpy as np
import pytest

from claimspark.llm import sharding as sh


def rows_of(seed, n):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "", "same", "é" * rng.randint(1, 9), "x" * 30_000 if i % 50 == 0 else "y"]), rng.choice(["a", None])) for i in range(n)]
    return rows + [(None, "no id", None)] * 3 + [(1, "twice", "a")] * 2


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, "s", 9) for r in rows], "doc_id long, text string, lang string, row string, Slot int")


@pytest.mark.parametrize("n,cell,run_bits", [(500, 1 << 16, 16), (500, 8, 4), (0, 8, 4), (3, 8, 4)])
def test_sizes_slots_and_rows(table, monkeypatch, n, cell, run_bits):
    monkeypatch.setattr(sh, "CELL_ROWS", cell)
    monkeypatch.setattr(sh, "RUN_BITS", run_bits)
    monkeypatch.setattr(sh, "RUN_ROWS", 1 << run_bits)
    rows = rows_of(1, n) if n else []
    out = sh.shard_digest(table(rows).repartition(5)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    held = Counter(r["shard"] for r in out)
    sizes = [held[s] for s in range(16)]
    assert sizes == sh.even_rooms(len(rows), 16) and max(sizes) - min(sizes) <= 1
    for s in range(16):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(held[s]))
    assert {r["law"] for r in out} <= {"rows"} and {r["grown_shard"] for r in out} <= {None}


def test_whole_rows_and_clashing_columns(table):
    rows = rows_of(2, 40)
    out = sh.shuffle_into_shards(table(rows), 3)
    assert out.columns == ["doc_id", "text", "lang", "row", "shard", "slot"]
    assert Counter((r["doc_id"], r["text"], r["lang"]) for r in out.collect()) == Counter(rows)


def test_same_rows_again_from_one_seed_and_others_from_another(table):
    df = table(rows_of(3, 200)).coalesce(1)
    at = lambda seed: {(r["doc_id"], r["text"]): (r["shard"], r["slot"]) for r in sh.shuffle_into_shards(df, 4, seed).collect()}
    one = at(1)
    assert one == at(1) and sum(one[k] != v for k, v in at(2).items()) > 150


def test_written_shards(spark, table, tmp_path):
    sh.write_shards(table(rows_of(4, 100)), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter(r["shard"] for r in back) == Counter({0: 27, 1: 26, 2: 26, 3: 26})


def test_every_place_is_as_likely(spark):
    """Over many seeds each of 24 rows comes to each of three shards, and to each slot, about equally often."""
    shard, slot, together = Counter(), Counter(), 0
    runs = 400
    for seed in range(runs):
        rng = np.random.default_rng(seed)
        dealt = sh.deal([10, 9, 5], sh.even_rooms(24, 3), rng)
        assert dealt.sum(axis=0).tolist() == [8, 8, 8] and dealt.sum(axis=1).tolist() == [10, 9, 5]
        first = np.repeat(range(3), dealt[0])[sh._order(seed, 7, 10)]
        shard.update(enumerate(first.tolist()))
        slot.update(enumerate(sh._order(seed, 8, 6).tolist()))
        together += int(first[0] == first[1])
    assert all(abs(shard[i, s] - runs / 3) < 50 for i in range(10) for s in range(3))
    assert all(abs(slot[i, p] - runs / 6) < 40 for i in range(6) for p in range(6))
    # of a shard's 8 rows 7 of 23 others share it
    assert abs(together - runs * 7 / 23) < 45


@pytest.mark.parametrize("good,bad,sample", [(40, 60, 30), (7, 90, 50), (500, 20, 510)])
def test_large_draws_follow_the_same_law(monkeypatch, good, bad, sample):
    draws = lambda: np.array([sh.draw(np.random.default_rng(k), good, bad, sample) for k in range(4000)])
    native = draws()
    monkeypatch.setattr(sh, "_DRAWN", 0)
    own = draws()
    sd = (sample * good / (good + bad) * bad / (good + bad) * (good + bad - sample) / (good + bad - 1)) ** 0.5
    mean = sample * good / (good + bad)
    for x in (native, own):
        assert abs(x.mean() - mean) < 4 * sd / 4000**0.5 and abs(x.std() - sd) < 0.08 * sd
    huge = [sh.draw(np.random.default_rng(k), 10**11, 10**12, 10**10) for k in range(50)]
    assert abs(np.mean(huge) - 10**10 / 11) < 10**5
