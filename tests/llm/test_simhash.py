import random

import xxhash

from claimspark.llm import simhash


def brute_fp(text):
    words = [w for w in (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    prints = [brute_fp(t) for _, t in rows]
    seen, label = set(), {}
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            j = todo.pop()
            if j in group:
                continue
            group.add(j)
            todo += [k for k in range(len(rows)) if (prints[j] ^ prints[k]).bit_count() <= 2]
        seen |= group
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        label |= {j: min(ids) if ids else None for j in group}
    return sorted(((r[0], f"{prints[i]:016x}", label[i]) for i, r in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_against_brute_force(make_docs):
    rng = random.Random(5)
    words = [rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 9)) for _ in range(60)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        rows.append((3 * i + 1, " ".join(text)))
        for c in range(rng.randint(0, 3)):
            copy = list(text)
            if copy:
                copy[rng.randrange(len(copy))] = "X"
            rows.append((1000 + 7 * i + 2000 * c, "\t".join(copy)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, "a b c d"), (None, None), (7, "one"), (7, "one"), (8, "ÀB É two\x0bthree")]
    assert got(simhash.near_duplicates(make_docs(rows))) == brute_classes(rows)


def test_links_cover_every_pair_within_two_bits(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << p for p in rng.sample(range(64), k)) for b in base for k in (1, 2, 2, 3)]
    signed = [v - (1 << 64) if v >> 63 else v for v in {*base, *near}]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}
    assert {(r["a"], r["b"]) for r in simhash.links(df).collect()} == want


def test_hamming_words_are_perfect():
    # every block of 31 bits is at most one bit from its word: the syndrome names the bit
    rng = random.Random(2)
    for _ in range(200):
        block = rng.getrandbits(31)
        s = sum(((block & m).bit_count() & 1) << j for j, m in enumerate(simhash.SYNDROME_MASKS))
        word = block ^ (1 << (s - 1) if s else 0)
        assert all((word & m).bit_count() % 2 == 0 for m in simhash.SYNDROME_MASKS)


def test_keep_one_and_empty(make_docs):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "other words are here now"), (None, "a b c d e f")]
    out = simhash.keep_one(make_docs(rows))
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [1, 3, None]
    assert out.columns == make_docs(rows).columns
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.keep_one(make_docs([])).collect() == []
