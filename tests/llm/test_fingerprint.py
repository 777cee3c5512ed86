import hashlib

from pyspark.sql import functions as F

from claimspark.llm import fingerprint as fp


def edits(rows):
    """(doc_id, n_chars, edited text, next text) by plain Python."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        q = len(text) // 4
        out.append((doc_id, len(text), text[: len(text) - q] + after[:q], after))
    return out


ROWS = [(i * 3 + 1, "\n".join(f"Line {i} {j}. And é𝄞 more words {i * j}!" for j in range(i % 7))) for i in range(40)]
ROWS += [(None, "no id here\nat all"), (4, "same id\nother text"), (4, "same id\nother text"), (900, None), (901, ""), (902, "x" * 50_000)]


def test_edited_texts_and_order(make_docs):
    got = fp.edited_pairs(make_docs(ROWS)).collect()
    want = sorted(((d, n, hashlib.sha256(e.encode()).hexdigest()) for d, n, e, _ in edits(ROWS)), key=str)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_fingerprints_agree_over_routes(make_docs):
    alone = {(r["doc_id"], r["fingerprint"]) for r in fp.fingerprint(make_docs(ROWS)).collect()}
    assert {(r["doc_id"], r["fingerprint"]) for r in fp.edited_pairs(make_docs(ROWS)).collect()} == alone
    edited = [(i, e) for i, (_, _, e, _) in enumerate(edits(ROWS))]
    want = sorted(r["fingerprint"] for r in fp.fingerprint(make_docs(edited)).collect())
    assert sorted(r["edited_fingerprint"] for r in fp.edited_pairs(make_docs(ROWS)).collect()) == want


def test_order_of_paragraphs_does_not_count_but_their_number_does(make_docs):
    r = {x["doc_id"]: x["fingerprint"] for x in fp.fingerprint(make_docs([(1, "a\nb\nb"), (2, "b\na\nb"), (3, "a\nb"), (4, "a\na\nb"), (5, None), (6, "")])).collect()}
    assert r[1] == r[2] and r[5] == r[6] and len({r[1], r[3], r[4], r[5]}) == 4


def test_insert_and_delete(make_docs):
    v = fp.fingerprint(make_docs([(1, "a. b\nc"), (2, "d\nd"), (3, "d\na. b\nd\nc")]))
    a, b, both = (v.where(F.col("doc_id") == k).select(F.struct("exact", "sketch").alias(f"v{k}")) for k in (1, 2, 3))
    row = a.crossJoin(b).crossJoin(both).select(
        *((fp.insert(F.col("v1")[x], F.col("v2")[x]) == F.col("v3")[x]) for x in ("exact", "sketch")),
        *((fp.delete(F.col("v3")[x], F.col("v2")[x]) == F.col("v1")[x]) for x in ("exact", "sketch")),
    ).first()
    assert all(row)


def test_likeness_follows_the_common_share(make_docs):
    text = "\n".join(f"Sentence {j} of the first text." for j in range(40))
    other = "\n".join(f"Quite another thing {j}." for j in range(40))
    r = {x["doc_id"]: x for x in fp.edited_pairs(make_docs([(1, text), (2, other), (3, text), (4, text)])).collect()}
    assert 0.5 < r[1]["near_edited"] < 0.95 and r[1]["near_next"] < 0.4 and r[3]["near_next"] == 1.0


def test_empty_and_single(make_docs):
    assert fp.edited_pairs(make_docs([])).collect() == []
    (only,) = fp.edited_pairs(make_docs([(1, "abcdefgh")])).collect()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def test_buckets_of_any_number(spark):
    import bisect

    for cuts in ([], [5], [1, 4, 4, 9], list(range(0, 700, 7))):
        cuts = sorted(set(cuts))
        values = [None, -(2**63), *range(-3, 720), 2**63 - 1]
        df = spark.createDataFrame([(v,) for v in values], "v long")
        got = [r["b"] for r in df.select(fp._bucket(F.col("v"), cuts).alias("b")).collect()]
        assert got == [0 if v is None else bisect.bisect_left(cuts, v) for v in values]


def test_more_buckets_than_documents(spark, make_docs):
    rows = [(i, f"text {i}. " * (i % 7 + 1)) for i in range(60)] + [(None, "x"), (None, "y"), (7, "again")]
    want = sorted(map(str, fp.edited_pairs(make_docs(rows)).drop("x").collect()))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        assert sorted(map(str, fp.edited_pairs(make_docs(rows)).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
