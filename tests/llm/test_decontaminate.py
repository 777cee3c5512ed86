import random
import re

import pytest
from pyspark.sql import functions as F

from claimspark.llm import decontaminate as dc


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def flagged(df):
    return {r["doc_id"]: r["item_ids"] for r in df.collect() if r["contaminated"]}


PUZZLE = "Today John has 12 apples and gives 12 apples to Mary. Then Mary has 12 apples and gives 12 apples to John. How many apples does John have if Mary has 12?"
OTHER = "Today Peter has 40 apples and gives 40 apples to Anna. Then Anna has 40 apples and gives 40 apples to Peter. How many apples does Peter have if Anna has 40?"
MIXED = "Today Peter has 40 apples and gives 41 apples to Anna. Then Susan has 42 apples and gives 43 apples to Carl. How many apples does Dora have if Emil has 44?"


def test_reparameterised_question_is_caught_and_inconsistent_one_is_not(make_docs, items):
    docs = make_docs([(1, f"Some words before. {OTHER} And after."), (2, f"Intro. {MIXED}"), (4, "John has apples. Nothing else here."), (5, f"x {PUZZLE} y")])
    got = flagged(dc.contamination(docs, items([(7, PUZZLE)])))
    assert got == {1: [7], 5: [7]}


def tokens(text):
    return re.findall(r"\d+(?:[.,]\d+)*|(?<=\d)[%°]|[^\W\d_]+(?:['’-][^\W\d_]+)*", text or "")


def brute(docs, items):
    """Contamination by comparing every window of every document with every window of every item."""

    def kinds(toks):
        out = []
        for i, t in enumerate(toks):
            if t[0].isdigit():
                out.append("n")
            elif t.lower() in dc.UNITS and i and toks[i - 1][0].isdigit():
                out.append("u")
            elif t.lower() not in dc.UNITS and len(t) > 1 and t[0].isupper() and not t.isupper():
                out.append("c")
            else:
                out.append("")
        return out

    def windows(text):
        t = tokens(text)
        k = kinds(t)
        for i in range(len(t) - 4):
            low = [x.lower() for x in t[i : i + 5]]
            if sum(not x for x in k[i : i + 5]) >= 2:
                yield i, tuple((x, "") if x else ("", w) for x, w in zip(k[i : i + 5], low)), low, [bool(x) for x in k[i : i + 5]]
            else:
                yield i, ("filled", *low), low, [bool(x) for x in k[i : i + 5]]

    bench = [(i, list(windows(t))) for i, t in items]
    short = [(i, [x.lower() for x in tokens(t)]) for i, t in items if 0 < len(tokens(t)) < 5]
    out = {}
    for d, text in docs:
        own = list(windows(text))
        lines = [[x.lower() for x in tokens(line)] for line in (text or "").split("\n")]
        out.update({d: [i for i, ts in short if ts in lines]} if any(ts in lines for _, ts in short) else {})
        for i, theirs in bench:
            met = [{"item_pos": p, "own": low, "tokens": mine, "slots": s} for p, key, low, s in theirs for _, k2, mine, _ in own if key == k2]
            if theirs and met and dc.consistent_share(met, len(theirs)) >= 0.8:
                out.setdefault(d, []).append(i)
    return {d: sorted(set(v)) for d, v in out.items()}


def test_against_brute_force(make_docs, items):
    rng = random.Random(6)
    words = [rng.choice("abcdef") * rng.randint(1, 2) + rng.choice("xyz") for _ in range(40)]
    word = lambda: rng.choice([rng.choice(words), rng.choice(words), rng.choice(words).capitalize(), str(rng.randint(1, 30)), "5 kg", "m"])
    bench = [(i, " ".join(word() for _ in range(rng.randint(3, 25)))) for i in range(12)] + [(50, None), (51, ""), (3, "an item whose id is given twice 7 km away")]
    docs = []
    for i in range(140):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        if i % 2:
            item = rng.choice(bench)[1] or ""
            if i % 4 == 1:
                item = re.sub(r"\d+", lambda m: str(int(m[0]) + 3), item)
            if i % 8 == 3:
                item = item[: len(item) * 2 // 3]
            parts += [item, " ".join(word() for _ in range(rng.randint(0, 10)))]
        docs.append((i, rng.choice([" ", " ", "\n"]).join(parts)))
    docs += [(300 + i, f"before it\n{t}\nand after") for i, t in bench if t]
    got = flagged(dc.contamination(make_docs(docs), items(bench)))
    short = {i for i, t in bench if t and len(tokens(t)) < 5}
    assert got == brute(docs, bench) and len(got) > 10 and any(short & set(v) for v in got.values())
    long = [(i, t) for i, t in bench if i not in short]
    gone = set(brute(docs, long))
    assert {r["doc_id"] for r in dc.clean(make_docs(docs), items(bench)).collect()} == {d for d, _ in docs} - gone


def test_without_the_broadcast_filter(make_docs, items, monkeypatch):
    docs = [(1, f"before {PUZZLE}"), (2, "clean words only in this text here")]
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", 0)
    assert flagged(dc.contamination(make_docs(docs), items([(7, PUZZLE)]))) == {1: [7]}


def test_defined_cases(make_docs, items):
    docs = make_docs([(1, None), (2, ""), (None, PUZZLE), (3, PUZZLE), (3, PUZZLE), (4, f"{'pad ' * 20_000}{PUZZLE}"), (5, " ".join([PUZZLE] * 30))])
    out = dc.contamination(docs, items([(7, PUZZLE), (None, PUZZLE + " again"), (8, "too short")])).collect()
    assert sorted(((r["doc_id"], r["contaminated"]) for r in out), key=str) == sorted([(1, False), (2, False), (None, True), (3, True), (3, True), (4, True), (5, True)], key=str)
    assert dc.clean(docs, items([(7, PUZZLE)])).select(F.sort_array(F.collect_list("doc_id"))).first()[0] == [1, 2]
    assert dc.contamination(make_docs([]), items([(7, PUZZLE)])).collect() == []
    assert flagged(dc.contamination(docs, items([]))) == {}
