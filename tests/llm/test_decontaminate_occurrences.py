import re

import pytest
from test_decontaminate import MIXED, OTHER, PUZZLE, brute, flagged, items  # noqa: F401

from claimspark.llm import decontaminate as dc


def variant(one, number, two):
    return re.sub("John|Mary|12", lambda m: {"John": one, "Mary": two, "12": str(number)}[m[0]], PUZZLE)


PAIRS = [("Carl", 50, "Zoe"), ("Aaron", 3, "Bea"), ("Zack", 99, "Yves"), ("Mary", 7, "John")]


@pytest.mark.parametrize("between", ["", " and some quite other words stand here before it comes again "])
def test_each_occurrence_is_judged_apart(make_docs, items, between):  # noqa: F811
    docs = []
    for k, v in enumerate(PAIRS):
        docs += [(10 * k + 1, f"{OTHER} {between}{variant(*v)}"), (10 * k + 2, f"{PUZZLE} {between}{variant(*v)}"), (10 * k + 3, f"x {variant(*v)} {between}{PUZZLE}")]
    assert not {1, 2} <= set(brute(docs, [(7, PUZZLE)]))
    assert flagged(dc.contamination(make_docs(docs), items([(7, PUZZLE)]))) == {d: [7] for d, _ in docs}


def test_occurrence_with_added_words_beside_a_variant(make_docs, items):  # noqa: F811
    longer = variant("Ann Marie", 12, "Mary")
    got = flagged(dc.contamination(make_docs([(1, f"{longer} {OTHER}"), (2, f"{MIXED} {MIXED}")]), items([(7, PUZZLE)])))
    assert got == {1: [7]}


def test_verbatim_copies_in_other_letter_case(make_docs, items):  # noqa: F811
    docs = [(k, f"Before it. {text} And after.") for k, text in enumerate([PUZZLE.lower(), PUZZLE.upper(), PUZZLE.title(), PUZZLE.swapcase(), PUZZLE])]
    docs += [(9, MIXED.lower()), (10, " ".join(reversed(PUZZLE.lower().split())))]
    assert flagged(dc.contamination(make_docs(docs), items([(7, PUZZLE)]))) == {k: [7] for k in range(5)}
    assert flagged(dc.contamination(make_docs(docs), items([(7, PUZZLE.lower())]))) == {k: [7] for k in range(5)}


def test_items_of_under_five_tokens(make_docs, items):  # noqa: F811
    docs = [(1, "then\n Name four odd Primes.\nend"), (2, "Name odd four primes"), (3, "PRIMES"), (4, "prime"), (5, None), (6, "name four odd"), (7, "then name four odd primes")]
    bench = items([(1, "Name four odd primes"), (2, "Primes?"), (3, "?!")])
    assert flagged(dc.contamination(make_docs(docs), bench)) == {1: [1], 3: [2]}
    assert dc.clean(make_docs(docs), bench).count() == 7


def test_common_words_as_items_remove_nothing(make_docs, items):  # noqa: F811
    docs = [(i, f"the document {i} of the many\nthe\nthat hold the common word") for i in range(200)] + [(900, PUZZLE), (901, PUZZLE)]
    bench = items([(1, "the"), (2, "of the"), (7, PUZZLE)])
    assert dc.clean(make_docs(docs), bench).count() == 200
    found = flagged(dc.contamination(make_docs(docs), bench))
    assert found[900] == [7] and all(found[i] == [1] for i in range(200))
