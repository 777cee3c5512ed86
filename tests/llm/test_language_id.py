import random
import tracemalloc
import zlib

import cloudpickle_by_value
import numpy as np

from claimspark.llm import language_id as li

SOUNDS = {"aa": ["ka", "lo", "mi"], "bb": ["sh", "tro", "ue"], "cc": ["zö", "ñe", "pf"]}


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SOUNDS))
        rows.append((i, " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 40))), lang))
    return rows


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 if doc_id is not None else None


def test_held_out_rows_are_found(make_docs):
    rows = made(300)
    got = li.identify(make_docs(rows)).collect()
    lang = {r[0]: r[2] for r in rows}
    assert len(got) == 300 and all(r["held_out"] == (remainder(r["doc_id"]) == 2) for r in got)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]) > 0.97


def test_prediction_reads_the_text_alone(make_docs):
    rows = made(200)
    filters = li.learn(make_docs(rows))
    other = [(r[0] + 7_000, r[1], None) for r in rows]
    a = [(r["lang_pred"], r["score"]) for r in li.predict(make_docs(rows), filters).orderBy("doc_id").collect()]
    b = [(r["lang_pred"], r["score"]) for r in li.predict(make_docs(other), filters).orderBy("doc_id").collect()]
    assert a == b


def test_defined_cases(make_docs):
    rows = made(200)
    odd = [(1000, None), (1001, ""), (1002, "12 !? 34"), (None, rows[0][1]), (5, "kalo"), (5, "kalo"), (1003, "ka" * 60_000), (1004, "z")]
    got = {}
    for r in li.identify(make_docs(rows + odd)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [(got[k][0]["lang_pred"], got[k][0]["score"]) for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[None][0]["held_out"] is False and got[None][0]["lang_pred"] == rows[0][2]
    assert len(got[5]) == 3 and got[1003][0]["lang_pred"] == "aa" and got[1004][0]["lang_pred"] in SOUNDS
    assert li.identify(make_docs([])).collect() == []
    assert {r["lang_pred"] for r in li.identify(make_docs([(1, "no label")])).collect()} == {"und"}
    assert sorted(r["doc_id"] for r in li.keep_known(make_docs(rows + odd[:3])).collect()) == list(range(200))


def test_a_text_scores_the_same_alone_and_among_others(make_docs):
    filters = li.learn(make_docs(made(150)))
    whole = ["", "ka", "kalo mi", "pf", "a", "trosh ue zö", "  ", "ue"] + [r[1] for r in made(20, 3)]
    together = filters.predict(whole)
    assert [filters.predict([t])[0] for t in whole] == together


def test_small_parts_give_the_same(make_docs, monkeypatch):
    docs = make_docs(made(300) + [(1000, None), (1001, ""), (1002, "12"), (1003, "qqq www"), (1004, "ka" * 3_000)]).coalesce(1)
    whole, kept, found = li.learn(docs), li.keep_known(docs).collect(), li.predict(docs, li.learn(docs)).collect()
    monkeypatch.setattr(li, "ROW_BYTES", 500)
    monkeypatch.setattr(li, "COUNT_BYTES", 200)
    with cloudpickle_by_value.of(li):
        cut = li.learn(docs)
        assert cut.languages == whole.languages and np.array_equal(cut.slots, whole.slots)
        assert li.keep_known(docs).collect() == kept and li.predict(docs, cut).collect() == found
    assert 300 <= len(kept) < 305


def test_letters_take_no_more_than_their_table(monkeypatch):
    monkeypatch.setattr(li, "_LETTERS", [])
    tracemalloc.start()
    try:
        assert li._letters().sum() == sum(chr(c).isalpha() for c in range(0x110000))
        assert tracemalloc.get_traced_memory()[1] < 2 << 20
    finally:
        tracemalloc.stop()


def brute_share(filters, text, lang):
    """Corrected share over n-grams taken one by one."""
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    bit, hits, total = filters.languages.index(lang), 0, 0
    for order in li.ORDERS:
        for i in range(len(clean) - order + 1):
            gram = clean[i : i + order]
            if gram == " ":
                continue
            h = order
            for c in gram:
                h = (h * 0x100000001B3 + ord(c)) % 2**64
            h ^= h >> 29
            total += 1
            hits += all(filters.slots[(h * m % 2**64) >> (64 - li.SLOTS_LOG2), bit // 8] >> (bit % 8) & 1 for m in li._MULTIPLIERS)
    rate = filters.false_rate[bit]
    return min(1.0, max(0.0, (hits - total * rate) / max(total - total * rate, 1)))


def test_shares_against_brute_force(make_docs):
    filters = li.learn(make_docs(made(150)))
    whole = [r[1] for r in made(15, 8)] + ["Kalo, mi-shtro 12 ue!", "ñe"]
    shares, _ = filters.shares(whole)
    for i, text in enumerate(whole):
        for k, lang in enumerate(filters.languages):
            assert abs(shares[i, k] - brute_share(filters, text, lang)) < 1e-9


def test_without_labels_all_documents_stay(make_docs):
    rows = [(1, "some words here", None), (2, None, None), (3, "", None), (3, "12", None)]
    docs = make_docs(rows)
    assert li.keep_known(docs).collect() == docs.collect() and li.keep_known(docs).columns == docs.columns
    assert li.keep_known(make_docs([])).collect() == []
