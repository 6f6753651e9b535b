import hashlib
import re

import pytest

from dimloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, n):
    wins = {}
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - n + 1) if ws else 0):
            wins.setdefault(tuple(ws[i:i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        ws, hit, named = words(text), set(), set()
        for length in {len(w) for w in wins}:
            for i in range(len(ws) - length + 1):
                if tuple(ws[i:i + length]) in wins:
                    hit |= set(range(i, i + length))
                    named |= wins[tuple(ws[i:i + length])]
        ids = sorted(str(x) for x in named if x is not None)
        out.append((doc_id, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "a b c d e f"), (2, "c d e f g"), (11, "Solo"), (3, None), (4, "--"), (5, "É È é"), (6, "a b c d e f")]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7])
def test_report_is_brute_force(spark, clashing, n):
    docs = [(1, "A b; c-D e f g z"), (2, "a b c d"), (3, None), (4, "solo"), (5, "x c d e f g c d e f"), (6, "é È é"), (6, "é È é"), (None, "SOLO a"), (7, "")]
    got = D.report(clashing(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string"), n)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(docs, ITEMS, n), key=key)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.report(no_docs, some).count() == 0
    assert {r.contaminated for r in D.report(odd_docs, none).collect()} == {False}
    assert D.report(odd_docs, some).count() == odd_docs.count()
    assert D.drop_documents(odd_docs, some).columns == odd_docs.columns


def test_spans_go_and_clean_text_stays(spark, clashing):
    items = spark.createDataFrame([(1, "the secret answer is forty two")], "item_id long, text string")
    docs = clashing([(1, "Before: The secret, answer is FORTY two! After."), (2, "Nothing here; is it?"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in D.remove_spans(docs, items, 4).collect()}
    assert got == {1: "Before: After.", 2: "Nothing here; is it?", 3: None}
    assert {r.doc_id for r in D.drop_documents(docs, items, 4).collect()} == {2, 3}


def test_a_very_long_text(spark):
    many = 500_000
    text = " ".join(f"w{i % 1000}" for i in range(many)) + " one two three four five six seven eight nine ten"
    items = [(7, "one two three four five six seven eight nine ten"), (8, "w999 w998"), (9, "w5 w6 w7")]
    got = D.report(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r.n_words, r.n_hit, r.n_items) for r in got] == [(many + 10, 10 + 3 * many // 1000, 2)]


def test_both_ways_of_joining_give_the_same(spark, clashing, monkeypatch):
    docs = [(1, "A b; c-D e f g z"), (2, "a b c d"), (3, None), (4, "solo"), (5, "x c d e f g c d e f"), (6, "é È é"), (6, "é È é"), (None, "SOLO a")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(D, "BROADCAST_LEAKS", 0)
    key = lambda r: tuple(str(x) for x in r)
    got = D.report(clashing(docs, "doc_id long, text string"), items, 3)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(docs, ITEMS, 3), key=key)
    assert sorted(str(r.doc_id) for r in D.drop_documents(clashing(docs, "doc_id long, text string"), items, 3).collect()) == sorted(
        str(r[0]) for r in brute(docs, ITEMS, 3) if not r[-1])
