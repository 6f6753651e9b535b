from itertools import permutations

import duckdb
import pytest

from dimloom.llm import audit
from dimloom.llm.queries import OP11


def _flags(docs):
    """Masks of (doc_id, text, source) rows by the plain definition."""
    out = []
    for i, text, source in docs:
        t = text or ""
        words = [w for w in t.translate(dict.fromkeys((9, 10, 11, 12, 13), " ")).split(" ") if w]
        mask = (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words)) + 4 * (100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t))
        mask += 8 * any(c in t for c in "#$%&*|")
        mask += 16 * (i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs))
        out.append((source or "", mask, i))
    return out


def _brute(docs, labels):
    flags, rows = _flags(docs), set()
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    for part in {f[0] for f in flags}:
        mine = [(m, i) for p, m, i in flags if p == part]
        steps, removed = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                bit, before = 1 << "ABCDE".index(f), sum(1 << "ABCDE".index(g) for g in order[:s])
                gone = [(m, i) for m, i in mine if m & bit and not m & before]
                removed[f] += len(gone)
                steps.append((f, part, "".join(order), s + 1, sum(not m & (before | bit) for m, _ in mine), len(gone),
                              sum(bool(m & bit and m & before) for m, _ in mine), sum(m == bit for m, _ in mine),
                              sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)))
        rows |= {(*row, removed[f]) for f, *row in steps}
    return rows


LONG = "alpha beta " + " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, LONG, "a"), (2, LONG, "a"), (2, LONG, "b"), (3, LONG + " #", "a"), (4, None, None), (5, "", "a"), (6, " \x0b\x0c\r\n ", "b"), (7, "UPPER CASE " * 40, "b"),
    (None, LONG, "a"), (None, LONG, "a"), (9, "same row", ""), (9, "same row", ""), (10, "same row", "a"), (8, "same row", "b"), (11, "nb sp " * 60, "a"),
    (12, "x" * 40_000, "a"), (13, "x" * 40_001, "a"), (14, "x" * 40_000, "b"), (15, "dÉjà 語 😀" * 9, "b"), (16, "a|b", "a"), (-5, "a|b", "a")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (None, 1, 1), (7, 1, 0), (12, 0, 1), (99, 1, 1), (14, 1, 1)]


@pytest.fixture
def tables(clashing, spark):
    return (clashing(DOCS, "doc_id long, text string, source string").selectExpr("*", "1 AS part", "2 AS mask", "3 AS n", "4 AS range"),
            spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS good", "2 AS n"))


@pytest.mark.parametrize("size", [None, 2_000, 64])
def test_report_like_brute_force(tables, size):
    got = {tuple(r) for r in audit.report(*tables, size=size).collect()}
    assert got == _brute(DOCS, LABELS) and len(got) == 3 * 600


def test_tries_let_go_of_finished_branches(tables, monkeypatch):
    monkeypatch.setattr(audit, "HELD", 100)
    got = {tuple(r) for r in audit.report(tables[0].repartition(3), tables[1], size=1_000).collect()}
    assert got == _brute(DOCS, LABELS)


def test_sql_says_the_same(tables):
    docs, labels = (t.toArrow() for t in tables)
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("labels", labels)
    want = con.sql(OP11)
    assert set(want.fetchall()) == {tuple(r) for r in audit.report(*tables).select(want.columns).collect()}


def test_shared_prefixes_are_split(spark):
    texts = [(i, "shared " * 400 + f"{i:05d} " * 30, "a") for i in range(400)] + [(1000 + i, f"{i} other text " * 9, "a") for i in range(100)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string")
    ranges = audit.ranges_of(df.selectExpr("CAST(text AS binary) AS text"), 100_000)
    dealt = [ranges.number(t.encode()) for _, t, _ in texts]
    sizes = [sum(len(t) for (_, t, _), r in zip(texts, dealt) if r == k) for k in range(ranges.count)]
    assert ranges.count >= 8 and max(sizes) < 4 * 100_000


def test_copies_leave_a_task_once(spark):
    """A third of all rows is one text; each task hands on one of them."""
    docs = spark.range(3000).selectExpr("id AS doc_id", f"IF(id % 3 = 0, '{LONG}', CONCAT('{LONG} ', id)) AS text", "'s' AS source").repartition(4)
    rows = audit.masks(docs, size=50_000)
    assert {(r.mask, r.n) for r in rows.groupBy("mask").sum("n").withColumnRenamed("sum(n)", "n").collect()} == {(0, 2001), (16, 999)}


def test_no_documents(spark, no_docs):
    assert audit.report(no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_trie_holds_smallest_ids_in_text_order():
    trie = audit.Trie()
    texts = [b"", b"ab", b"abc", b"abd", b"b", b"ab", b"a", b"abd"]
    lost = [r for i, t in enumerate(texts) for r in trie.add(t, 10 - i, {"p": 1}, 0)]
    assert [(t, n.best) for t, n in trie.traverse()] == [(b"", 10), (b"a", 4), (b"ab", 5), (b"abc", 8), (b"abd", 3), (b"b", 6)]
    assert lost == [(9, "p", 16, 1), (7, "p", 16, 1)]
