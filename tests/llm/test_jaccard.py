import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from dimloom.llm import jaccard as J


def grams(text, k=5):
    ws = (text or "").lower().split()
    return {tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))}


def slow_components(texts):
    sets, least = [grams(t) for t in texts], list(range(len(texts)))
    near = [(i, j) for i in range(len(texts)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    return least, len(near)


def corpus():
    """Texts with 0 to 12 words changed (similarities on both sides of 0.8), a large group, and a passage that unlike texts quote."""
    rng = random.Random(5)
    say = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    texts = [say(rng.randint(3, 160)) for _ in range(60)]
    for base in list(texts):
        for changes in (1, 2, 3, 6, 12):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"new{rng.random()}"
            texts.append(copy)
    group, passage = say(120), say(60)
    for _ in range(60):
        copy = list(group)
        copy[rng.randrange(120)] = f"new{rng.random()}"
        copy[rng.randrange(120)] = f"new{rng.random()}"
        texts.append(copy)
        texts.append(passage + say(20))
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def test_stage_keeps_one_of_each_brute_force_component(spark, clashing):
    texts = corpus()
    want, links = slow_components(texts)
    assert links > 140 and len(set(want)) > 100
    docs = clashing(list(enumerate(texts)), "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(2)
    common = np.sort(rng.choice(1000, 50, replace=False))
    rank = rng.permutation(50)
    for _ in range(2000):
        a = np.unique(rng.integers(0, 1000, rng.integers(1, 60)))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 1000, rng.integers(0, 6)))))
        both = len(np.intersect1d(a, b))
        if len(b) and both >= 0.8 * (len(a) + len(b) - both):
            assert len(np.intersect1d(*(J.prefix_of(x, common, rank, 0.8) for x in (a, b))))


def test_similar_sets_have_room_from_their_first_shared_shingle_on():
    rng = np.random.default_rng(6)
    ruled_out = 0
    for _ in range(2000):
        common = np.sort(rng.choice(1000, 50, replace=False))
        a = np.unique(rng.integers(0, 1000, rng.integers(1, 60)))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < rng.uniform(0.6, 1)], rng.integers(0, 1000, rng.integers(0, 6)))))
        x, y = (J.prefix_of(s, common, np.arange(50), 0.8).tolist() for s in (a, b))
        first = next((k for k in x if k in y), None)
        can = first is not None and J.room(len(a) - x.index(first), len(a), len(b), 0.8) and J.room(len(b) - y.index(first), len(b), len(a), 0.8)
        both = len(np.intersect1d(a, b))
        assert can or not len(b) or both < 0.8 * (len(a) + len(b) - both)
        ruled_out += first is not None and not can
    assert ruled_out > 100


def test_candidates_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Variants of one text, too far from each other to link: all of them were met in pairs."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 9000)}" for _ in range(200)]
    texts = []
    for i in range(40):
        copy = list(base)
        for k in range(6):
            copy[3 + i % 20 + 30 * k] = f"new{rng.random()}"
        texts.append(" ".join(copy))
    want, links = slow_components(texts)
    assert links < 60
    met = []
    monkeypatch.setattr(J, "_linked", lambda pairs, *rest, f=J._linked: met.append(pairs.distinct().count()) or f(pairs, *rest))
    kept = J.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))
    assert sum(met) <= 4 * len(texts)


def test_rows_without_id_or_under_one_id_are_judged_by_text(spark, clashing):
    rows = [(None, "one text without an id"), (None, "another text without an id"), (5, "this text has number five"), (5, "so has that other text"),
            (6, "twice the same"), (6, "twice the same"), (None, "THIS text has number five"), (7, None), (8, " ")]
    kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, clashing(rows, "doc_id long, text string"), "")
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, [*rows[:5], rows[7]]))


def test_shuffled_joins_give_the_same(spark, clashing, monkeypatch):
    """No table is small enough to broadcast."""
    monkeypatch.setattr(J, "FEW", -1)
    texts = corpus()[:150]
    want, _ = slow_components(texts)
    kept = J.keep_one(clashing(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def test_empty_tables_odd_texts_and_names_of_its_own(spark, odd_docs, no_docs):
    assert J.keep_one(no_docs).count() == 0
    names = ["cid", "bucket", "cids", "_id", "_hash", "n", "mark", "shingles", "key", "many", "stays"]
    docs = odd_docs.selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(names)])
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    # Null, empty and blank texts are one class, and so are the repeated rows.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "None", "4", "5", "5", "6", "7", "8"])


def test_marks_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(4)
    ruled_out = 0
    for _ in range(600):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(-2**63, 2**63 - 1, n))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < rng.uniform(0.5, 1)], rng.integers(-2**63, 2**63 - 1, int(rng.integers(0, n // 4 + 2))))))
        both = len(np.intersect1d(a, b))
        near = both >= 0.8 * (len(a) + len(b) - both) - 1e-9
        can = J.can_be_near(len(a), J.mark_of(a), len(b), J.mark_of(b), 0.8)
        assert can or not near
        ruled_out += not can
    assert ruled_out > 200


def test_a_bucket_hands_on_the_pairs_that_marks_leave_room_for(spark):
    """Unlike texts of one bucket, each a component: 19,900 pairs, of which those that ``can_be_near`` lets pass remain."""
    rng, least = np.random.default_rng(11), 0.8
    sets = [np.unique(rng.integers(-(1 << 63), 1 << 63, int(n), dtype=np.int64)) for n in rng.integers(15, 260, 180)]
    for x in sets[:20]:  # a partner with one to some tenths of the shingles replaced, for some on the other side of a mark's length
        some = max(1, int(len(x) * rng.uniform(0.01, 0.1)))
        sets.append(np.unique(np.concatenate((x[some:], rng.integers(-(1 << 63), 1 << 63, int(some * rng.uniform(0.2, 1.2)), dtype=np.int64)))))
    marks = [J.mark_of(s) for s in sets]
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if J.can_be_near(len(sets[i]), marks[i], len(sets[j]), marks[j], least)}
    assert 15 <= len(want) < 200 and len({len(m) for m in marks}) > 4
    packed = [(i, len(s), bytes(np.packbits(m))) for i, (s, m) in enumerate(zip(sets, marks))]
    members = [{"node": i, "root": i, "n": n, "at": 0} for i, n, _ in packed]
    open_ = spark.createDataFrame([(1, members)], "bucket long, ms array<struct<node: long, root: long, n: int, at: int>>")
    found = J._across(open_, spark.createDataFrame(packed, "cid long, n long, mark binary"), least).collect()
    assert sorted((r.a, r.b) for r in found) == sorted(want)


def test_packed_hashes_keep_their_upper_bits():
    a = np.sort(np.random.default_rng(1).integers(-2**63, 2**63 - 1, 500))
    assert (J.unpacked(J.packed(a)) == (a.view(np.uint64) >> np.uint64(16)).astype(np.int64)).all()


def test_fingerprints_bring_pairs_and_sets_confirm_them(spark, monkeypatch):
    rng = random.Random(8)
    say = lambda n: [f"w{rng.randint(0, 4000)}" for _ in range(n)]
    base = say(400)
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(say(400)), " ".join(say(400))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # The named method alone: no pair of a star, only those the fingerprints bring together.
    monkeypatch.setattr(J, "_linked", lambda pairs, *rest, f=J._linked: f(J.alike(named), *rest))
    named = docs.select(J._class(5)("text").alias("n")).select("n.*")
    assert J.alike(named).count() == 1
    assert sorted(r.doc_id for r in J.keep_one(docs).collect()) == [0, 2, 3]
    # One fingerprint for all: what the sets do not confirm stays.
    named = named.withColumn("fp", F.lit(7).cast("long"))
    assert J.alike(named).count() == 3
    assert {2, 3} <= {r.doc_id for r in J.keep_one(docs).collect()}
