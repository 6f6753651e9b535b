import random
import re

import numpy as np
import xxhash

from dimloom.llm import simhash as S
from dimloom.llm.components import contract


def slow_print(text, k=4):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i:i + k]).encode(), 42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, radius):
    ids = list(prints)
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= radius and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def test_fingerprints_and_components_are_brute_force(clashing):
    rng = random.Random(3)
    vocabulary = [f"w{i}É" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80))) for _ in range(25)]
    for t in list(texts):
        ws = t.split()
        if len(ws) > 40:
            texts += [" ".join(ws[:-1]), " ".join(ws[:-1] + ["new"]), t.upper().replace("É", "É")]
    texts += ["", None, "  ", "One two", "one  TWO"]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.components(clashing(rows, "doc_id long, text string")).collect()}
    prints = {i: slow_print(t) for i, t in rows}
    assert {i: f[0] for i, f in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: f[1] for i, f in got.items()} == slow_components(prints, 4)


def test_tiles_join_all_links_of_a_ball(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2 ** 64, 6, dtype=np.uint64)
    prints = {int(c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)))) for c in centres for _ in range(40)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = S.links(spark.createDataFrame(signed, "fp long"), 4, tile=16)
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in contract(edges).collect()}
    least = slow_components({p: p for p in prints}, 4)
    groups = lambda of: sorted(sorted(p for p in prints if of(p) == g) for g in {of(p) for p in prints})
    assert groups(lambda p: roots.get(p, p)) == groups(lambda p: least[p])


def test_long_chain_contracts(spark):
    chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert contract(chain).select("root").distinct().count() == 1
    assert contract(chain.limit(0)).count() == 0


def test_odd_rows(odd_docs, no_docs):
    got = S.components(odd_docs).collect()
    assert len(got) == 11 and {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "6", "7", "8", "None"]
    assert S.components(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0
