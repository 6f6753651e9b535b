import hashlib
import random
import re

from dimloom.llm import disclosure as D

PATTERNS = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
            ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def fits(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS) for m in p.finditer(text or "") if fits(kind, m[0]))


def test_base_spans_are_the_plain_patterns():
    rng = random.Random(2)
    parts = ["a.b@c-d.ef", "@", "x@y", "1.2.3.4", "300.1.2.3", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0153", "+12",
             " ", ".", "+", "é", "9", "00", "a@b.c.", "%", "x_y@z.co", "0001.1.1.1", "-", "(", "😀"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in D.base_spans(text)] == brute(text), text


def test_very_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1 " * 100_000, "4" * 12 + " " * 100_000 + "a.b-" * 50_000 + "@x.y"):
        D.base_spans(text)


def corpus():
    """Three contexts of one address, always beside one rare word and among common ones."""
    rng = random.Random(4)
    common = [f"com{chr(97 + i)}on" for i in range(20)]
    fill = lambda n: " ".join(rng.choice(common) for _ in range(n))
    docs = [(i, f"{fill(12)} Zarkovia {fill(2)} zoe@mail.example.org {fill(12)}") for i in range(4)]
    docs += [(10 + i, f"{fill(30)}") for i in range(60)]
    docs += [(100 + i, f"{docs[10][1]} ann@mail.example.org only here {docs[11][1]}") for i in range(5)]  # copies: one context
    return docs


def test_disclosing_terms_join_the_base_spans_and_copies_do_not_count(clashing):
    docs = corpus()
    rows = {r.doc_id: r for r in D.digests(clashing(docs, "doc_id long, text string")).collect()}
    for doc_id, text in docs:
        base = ",".join(f"{D.KINDS[k]}:{a}:{b}" for a, k, b in brute(text))
        assert rows[doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        at = text.find("Zarkovia")
        extra = [f"term:{at}:{at + 8}"] if at >= 0 else []
        assert rows[doc_id].spans.split(",") == (extra + [base] if extra else [base])


def test_copies_do_not_hide_a_disclosing_term(clashing):
    docs = corpus() + [(i, f"some other words number {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}") for i in range(1000, 1200)]
    docs += [(2000 + i, docs[0][1]) for i in range(60)] + [(3000 + i, f"{docs[1][1]} more{chr(97 + i)}") for i in range(26)]  # whole and quoted
    rows = {r.doc_id: r for r in D.digests(clashing(docs, "doc_id long, text string")).collect()}
    for i in (0, 3, 2005, 3005):
        at = dict(docs)[i].find("Zarkovia")
        assert f"term:{at}:{at + 8}" in rows[i].spans.split(",")


def test_sanitised_text(clashing):
    docs = corpus() + [(900, None), (901, "call +1 (212) 555-0153 or 10.0.0.1!")]
    table = clashing(docs, "doc_id long, text string").selectExpr("*", "length(text) AS n_chars")
    clean = D.sanitise(table)
    assert clean.columns == table.columns
    got = {r.doc_id: r for r in clean.collect()}
    assert got[901].text == "call [PHONE] or [IP]!" and got[901].n_chars == len(got[901].text) and got[900].text is None
    assert "Zarkovia" not in got[0].text and "[EMAIL]" in got[0].text and got[20].text == dict(docs)[20]


def test_odd_rows(odd_docs, no_docs):
    got = D.digests(odd_docs).collect()
    assert len(got) == 11 and {r.spans for r in got} == {""}
    assert D.digests(no_docs).count() == 0 and D.sanitise(no_docs).count() == 0
    assert sorted(map(str, D.sanitise(odd_docs).collect())) == sorted(map(str, odd_docs.collect()))


def test_contexts_of_a_long_log_take_linear_time():
    text = "seen 10.0.0.1 " + "10.0.0.1 " * 110_000 + "by Zoe"
    found = D.contexts(text, D.base_spans(text), 8)
    assert len(found) == 110_001 and set(found) == {("ip:10.0.0.1", "seen zoe")}


def test_contexts_are_the_nearest_words_outside_all_spans():
    text = "one two three four a@b.co five 1.2.3.4 six seven eight"
    assert D.contexts(text, D.base_spans(text), 2) == [("email:a@b.co", "five four six three"), ("ip:1.2.3.4", "five four seven six")]
