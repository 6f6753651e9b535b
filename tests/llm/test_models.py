"""Operators that learn: toxicity, language model, language identification, pages, licences."""
import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest

from dimloom.llm import langid, licences, pages, ppm, toxicity


# Toxicity

def toxic_rows():
    rng = random.Random(6)
    words = ["river", "stone", "house", "green", "quiet", "paper", "seven", "cloud", "table", "music"]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))
        bad = i % 4 == 0
        if bad:
            text += " " + rng.choice(["you utter gribbler", "GRIBBLER!!", "what a snorfian, you", "gr1bbl3r you"]) + " " + rng.choice(words)
        rows.append((i, text, int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark, clashing):
    rows = toxic_rows()
    docs = clashing([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(1, None), (10_000, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, trees=5)
    got = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if i % 5 == 0]
    assert np.mean([p == y for p, y in held]) >= 0.95 and all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_toxicity_without_both_labels_and_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 0), (5, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.scores(odd_docs, model).collect()
    assert len(got) == 11 and len({r.score for r in got}) == 1
    assert toxicity.fit(no_docs, labels).prior == 0 and toxicity.scores(no_docs, model).count() == 0


def test_disguised_words_and_proximity():
    flags = toxicity.Flags({"idiot": 4.0, "moro*": 3.0})
    at = dict(zip(toxicity.FEATURES, toxicity.features_of("You are an 1d10t , mister moronic. IDIOT!!", flags)))
    assert at["disguised"] > 0 and at["stems"] > 0 and at["lexicon"] > 0 and at["near_you"] > 0 and at["shouted"] > 0
    assert toxicity.features_of("", flags) == [0.0] * len(toxicity.FEATURES)


def test_words_of_any_length_are_read_whole():
    flags = toxicity.Flags({"moro*": 3.0})
    at = dict(zip(toxicity.FEATURES, toxicity.features_of("moro" + "x" * 100_000 + "-y aaa bbbccc " + "q" * 500 + "%d", flags)))
    assert at["stems"] == 0.25 and at["repeated"] == 1.0 and at["obscured"] == 0.25
    assert all(len(w) <= toxicity.MEMO_LENGTH for w in flags)
    assert "z" * 300 in toxicity.terms_of("z" * 300)


def test_labels_of_copies_are_joined_before_one_stays(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(16)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 and i < 8)) for i in range(16)] + [(i, None) for i in range(16)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels, trees=1).prior == 0.5


@pytest.mark.parametrize("word", ["Idiot,", "1D10T!", "i.d.i.o.t", "(IDIIIOT)", "idi-ot", "ǅidiot", "İdiot", "idiot'", "...", "a", "ID10T?!", "x1y"])
def test_flags_agree_with_plain_rules(word):
    lexicon = {"idiot": 4.0, "idio*": 2.0}
    bare, flag, weight = re.sub(r"^[\W\d_]+|[\W\d_]+$", "", word.lower()), 0, 0.0
    if bare in lexicon:
        flag, weight = toxicity._LEX, 4.0
    elif bare[:4] + "*" in lexicon and len(bare) > 4:
        flag, weight = toxicity._STEM, 2.0
    else:
        for one in "il":
            clear = re.sub(r"[\W\d_]+", "", word.lower().translate(str.maketrans("013457@$!|", f"o{one}eastas{one}{one}")))
            if "idiot" in {clear, re.sub(r"(.)\1+", r"\1", clear)} - {bare}:
                flag, weight = toxicity._DISGUISED, 4.0
    got = toxicity.Flags(lexicon)[word]
    assert got & (toxicity._LEX | toxicity._STEM | toxicity._DISGUISED) == flag and got >> 8 == int(4 * weight)
    assert bool(got & toxicity._OBSCURED) == bool(toxicity._INSIDE.search(word)) and bool(got & toxicity._BANG) == ("!" in word)
    assert bool(got & toxicity._SHOUT) == (len(bare) >= 3 and word.upper() == word and word.lower() != word)


# Language model

def slow_ppm(train, text, order):
    counts = Counter()
    for t in train:
        seq = "\n" * order + t + "\n"
        for i in range(order, len(seq)):
            for k in range(order + 1):
                counts[seq[i - k:i], seq[i]] += 1
    kids = {}
    for (context, s), n in counts.items():
        kids.setdefault(context, {})[s] = n
    seq, total = "\n" * order + text + "\n", 0.0
    for i in range(order, len(seq)):
        barred, p = set(), 1.0
        for k in range(order, -1, -1):
            found = kids.get(seq[i - k:i])
            if found is None:
                continue
            left = {s: n for s, n in found.items() if s not in barred}
            if not left:
                continue
            mass = 2 * sum(left.values())
            if seq[i] in left:
                p *= (2 * left[seq[i]] - 1) / mass
                break
            p *= len(left) / mass
            barred |= set(found)
        else:
            p /= 256 - len(kids.get("", {}))
        total += math.log10(p)
    return total


def test_language_model_is_brute_force(spark, clashing):
    rng = random.Random(8)
    make = lambda: " ".join("".join(rng.choice("abcab") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 30)))
    rows = [(i, make()) for i in range(40)] + [(90, "zzz abc"), (91, None), (92, ""), (93, "AB  \t c\n")]
    docs = clashing(rows, "doc_id long, text string")
    norm = lambda t: " ".join(w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w)
    train = [norm(t) for i, t in rows if i < 30]
    for order in (0, 1, 3, 5):
        got = {r.doc_id: r for r in ppm.score(docs, ppm.fit(docs.filter("doc_id < 30"), order)).collect()}
        assert all(got[i].score == pytest.approx(slow_ppm(train, norm(t), order), rel=1e-5) for i, t in rows)
    c = Counter(w for t in train for w in [*t.split(), None])
    total, distinct = sum(c.values()), len(c)
    for i, t in rows:
        words = [*norm(t).split(), None]
        want = sum(math.log10((c.get(w, 0) + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert got[i].base_score == pytest.approx(want, rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(words), sum(w in c for w in words), total)


def test_language_model_in_shards_is_the_whole_one(spark, clashing):
    rng = random.Random(12)
    make = lambda: " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 60)))
    docs = clashing([(i, make()) for i in range(60)] + [(90, None), (90, "abc"), (91, "abc"), (None, "é z")], "doc_id long, text string")
    sharded = ppm.fit(docs.filter("doc_id < 40"), entries=2_500)
    whole = ppm.fit(docs.filter("doc_id < 40"))
    scored = lambda model: [x for row in sorted(map(tuple, ppm.score(docs, model).collect()), key=str) for x in row]
    got, want = scored(sharded), scored(whole)
    assert [x for x in got if x is not None] == pytest.approx([x for x in want if x is not None], rel=1e-6)
    assert len(sharded.shards) > 2 and len(whole.shards) == 1


def test_language_model_head_and_join_agree(spark, clashing, monkeypatch):
    docs = clashing([(i, f"common word{i} common word{i // 2}") for i in range(20)], "doc_id long, text string")
    scored = lambda: [x for row in sorted(map(tuple, ppm.score(docs, ppm.fit(docs, 2)).collect())) for x in row]
    whole = scored()
    monkeypatch.setattr(ppm, "HEAD", 1)
    assert scored() == pytest.approx(whole)


def test_probabilities_of_a_context_sum_to_one():
    texts = [b"abracadabra", b"banana", b"cab"]
    key, n = np.unique(ppm.grams(texts, 3), return_counts=True)
    levels = [(key, n)]
    for k in range(3, 0, -1):
        low, at = np.unique(levels[-1][0] & np.uint64((1 << 8 * k) - 1), return_inverse=True)
        levels.append((low, np.bincount(at, weights=levels[-1][1]).astype(np.int64)))
    trie = ppm.Trie(levels[::-1])
    for context in (b"bra", b"ana", b"zzz", b"zza", b"\n\n\n"):
        head = np.uint64(int.from_bytes(context, "big") << 8)
        assert (10 ** trie.lengths(head | np.arange(256, dtype=np.uint64))).sum() == pytest.approx(1, rel=1e-5)


def test_language_model_thinned_and_without_training(spark, odd_docs, no_docs):
    model = ppm.fit(odd_docs, 3, entries=8)
    got = ppm.score(odd_docs, model).collect()
    assert len(got) == 11 and all(math.isfinite(r.score) and r.score < 0 for r in got)
    bare = ppm.score(odd_docs, ppm.fit(no_docs)).collect()
    assert {(r.n_known, r.train_tokens) for r in bare} == {(0, 0)}
    assert ppm.score(no_docs, model).count() == 0


# Language identification

def test_mixtures_of_languages(spark, clashing):
    rng = random.Random(9)
    sound = {"aa": ["ka", "ko", "ti", "ra"], "bb": ["schu", "lff", "erm", "ong"], "cc": ["wyx", "quz", "jiv", "ypp"]}
    say = lambda lang, n: " ".join("".join(rng.choice(sound[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    train = clashing([(lang, say(lang, 200)) for lang in sound for _ in range(3)] + [("aa", None), (None, "kako")], "lang string, text string")
    model = langid.fit(train)
    docs = [(1, say("aa", 40)), (2, say("bb", 60) + ". " + say("cc", 30)), (3, "123 !?"), (4, None), (5, ""), (6, say("cc", 1)), (6, say("cc", 1))]
    got = {r.doc_id: r for r in langid.predict(clashing(docs, "doc_id long, text string"), model).collect()}
    assert got[1].lang_pred == "aa" and got[1].languages == ["aa"]
    assert got[2].lang_pred == "bb" and sorted(got[2].languages) == ["bb", "cc"] and got[2].proportions[0] == pytest.approx(2 / 3, abs=0.12)
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and got[6].lang_pred == "cc"


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    none = langid.fit(no_docs.selectExpr("text", "text AS lang"))
    assert {r.lang_pred for r in langid.predict(odd_docs, none).collect()} == {"und"}
    one = langid.fit(odd_docs.selectExpr("text", "'xx' AS lang"))
    got = langid.predict(odd_docs, one).collect()
    assert len(got) == 11 and {r.lang_pred for r in got} == {"xx", "und"} and langid.predict(no_docs, one).count() == 0


# Pages

def made(seed, n):
    rng = random.Random(seed)
    stock = pages._PLAIN + ["Short.", "A remark on prices & taxes: they <rise>."]
    return [pages.layouts("A title of some length", [rng.choice(stock) for _ in range(rng.randint(2, 7))], pages._LABELS, rng) for _ in range(n)]


def test_main_text_of_unseen_layouts(spark):
    chain = pages.train([pages._labelled(html, main.split("\n")) for html, main in made(1, 250)])
    exact = [pages.main_text(html, chain) == main for html, main in made(2, 80)]
    assert np.mean(exact) >= 0.85


def test_blocks_of_broken_markup():
    html = ("<p>one <b>two<br>three<p>four &amp five&nbsp;six<script>var t='</p>'</script><!-- x --><ul><li>a<li><a href='>'>b</a></ul></div>"
            "<style>p{}</style><textarea>no</textarea>tail<p")
    assert [b.text for b in pages.blocks_of(html)] == ["one two three", "four & five six", "a", "b", "tail"]
    assert [b.text for b in pages.blocks_of("<p class='x>one</p><p>a < b <i>c</i></p>")] == ["one", "a < b c"]
    assert pages.blocks_of("") == [] and pages.blocks_of("<script>never closed") == []
    assert len(pages.blocks_of("<div>" * 3_000 + "deep")) == 1


def test_blocks_of_pages_without_head_ends_and_with_unclosed_parts():
    texts = lambda html: [b.text for b in pages.blocks_of(html)]
    assert texts("<html><head><title>t</title><meta charset=x><h1>One</h1><p>two") == ["One", "two"]
    assert texts("<head><title>t</title><style>a</style>plain <b>words</b><p>two</head>") == ["plain words", "two"]
    assert texts("<head><title>t</title><a href=x>link</a><noscript>no</noscript></head><body><p>x") == ["link", "x"]
    for tag in ("svg", "noscript", "select", "template"):
        assert texts(f"<p>one</p><{tag}><p>two</p><{tag}><p>three") == ["one", "two", "three"], tag
    assert texts("<p>one</p><svg/><p>two</p><svg>no</svg>") == ["one", "two"]


def test_viterbi_is_the_best_labelling():
    chain = pages.train([pages._labelled(html, main.split("\n")) for html, main in made(3, 40)], rounds=30)
    blocks = pages.blocks_of(made(4, 1)[0][0])[:9]
    ids, same = chain.rows(blocks)

    def value(path):
        return sum(chain.emit[i].sum(0)[y] for i, y in zip(ids, path)) + sum(
            chain.move[s, a, b] for s, a, b in zip(same[1:], path, path[1:]))

    every = [[n >> i & 1 for i in range(len(blocks))] for n in range(1 << len(blocks))]
    assert value(chain.label(blocks)) == pytest.approx(max(map(value, every)))


def test_pages_with_odd_rows(clashing):
    rows = [(i, f"u{i}", f"<html><body><nav><a>menu</a></nav><article><h1>T {i}</h1><p>{'Some sentence, and more. ' * 8}</p><p>Next.</p></article>"
                         "<footer>&copy; x</footer>") for i in range(8)]
    rows += [(100, None, None), (101, "u", ""), (None, "n", "<p>"), (102, "v", "plain words only")]
    table = clashing(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in pages.extract(table, pages.fit(table)).collect()}
    assert got[3].text == f"T 3\n{('Some sentence, and more. ' * 8).strip()}\nNext." and got[3].n_chars == len(got[3].text)
    assert (got[100].text, got[100].n_chars, got[101].text, got[None].text) == ("", 0, "", "")
    assert pages.extract(table.limit(0), pages.fit(table.limit(0))).count() == 0


# Licences

def test_licences_are_found_and_confirmed(clashing):
    rng = random.Random(10)
    words = "the river was quiet and a green table stood near seven houses of stone".split()
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    said = {"mit": "Released under the MIT License.", "gpl": "This work is licensed under the GNU General Public License, version 3.",
            "apache-2.0": "Licensed under the Apache License, Version 2.0.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    rows = [(i, f"{line(30)}\n{text} {line(9)}\n{line(100)}") for i, text in enumerate(said.values())]
    rows += [(10, f"{line(200)} {said['mit']} {line(200)}"), (11, line(50)), (12, "He lost his driving licence."), (13, None), (14, ""),
             (15, "licence\n" * 50), (16, "\n".join(said.values()))]
    table = clashing(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(table, licences.fit(table)).collect()}
    assert [got[i].licences for i in range(4)] == list(said) and got[10].licences == "mit" and got[16].n_spans == 4
    assert all(got[i].n_spans == 0 for i in (11, 12, 13, 14, 15))
    family, start, end = got[10].spans.split(":")
    assert rows[4][1][int(start):int(end)] == "Released under the MIT License" and got[10].confidence > 0.5


def families(text, model):
    found = licences.spans_of(text, model)
    assert all(0 <= a < b <= len(text) for a, b, _, _ in found) and found == sorted(found)
    return [f for _, _, f, _ in found]


@pytest.fixture(scope="module")
def notices():
    return licences.train(["the river ran past the old house", "seven green tables stood in the quiet room"])


def test_licences_wrapped_and_commented(notices):
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for width, mark in ((72, ""), (60, "# "), (60, " * "), (40, "// "), (60, "\r")):
                lines = "\n".join(mark + line for line in textwrap.wrap(text, width))
                assert families(f"int x;\n\n{lines}\n\nint y;", notices) == [family], (family, lines)


def test_licences_named_together(notices):
    dual = "Dual licensed under the MIT License and the Apache License, Version 2.0"
    assert sorted(families(dual, notices)) == ["apache-2.0", "mit"]
    assert families("This text is available under CC BY-SA 4.0", notices) == ["cc-by-sa"]
    assert families("Released under the MIT License. " * 3, notices) and set(families("Released under the MIT License. " * 3, notices)) == {"mit"}
    assert families("Released under the MIT License" + " word" * 200 + " Released under the ISC License", notices) == ["mit", "isc"]


def test_licences_are_not_found_across_paragraphs(notices):
    assert families("Released under\n\nthe\n\nMIT\n\nLicense", notices) == [] == families("under the\n#\n# MIT\n#\n# License", notices)
    assert families("MIT released a study. The Apache licence of the pilot expired, and so did the general public's patience.", notices) == []


def test_licences_in_very_long_paragraphs(notices):
    filler = "some words of a long paragraph that never ends " * 20_000
    assert families(filler + "Released under the MIT License " + filler, notices) == ["mit"]
    assert set(families("Released under the MIT License\n" * 2_000, notices)) == {"mit"}


def test_licences_of_odd_rows(odd_docs, no_docs):
    model = licences.fit(odd_docs)
    assert {r.n_spans for r in licences.scan(odd_docs, model).collect()} == {0}
    assert licences.scan(no_docs, licences.fit(no_docs)).count() == 0


def test_deeply_nested_pages_take_linear_time():
    deep = '<div class="a b">t' * 50_000
    blocks = pages.blocks_of(deep + "</span></em>" * 1_000 + "</section>" * 50_000)
    assert len(blocks) == 50_000 and blocks[-1].ancestors == {"div"}
    assert len(pages.features(blocks)) == 50_000
