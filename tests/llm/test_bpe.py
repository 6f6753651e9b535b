import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dimloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    alphabet = list("abcdeé 語😀ß'., \n\t\r") + ["́", " ", "\x1c", "'s", "'ll", "<|endoftext|>", "12", "  "]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 1500))) for _ in range(80)]
    shared = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(800))
    return made + [shared, "before " + shared, shared[7:] + " after", "", " ", "\n", "x" * 30_000, "<|startoftext|>a <|endoftext|>", "İ ǅ ﬁ"]


def test_coder_agrees_with_the_library_on_ids_and_text(plain):
    coder = bpe.Coder(PATH)
    for text in texts():
        ids = coder.encode(text.replace("\n", " "))
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert coder.decode(ids) == plain.decode(want, skip_special_tokens=False)


def test_small_caches_change_nothing(plain, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 5)
    monkeypatch.setattr(bpe, "CHUNKS", 2)
    coder = bpe.Coder(PATH)
    for text in texts():
        assert np.frombuffer(coder.encode(text.replace("\n", " ")), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_shared_passages_fall_into_equal_chunks():
    passage = " ".join(f"word{i * i % 997}" for i in range(2_000))

    def chunk(text):
        at = [0, *bpe.cuts(text)]
        return {text[a:b] for a, b in zip(at, at[1:])}

    one, other = chunk("some start " + passage), chunk("quite another beginning, and longer " + passage)
    assert len(one & other) >= len(one) - 2 > 5


def test_digests(odd_docs, no_docs, plain):
    got = bpe.digests(odd_docs, PATH).collect()
    assert len(got) == 11 and bpe.digests(no_docs, PATH).count() == 0
    texts_by_id = {(r.doc_id, r.text) for r in odd_docs.collect()}
    want = set()
    for doc_id, text in texts_by_id:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want.add((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert {tuple(r) for r in got} == want


def test_tokenizer_that_joins_words_is_refused():
    with pytest.raises(ValueError):
        bpe.Coder(public_tokenizers.path("byte_bpe_50k.json"))


class InProcess:
    """Runs a Python map over pandas batches here instead of in a worker."""

    def __init__(self, docs, batches):
        self.schema, self.batches = docs.schema, batches

    def select(self, *columns):
        return self

    def mapInPandas(self, run, schema):
        return list(run(iter(self.batches)))


def test_a_task_that_is_told_to_forget_leaves_no_caches(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    batches = [docs.toPandas()] * 2
    kept = bpe.encode(InProcess(docs, batches), PATH)
    assert len(bpe.coder(PATH).pieces) > 500 and bpe.coder(PATH).chunks
    gone = bpe.encode(InProcess(docs, batches), PATH, forget=True)
    assert len(bpe.coder(PATH).pieces) + len(bpe.coder(PATH).pieces.older) + len(bpe.coder(PATH).chunks) == 1  # the empty piece
    assert all(a.equals(b) for a, b in zip(kept, gone, strict=True))
