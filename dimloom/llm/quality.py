"""Quality scores: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: its distinct lower-case words in ``WORDS`` hashed slots (of length ``WORD_WEIGHT`` together), each structure
statistic as one of ``BINS`` slots, and the size class of each metadata column.  Spark's own factorisation machine learns a weight and ``FACTORS``
factors per slot; a score is read in time linear in the slots that are set, because

    sum over i < j of <v_i, v_j> x_i x_j = 1/2 * (|sum of v_i x_i|^2 - sum of |v_i|^2 x_i^2).

The machine is fitted on about ``rows`` labelled rows (all, if there are fewer), thinned by a hash of the id.  Every text is read and
scored whole.

Defined results: a null text is an empty one and gets a score as any other; without labelled rows of both kinds every score is the
share of good ones (0 without rows).  Null labels and ids teach nothing; an id or text labelled more than once counts once, as good if
at least half of its labels say so.  Repeated rows and null ids are scored row by row; null or absent metadata, and
those that are no numbers, have a class of their own; ``add_scores`` returns extra columns as they were, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import cut

#: Labelled rows to fit on, slots for words, factors, and words whose slot a worker keeps.
TRAIN_ROWS, WORDS, FACTORS, MEMO = 20_000, 4096, 8, 400_000
BINS = 8
#: Size classes of a metadata column.
CLASSES = 32
#: Length of the words' part of a vector; every other slot that is set counts 1.  A text has many words and few statistics.
WORD_WEIGHT = 0.3
#: Columns that are inputs besides the text, where the table has them.  Never labels, lang, source or doc_id.
METADATA = ("n_chars",)

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_UPPER, _DIGITS, _STOPS = _LETTERS[:26], b"0123456789", b".,;:!?"
_MARKS = bytes(c for c in range(33, 127) if c not in _LETTERS + _DIGITS + _STOPS)
STATISTICS = ("words", "word_length", "distinct", "top_word", "capitals", "digits", "stops", "marks", "marked_words", "bytes_above", "lines",
              "repeated_lines", "line_length", "shouted", "ended")


class Slots(dict):
    """Slot of a word, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        slot = self[word] = xxhash.xxh32_intdigest(word) % WORDS
        return slot


_SLOTS = Slots()


def statistics_of(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Structure statistics of a text, each between 0 and 1."""
    n, size = max(len(words), 1), max(len(raw), 1)
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    lines = [x for x in raw.split(b"\n") if x.strip()]
    log = lambda v, top: min(1.0, np.log2(1.0 + v) / top)
    marked = sum(k for w, k in counts.items() if w.translate(None, _MARKS) != w)
    shouted = sum(k for w, k in counts.items() if len(w) > 1 and w.isupper())
    ends = sum(k for w, k in counts.items() if w[-1] in b".!?")
    return [log(len(words), 20), log(len(raw) / n, 8), len(counts) / n, max(counts.values(), default=0) / n, share(_UPPER), share(_DIGITS), share(_STOPS),
            share(_MARKS), marked / n, (len(raw) - len(raw.translate(None, bytes(range(128, 256))))) / size, log(len(lines), 16),
            1.0 - len(set(lines)) / max(len(lines), 1), log(len(raw) / max(len(lines), 1), 16), shouted / n, ends / n]


def slots_of(text: str | None, metadata: tuple[float | None, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Set slots, ascending, and their values."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    counts = Counter(words)
    slots = np.unique(np.fromiter((_SLOTS[w.lower()] for w in counts), np.int32, len(counts)))
    stats = np.array(statistics_of(raw, words, counts))
    # Roots give shares near zero bins of their own.
    bins = np.minimum((np.sqrt(stats) * BINS).astype(np.int32), BINS - 1) + WORDS + BINS * np.arange(len(stats), dtype=np.int32)
    first = WORDS + BINS * len(STATISTICS)
    classes = [first + CLASSES * k + (0 if m is None or m != m or m < 0 else 1 + min(int(np.log2(1.0 + m)), CLASSES - 2)) for k, m in enumerate(metadata)]
    return (np.concatenate([slots, bins, np.array(classes, np.int32)]),
            np.concatenate([np.full(len(slots), WORD_WEIGHT / np.sqrt(max(len(slots), 1))), np.ones(len(bins) + len(classes))]))


def width(metadata: tuple[str, ...]) -> int:
    return WORDS + BINS * len(STATISTICS) + CLASSES * len(metadata)


@dataclass(frozen=True)
class Model:
    metadata: tuple[str, ...]
    prior: float
    intercept: float = 0.0
    linear: np.ndarray | None = None  # None: every score is ``prior``
    factors: np.ndarray | None = None  # slots by factors

    def margin(self, slots: np.ndarray, values: np.ndarray) -> float:
        """The machine's value, by the sum-of-squares identity."""
        v = self.factors[slots] * values[:, None]
        return self.intercept + float(self.linear[slots] @ values) + 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())


def _present(docs: DataFrame, metadata: tuple[str, ...]) -> list[Column]:
    return [(F.col(m).try_cast("double") if m in docs.columns else F.lit(None).cast("double")).alias(f"m{k}") for k, m in enumerate(metadata)]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, metadata: tuple[str, ...] = METADATA, rounds: int = 100, seed: int = 7) -> Model:
    """Fit on the documents that ``labels`` (doc_id, quality) covers; hand over only the labels to learn from."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("quality"))
    n = known.count()
    drawn = known.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(n, 1))) + 1)
    # At most about ``rows`` ids, so they are broadcast and no text of another document moves.
    found = docs.select("doc_id", "text", *_present(docs, metadata)).join(F.broadcast(drawn), "doc_id")
    size = width(metadata)
    vector = F.udf(lambda text, *m: SparseVector(size, *(a.tolist() for a in slots_of(text, m))), VectorUDT())
    names = [f"m{k}" for k in range(len(metadata))]
    once = found.groupBy(F.xxhash64("text").alias("hash")).agg(F.avg("quality").alias("quality"), F.first("text").alias("text"), *[F.max(m).alias(m) for m in names])
    ready = cut(once.select((F.col("quality") >= 0.5).cast("double").alias("label"), vector("text", *names).alias("features")), few=True)
    kinds = {r["label"]: r["n"] for r in ready.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = kinds.get(1.0, 0) / max(1, sum(kinds.values()))
    if len(kinds) < 2:
        return Model(metadata, prior)
    held = ready.coalesce(6).persist()  # at most about ``rows`` sparse vectors, read once per round
    machine = FMClassifier(factorSize=FACTORS, maxIter=rounds, stepSize=0.05, regParam=1e-3, initStd=0.05, tol=1e-5, solver="adamW", seed=seed).fit(held)
    held.unpersist()
    return Model(metadata, prior, machine.intercept, machine.linear.toArray(), machine.factors.toArray())


def add_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc, score): each row as a struct, and its probability of good quality."""
    rows = docs.select(F.struct("*").alias("doc"))
    if model.linear is None:
        return rows.select("doc", F.lit(float(model.prior)).alias("score"))

    @F.pandas_udf("double")
    def run(texts: pd.Series, meta: pd.DataFrame) -> pd.Series:
        margins = [model.margin(*slots_of(t, m)) for t, m in zip(texts, meta.itertuples(index=False, name=None))]
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(margins, -500, 500))))

    meta = [(F.col("doc").getField(m).try_cast("double") if m in docs.columns else F.lit(None).cast("double")).alias(f"m{k}") for k, m in enumerate(model.metadata)]
    # A field of its own keeps the struct from being empty without metadata.
    return rows.select("doc", run(F.col("doc.text"), F.struct(*meta) if meta else F.struct(F.lit(None).cast("double").alias("none"))).alias("score"))


def scores(docs: DataFrame, model: Model, at: float = 0.7) -> DataFrame:
    """doc_id, score, predicted of every row."""
    needed = ["doc_id", "text", *[m for m in model.metadata if m in docs.columns and m not in ("doc_id", "text")]]
    return add_scores(docs.select(*needed), model).select("doc.doc_id", "score", (F.col("score") >= at).cast("int").alias("predicted"))
