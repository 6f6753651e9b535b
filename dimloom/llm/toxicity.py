"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of lexicon words, lexicon stems and disguised lexicon words, their weights, hits near a second-person
pronoun, and rates of capitals, shouted words, punctuation, repeated letters and obfuscated words.  The lexicon (words and stems with
a high log-odds of the label) is learned from the same labelled rows as the trees; texts that occur more than once count once.

Trees, lexicon and calibration are fitted on a sample of about ``rows`` labelled rows (all of them, if there are fewer), thinned by a
hash of the id.  Every document is scored whole.

Defined results: a null text is an empty one and gets a score as any other; without labelled rows of both kinds every score is the
share of toxic rows (0 without rows); null labels are left out, an id or a text labelled more than once is toxic if any label says so; repeated
rows and null ids are scored row by row; extra columns are returned by ``add_scores`` as they were, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import cut

#: Labelled rows to fit on, lexicon entries, words whose flags a worker keeps (some 30 MB), and characters of such a word: longer ones,
#: as whole texts without spaces, are looked at in full each time they are met.
TRAIN_ROWS, LEXICON, MEMO, MEMO_LENGTH = 20_000, 2_000, 200_000, 48
STEMS = (4, 5, 6, 7)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes "
    "vosotros vuestro vuestra".split())
NEAR = 5

_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_INSIDE = re.compile(r"[^\W\d_][^\w'’-]+[^\W\d_]|[^\W\d_]\d|\d[^\W\d_]")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_PLAIN = [str.maketrans("013457@$!|", f"o{one}eastas{one}{one}") for one in "il"]
_AROUND = ".,;:?()\"'"  # marks that stand for no letter
_NOT_LETTER = re.compile(r"[\W\d_]+")
_RUN, _TWICE = re.compile(r"(.)\1+"), re.compile(r"(.)\1")
_UPPER, _DIGIT, _MARK = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Flags of a word; the weight of its lexicon entry, in quarters, stands above them.
_LEX, _STEM, _DISGUISED, _YOU, _SHOUT, _OBSCURED, _BANG, _REPEAT = (1 << i for i in range(8))
_WEIGHT = 8
FEATURES = ("lexicon", "stems", "disguised", "weight", "greatest", "hits", "near_you", "you", "shouted", "obscured", "banged", "repeated",
            "capitals", "digits", "marks", "length")


def plain(word: str) -> str:
    return _EDGES.sub("", word.lower())


def terms_of(text: str) -> set[str]:
    """Lower-case words and their stems (with a star)."""
    out: set[str] = set()
    for word in {plain(w) for w in text.split()}:
        if len(word) >= 3:
            out.add(word)
            out.update(word[:n] + "*" for n in STEMS if n < len(word))
    return out


class Flags(dict):
    """Flags by word as it stands, computed when first met."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def entry(self, word: str) -> tuple[int, float]:
        """Kind of match and weight."""
        if word in self.lexicon:
            return _LEX, self.lexicon[word]
        found = [self.lexicon[s] for n in STEMS if n < len(word) and (s := word[:n] + "*") in self.lexicon]
        return (_STEM, max(found)) if found else (0, 0.0)

    def disguised(self, low: str, bare: str, letters: bool) -> float:
        """Greatest weight of a lexicon entry that the word spells with digits, marks or repeated letters in it; 0 if none."""
        weight = 0.0
        clears = {bare} if letters else {_NOT_LETTER.sub("", low.translate(table)) for table in _PLAIN}
        for clear in clears:
            for form in {clear, _RUN.sub(r"\1", clear) if _TWICE.search(clear) else clear} - {bare}:
                if len(form) >= 3 and (hit := self.entry(form))[0] == _LEX:
                    weight = max(weight, hit[1])
        return weight

    def __missing__(self, word: str) -> int:
        low = word.lower()
        core = low.strip(_AROUND)
        letters = core.isalpha() and word.strip(_AROUND).isalpha()  # nothing between letters or in place of one
        bare = core if letters else _EDGES.sub("", low)
        flag, weight = self.entry(bare)
        if not flag and (disguised := self.disguised(low, bare, letters)):
            flag, weight = _DISGUISED, disguised
        if bare in SECOND_PERSON:
            flag |= _YOU
        if len(bare) >= 3 and low != word and word.upper() == word:
            flag |= _SHOUT
        if not letters:
            if _INSIDE.search(word):
                flag |= _OBSCURED
            if "!" in word:
                flag |= _BANG
        if _THRICE.search(word):
            flag |= _REPEAT
        flag |= min(255, int(4 * weight)) << _WEIGHT
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.clear()
            self[word] = flag
        return flag


def features_of(text: str, flags: Flags) -> list[float]:
    words = text.split()
    n = len(words)
    got = np.fromiter(map(flags.__getitem__, words), np.int64, n)
    rate = lambda bit: float(np.count_nonzero(got & bit)) / max(n, 1)
    hit = np.flatnonzero(got & (_LEX | _STEM | _DISGUISED))
    you = np.flatnonzero(got & _YOU)
    near = 0
    if len(hit) and len(you):
        at = np.searchsorted(you, hit)
        gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hit), np.abs(you[np.maximum(at - 1, 0)] - hit))
        near = int(np.count_nonzero(gap <= NEAR))
    weight = (got[hit] >> _WEIGHT) / 4.0
    raw = text.encode("utf-8", "surrogatepass")
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / max(len(raw), 1)
    return [rate(_LEX), rate(_STEM), rate(_DISGUISED), float(weight.sum()) / max(n, 1), float(weight.max(initial=0.0)), float(np.log1p(len(hit))),
            near / max(n, 1), rate(_YOU), rate(_SHOUT), rate(_OBSCURED), rate(_BANG), rate(_REPEAT),
            share(_UPPER), share(_DIGIT), share(_MARK), float(np.log1p(n))]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    trees: Any  # None: every score is ``prior``
    calibration: Any
    prior: float


def _features(text: Column, lexicon: dict[str, float]) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        flags = Flags(lexicon)  # goes with the task: a worker that later stages use again keeps nothing
        for texts in batches:
            yield pd.Series([features_of(t or "", flags) for t in texts], dtype=object)

    return run(text)


def _lexicon(rows: DataFrame, size: int) -> dict[str, float]:
    """Words and stems with their smoothed log-odds, from (text, toxic) rows, where the log-odds are no chance."""
    def count(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                for term in terms_of(text or ""):
                    seen.setdefault(term, [0, 0])[int(toxic)] += 1
            yield pd.DataFrame({"term": list(seen), "clean": [v[0] for v in seen.values()], "toxic": [v[1] for v in seen.values()]})

    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = F.log((F.col("toxic") + 0.5) / (total[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (total[0] + 1.0))
    seen = cut(rows.select("text", "toxic").mapInPandas(count, "term string, clean bigint, toxic bigint")
               .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= 3), few=True)
    share = total[1] / (total[0] + total[1])
    n = F.col("toxic") + F.col("clean")
    # Log-likelihood of the term's own share of toxic texts against the common one.  Of as many terms as there are, chance alone brings
    # about ten above the logarithm of a tenth of their number; the trees weigh those against the rest.
    gain = F.col("toxic") * F.log(F.col("toxic") / n / share) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - share))).otherwise(0.0)
    best = (seen.withColumn("odds", odds).withColumn("gain", gain)
            .filter((F.col("odds") >= 1.5) & (F.col("gain") >= float(np.log(max(20, seen.count()) / 10))))
            .orderBy(F.desc("gain"), "term").limit(size))
    return {r["term"]: float(r["odds"]) for r in best.collect()}


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, trees: int = 25, depth: int = 4, seed: int = 7) -> Model:
    """Fit on the documents that ``labels`` (doc_id, toxic) covers; hand over only the labels to learn from."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = known.count()
    drawn = known.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(n, 1))) + 1)
    # At most about ``rows`` ids, so they are broadcast and no text of another document moves.
    sample = cut(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
                 .withColumn("hash", F.xxhash64("text")))
    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = kinds.get(1, 0) / max(1, sum(kinds.values()))
    if min(kinds.get(0, 0), kinds.get(1, 0)) < 4:
        return Model({}, None, None, prior)
    third = F.pmod("hash", F.lit(3)) == 0
    words = _lexicon(sample.filter(~third), LEXICON)
    ready = sample.select(F.col("toxic").cast("double").alias("label"), third.alias("third"),
                          array_to_vector(_features(F.col("text"), words)).alias("features")).coalesce(6).persist()
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=32, minInstancesPerNode=2, seed=seed,
                            cacheNodeIds=False).fit(ready.filter(~F.col("third")))
    margins = boosted.transform(ready.filter("third")).select("label", _margin())
    calibrated = IsotonicRegression(featuresCol="margin").fit(margins) if margins.groupBy("label").count().count() == 2 else None
    ready.unpersist()
    return Model(words, boosted, calibrated, prior)


def _margin() -> Column:
    return vector_to_array("rawPrediction")[1].alias("margin")


def add_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc, score): each row as a struct, and its calibrated score.

    The calibrated steps keep the order of the trees' own probability inside them: it makes up a thousandth of the score.
    """
    rows = docs.select(F.struct("*").alias("doc"))
    if model.trees is None:
        return rows.select("doc", F.lit(float(model.prior)).alias("score"))
    scored = model.trees.transform(rows.withColumn("features", array_to_vector(_features(F.col("doc.text"), model.lexicon))))
    own = vector_to_array("probability")[1].alias("own")
    if model.calibration is None:
        return scored.select("doc", own.alias("score"))
    return (model.calibration.transform(scored.select("doc", own, _margin()))
            .select("doc", F.least(F.greatest(0.999 * F.col("prediction") + 0.001 * F.col("own"), F.lit(0.0)), F.lit(1.0)).alias("score")))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every row."""
    return add_scores(docs.select("doc_id", "text"), model).select(
        "doc.doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, at: float = 0.5) -> DataFrame:
    """The rows that score below ``at``, with all their columns."""
    return add_scores(docs, model).filter(F.col("score") < at).select("doc.*")
