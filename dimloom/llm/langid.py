"""Language identification by mixture inference.

A model holds, per language, smoothed likelihoods of hashed letter trigrams, counted over all training documents.  A document is a mixture:
expectation-maximisation estimates its languages' proportions, and among the nested sets of its most probable languages the one with
the best penalised likelihood is taken.

Defined results: ``und`` with score 0 and no languages for a null text, a text without a letter, or a model without languages; training
rows with a null language or text are left out; ties between languages go to the first in alphabetical order; repeated rows and
null ids are judged row by row; extra columns are ignored.  Texts of any length are read whole.  The model has (languages x buckets) numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
#: A further language must raise the log-likelihood by this many times log(number of trigrams): neighbouring trigrams overlap.
PENALTY = 3.0
_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])
_FIELDS = "lang_pred string, score double, languages array<string>, proportions array<double>"


def trigrams(text: str) -> np.ndarray | None:
    """Bucket of every trigram around a letter, with runs of other characters as one space; None without a letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _LETTER[np.minimum(points, 0xFFFF)]
    if (beyond := points > 0xFFFF).any():
        letter[beyond] = [chr(c).isalpha() for c in points[beyond]]
    if not letter.any():
        return None
    points = np.where(letter, points, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    p = points[keep]
    mixed = (p[:-2] * np.uint32(0x85EBCA6B) ^ p[1:-1] * np.uint32(0xC2B2AE35) ^ p[2:] * np.uint32(0x27D4EB2F)) * np.uint32(0x9E3779B1)
    return (mixed[p[1:-1] != 32] >> np.uint32(17)).astype(np.int64)


def fit(train: DataFrame, smoothing: float = 0.2) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihoods [language, bucket]) from all rows of ``train`` (text, lang)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if (got := trigrams(text)) is not None:
                    total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    total[lang] += np.bincount(got, minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    rows = (train.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
            .mapInPandas(count, "lang string, bucket bigint, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    counts[np.searchsorted(langs, rows["lang"]) if langs else [], rows["bucket"].to_numpy(np.int64)] = rows["n"]
    return langs, np.log((counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * BUCKETS))


def mixture(p: np.ndarray, n: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of trigrams with likelihoods ``p`` [trigram, language] and counts ``n``, by expectation-maximisation."""
    share, total = np.full(p.shape[1], 1.0 / p.shape[1]), n.sum()
    for _ in range(rounds):
        share = share * ((n / (p @ share)) @ p) / total
    return share, float(n @ np.log(p @ share))


def infer(got: np.ndarray | None, langs: list[str], table: np.ndarray) -> tuple[str, float, list[str], list[float]]:
    """Language, its proportion among all, the chosen languages and their proportions."""
    if got is None or not len(got) or not langs:
        return "und", 0.0, [], []
    n = np.bincount(got, minlength=BUCKETS)
    at = np.flatnonzero(n)
    n, logs = n[at].astype(float), table[at]
    single = n @ logs
    best = int(np.argmax(single))
    if len(langs) == 1:
        return langs[0], 1.0, [langs[0]], [1.0]
    p = np.exp(logs - logs.max(1, keepdims=True))
    shift = float(n @ logs.max(1))
    share, _ = mixture(p, n)
    order = [best, *[k for k in np.argsort(-share, kind="stable") if k != best]]
    cost = PENALTY * np.log(n.sum() + 1.0)
    chosen, own, value = [best], np.ones(1), single[best]
    for size in range(2, len(order) + 1):
        if share[order[size - 1]] < 0.02:
            break
        part, likelihood = mixture(p[:, order[:size]], n)
        if likelihood + shift - cost * (size - 1) <= value:
            break
        chosen, own, value = order[:size], part, likelihood + shift - cost * (size - 1)
    first = np.lexsort((chosen, -own))
    top = chosen[first[0]]
    return langs[top], float(min(1.0, share[top])), [langs[chosen[i]] for i in first], [float(own[i]) for i in first]


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score, languages, proportions of every row."""
    langs, table = model
    by_bucket = np.ascontiguousarray(table.T)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [infer(None if t is None else trigrams(t), langs, by_bucket) for t in batch["text"]]
            out = pd.DataFrame(found, columns=["lang_pred", "score", "languages", "proportions"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, {_FIELDS}")
