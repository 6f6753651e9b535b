"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines with words in them: a blank line, or one of comment marks alone, ends it, so notices may be wrapped or
commented.  Paragraphs are read in windows of ``WINDOW`` words.  A window's word n-grams (one to three words) go through a multinomial
logistic regression over the licence families and ``unknown``; its probabilities are calibrated by a temperature fitted on held-out
windows.  A family that is likelier than ``unknown`` is confirmed if, close together, enough word pairs of one of its templates stand in the
window, and at least half of those that no other family has.  The words that name it are then taken out and the rest is classified again, so a window may
name several families; what is not confirmed is unknown.  Windows without a pair that sets a family apart cannot be confirmed and are not classified.

Trained on varied copies of the templates, on the negative sentences below, and on at most ``SAMPLE`` paragraphs of the corpus without an
anchor word (of each, ``WINDOW`` words and 400 characters from a place chosen by hash).

Defined results: a null or empty text has no licences; of overlapping spans of a family one is made; paragraphs of any length are read
whole; of families equally likely the first by name counts; repeated rows and null ids are scanned row by row; extra columns are ignored; without
corpus paragraphs the negatives below are all that ``unknown`` is learned from.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Corpus paragraphs to learn ``unknown`` from, varied copies of each template, words of a window and its step.
SAMPLE, COPIES, WINDOW, STRIDE = 400, 40, 48, 16

# Usual notices of the licence families.
TEMPLATES = {
    "agpl": ["licensed under the GNU Affero General Public License version 3",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
             "by the Free Software Foundation"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache org licenses LICENSE-2.0",
                   "released under the terms of the Apache License 2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Released under the BSD License", "licensed under the BSD 3-Clause License", "distributed under the terms of the BSD 2-Clause License"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["Released under CC0 1.0", "dedicated to the public domain under the Creative Commons CC0 1.0 Universal dedication"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "licensed under the GNU GPL version 2 or later",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation"],
    "isc": ["Released under the ISC License",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": ["licensed under the GNU Lesser General Public License version 2.1",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
             "by the Free Software Foundation"],
    "mit": ["Released under the MIT License", "licensed under the terms of the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in "
            "the Software without restriction"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain", "released under the Unlicense"],
}
NEGATIVE = ["He lost his driving licence for a year after the accident.", "The shop needs a licence to sell beer and wine.",
            "All rights reserved by the owner of the house.", "She gave them permission to leave early on Friday.", "The software was released last week.",
            "A poetic license is granted to every writer.", "The free newspaper is distributed in the general public areas of the station.",
            "Public transport is free of charge for students.", "He is a licensed plumber under contract.", "The version released in May was the third.",
            "The foundation published a copy of the work.", "Her fishing license expired.", "Apache helicopters were seen over the city.",
            "MIT released a study about the weather.", "The public domain of the village is small.", "Use of the hall is permitted with a license."]
#: Corpus paragraphs with one of these teach nothing: they may be notices.
ANCHOR = re.compile(r"licen[sc]e|permission|redistribut|public domain|public license|cc0|copyright", re.I)
_WORD = re.compile(r"[^\W_]+")
UNKNOWN = "unknown"
#: Stands where a confirmed family was named.
TAKEN = "\0"


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


_TEMPLATE_PAIRS = {family: [_pairs(_words(t)) for t in texts] for family, texts in TEMPLATES.items()}
#: Of each family, the pairs that no other family's templates hold.
_NAMING = {family: set().union(*own) - set().union(*(p for other, ps in _TEMPLATE_PAIRS.items() if other != family for p in ps))
           for family, own in _TEMPLATE_PAIRS.items()}
_ALL_NAMING = set().union(*_NAMING.values())


@dataclass
class Model:
    classes: list[str]
    names: dict[str, int]
    weights: np.ndarray  # [n-gram, class]; the last row is the bias
    temperature: float

    def probabilities(self, windows: list[list[str]]) -> np.ndarray:
        logits = np.array([self.weights[[self.names[g] for g in grams(w) if g in self.names] + [-1]].sum(0) for w in windows])
        logits = (logits - logits.max(1, keepdims=True)) / self.temperature
        p = np.exp(logits)
        return p / p.sum(1, keepdims=True)


def train(negatives: list[str], seed: int = 7, rounds: int = 150, decay: float = 1e-3) -> Model:
    """Softmax regression by Adam, then a temperature that minimises the loss on every third example."""
    rng = random.Random(seed)
    classes = [UNKNOWN, *TEMPLATES]
    filler = [w for line in negatives + NEGATIVE for w in _words(line)]
    around = lambda n: [rng.choice(filler) for _ in range(rng.randint(0, n))]
    examples: list[tuple[list[str], int]] = []
    for label, family in enumerate(classes[1:], 1):
        for text in TEMPLATES[family]:
            words = _words(text)
            for _ in range(COPIES):
                kept = [w for w in words if rng.random() > 0.05] or words
                examples.append((around(20) + kept + around(20), label))
    everything = [w for texts in TEMPLATES.values() for t in texts for w in _words(t)]
    for line in NEGATIVE:
        examples += [(around(15) + _words(line) + around(15), 0) for _ in range(COPIES // 2)]
    for line in negatives:
        examples.append((_words(line)[:WINDOW], 0))
    for _ in range(8 * COPIES):  # words of licences without their order, among others
        examples.append((rng.sample(everything, rng.randint(1, 6)) + around(30), 0))
    rng.shuffle(examples)
    learn, held = [e for i, e in enumerate(examples) if i % 3], examples[::3]
    seen: dict[str, int] = {}
    for words, label in learn:
        for g in grams(words):
            seen[g] = seen.get(g, 0) + 1
    names = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n >= 8))}
    model = Model(classes, names, np.zeros((len(names) + 1, len(classes))), 1.0)
    rows, ids = [], []
    for i, (words, _) in enumerate(learn):
        own = [names[g] for g in grams(words) if g in names] + [len(names)]
        rows += [i] * len(own)
        ids += own
    rows, ids = np.array(rows), np.array(ids)
    gold = np.eye(len(classes))[[label for _, label in learn]]
    first, second = np.zeros_like(model.weights), np.zeros_like(model.weights)
    for r in range(1, rounds + 1):
        logits = np.stack([np.bincount(rows, model.weights[ids, c], len(learn)) for c in range(len(classes))], 1)
        p = np.exp(logits - logits.max(1, keepdims=True))
        off = p / p.sum(1, keepdims=True) - gold
        slope = np.stack([np.bincount(ids, off[rows, c], len(names) + 1) for c in range(len(classes))], 1) / len(learn) + decay * model.weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        model.weights -= 0.1 * (first / (1 - 0.9 ** r)) / (np.sqrt(second / (1 - 0.99 ** r)) + 1e-8)
    truth = np.array([label for _, label in held])

    def loss(t: float) -> float:
        model.temperature = t
        return -float(np.log(model.probabilities([w for w, _ in held])[np.arange(len(held)), truth] + 1e-12).mean())

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    return model


def fit(docs: DataFrame, size: int = SAMPLE, seed: int = 7) -> Model:
    """Learn ``unknown`` from at most ``size`` paragraphs of the corpus, drawn by hash."""
    n = docs.count()
    drawn = docs.filter(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, 2.0 * size / max(n, 1))) + 1)
    words = F.split("paragraph", r"\s+")
    start = F.pmod(F.xxhash64("paragraph"), F.greatest(F.size(words) - WINDOW + 1, F.lit(1)).cast("bigint")).cast("int") + 1
    sampled = (drawn.select(F.xxhash64("text").alias("h"), F.explode(F.split("text", r"\n\s*\n")).alias("paragraph"))
               .filter(~F.col("paragraph").rlike(f"(?i){ANCHOR.pattern}") & (F.length("paragraph") > 0))
               .select("h", F.substring(F.array_join(F.slice(words, start, WINDOW), " "), 1, 400).alias("part"))
               .distinct().orderBy(F.xxhash64("h", "part"), "part").limit(size).collect())
    return train([r["part"] for r in sampled], seed)


def _confirmed(words: list[str], free: list[bool], family: str, alike: float) -> list[int]:
    """Places of the word pairs of the family's best-matched template, close together around a naming pair not yet taken; none if too few."""
    best, places = 0.0, []
    for pairs in _TEMPLATE_PAIRS[family]:
        hits = [k for k in range(len(words) - 1) if (words[k], words[k + 1]) in pairs]
        naming = pairs & _NAMING[family]
        for first in hits:
            if (words[first], words[first + 1]) in naming and free[first] and free[first + 1]:
                near = [k for k in hits if abs(k - first) <= len(pairs)]
                met = {(words[k], words[k + 1]) for k in near}
                share = len(met) / len(pairs)
                if share >= alike and share > best and 2 * len(met & naming) >= len(naming):
                    best, places = share, near
    return places


def _families(words: list[str], model: Model, least: float, alike: float) -> Iterator[tuple[str, list[int], float]]:
    """(family, places of its word pairs, probability) of each confirmed family of a window."""
    free, places = [True] * len(words), [0]
    while places:
        own = model.probabilities([[w if f else TAKEN for w, f in zip(words, free)]])[0]
        against = own / (own + own[0])  # each family against unknown alone: several may share a window
        places = []
        for label in np.argsort(-own[1:], kind="stable") + 1:
            family = model.classes[label]
            if against[label] >= least and (places := _confirmed(words, free, family, alike)):
                yield family, places, float(against[label])
                for k in places:
                    if (words[k], words[k + 1]) in _NAMING[family]:
                        free[k] = free[k + 1] = False
                break


def _paragraphs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of the words of each paragraph."""
    own: list[tuple[int, int]] = []
    for m in _WORD.finditer(text):
        if own and text.count("\n", own[-1][1], m.start()) > 1:
            yield own
            own = []
        own.append(m.span())
    if own:
        yield own


def spans_of(text: str, model: Model, least: float = 0.5, alike: float = 0.6) -> list[tuple[int, int, str, float]]:
    """(start, end, family, probability against unknown) of the confirmed notices of a text, those of a family merged where they overlap."""
    if _ALL_NAMING.isdisjoint(_pairs(_words(text))):
        return []
    found: dict[str, list[list]] = {}
    for at in _paragraphs(text):
        words = [text[a:b].lower() for a, b in at]
        named = [k for k, pair in enumerate(zip(words, words[1:])) if pair in _ALL_NAMING]
        starts = sorted({i for k in named for i in range(max(0, k + 2 - WINDOW + STRIDE - 1) // STRIDE * STRIDE, k + 1, STRIDE)})
        for i in starts:
            for family, places, p in _families(words[i:i + WINDOW], model, least, alike):
                a, b = at[i + places[0]][0], at[i + places[-1] + 1][1]
                own = found.setdefault(family, [])
                for old in [x for x in own if a < x[1] and x[0] < b]:
                    own.remove(old)
                    a, b, p = min(a, old[0]), max(b, old[1]), max(p, old[2])
                own.append([a, b, p])
    return sorted((a, b, family, p) for family, own in found.items() for a, b, p in own)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_spans, licences (sorted families, comma-joined), spans (family:start:end by start, comma-joined), confidence."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [spans_of(t, model) if t else [] for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].array, "n_spans": [len(f) for f in found],
                "licences": [",".join(sorted({x[2] for x in f})) for f in found],
                "spans": [",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in f) for f in found],
                "confidence": [min((x[3] for x in f), default=1.0) for f in found]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_spans bigint, licences string, spans string, confidence double")
