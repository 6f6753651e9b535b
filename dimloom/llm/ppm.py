"""Language-model scores by prediction by partial matching over bytes.

A text is its words (A-Z lower-cased, split at ASCII white space), joined by single spaces and closed by a line feed.  The trie of byte contexts up to
``order`` is counted over all training texts.  A byte is coded in the longest known context; what a context has not seen is
escaped to the next shorter one (escape estimate D), where the symbols of the longer one are excluded.  The code length of all
bytes, closing one included, is the text's log10 probability.

Every training byte is counted and every count scores.  A trie of more than ``entries`` n-grams is split by ranges of the last ``SPLIT`` bytes of
the context: a byte's contexts of that length or more all end in them, so they lie in one shard, and shorter contexts stand in all.  Texts are read
once per shard; each time, the bytes whose contexts lie in it are scored, and the sums of a text are added.  Workers and driver hold one shard
at a time, of about ``entries`` n-grams, or one range that cannot be split.

Beside it stands a unigram baseline over words and one closing token per text, counted and smoothed over all training texts.  Frequent words
(at most ``HEAD``) are looked up in place, all others through a join.

Defined results: a null text is an empty one, which is the closing token alone; without training texts every byte costs log10 256 and
every word the same; repeated rows and null ids are scored row by row; extra columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import cut

ORDER = 5
#: Entries of a shard of the trie over all orders, words of the head, positions handled at once, and context bytes that name a shard.
ENTRIES, HEAD, STEP, SPLIT = 3_000_000, 250_000, 1 << 20, 3
#: Bytes of text scored at once.
PIECE = 1 << 18
#: Words that a counting task holds before it hands them on.
WORDS_HELD = 100_000
_U = np.uint64


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def grams(texts: list[bytes], order: int) -> np.ndarray:
    """The ``order`` + 1 bytes that end at every byte of every text, packed; texts begin after line feeds."""
    pad = b"\n" * order
    joined = np.frombuffer(pad + (b"\n" + pad).join(texts) + b"\n", np.uint8)
    n = len(joined) - order
    key = np.zeros(n, _U)
    for k in range(order + 1):
        key = (key << _U(8)) | joined[k:k + n]
    if order:  # positions that hold padding only
        keep = np.ones(n, bool)
        ends = np.cumsum([len(t) + 1 + order for t in texts])
        for k in range(order):
            keep[ends[:-1] - 1 - k] = False
        key = key[keep]
    return key


def count_grams(train: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """(key, n) of every n-gram, for orders 0 to ``order``; a shorter context sums the longer ones that end in it."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, sums, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(at, weights=np.concatenate(sums)).astype(np.int64)

        def take(texts: list[bytes]) -> None:
            nonlocal held
            key, n = np.unique(grams(texts, order), return_counts=True)
            keys.append(key)
            sums.append(n)
            held += len(key)
            if held > STEP:
                key, n = merged()
                keys[:], sums[:], held = [key], [n], 0  # merged ones stand outside the count, so merging stays rare

        def handed() -> Iterator[pd.DataFrame]:
            key, n = merged()
            keys[:], sums[:] = [], []
            for i in range(0, len(key), STEP):
                yield pd.DataFrame({"key": key[i:i + STEP].view(np.int64), "n": n[i:i + STEP]})

        for batch in batches:
            part, size = [], 0
            for text in batch["text"]:
                part.append(b" ".join(words_of(text)))
                size += len(part[-1]) + 1
                if size >= STEP:
                    take(part)
                    part, size = [], 0
                    if len(keys[0]) > 2 * STEP:  # what a task holds is bounded; Spark adds up the rest
                        yield from handed()
                        held = 0
            if part:
                take(part)
        if keys:
            yield from handed()

    tables = [cut(train.select("text").mapInPandas(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")))]
    for k in range(order, 0, -1):
        tables.append(tables[-1].groupBy(F.col("key").bitwiseAND((1 << 8 * k) - 1).alias("key")).agg(F.sum("n").alias("n")))
    return tables[::-1]


def _end(key: str = "key") -> Column:
    return F.shiftright(key, 8).bitwiseAND((1 << 8 * SPLIT) - 1)


def shards_of(tables: list[DataFrame], entries: int = ENTRIES) -> list[tuple[int, int]]:
    """Ranges [low, high) of the last ``SPLIT`` context bytes, each with about ``entries`` n-grams in all orders."""
    top = 1 << 8 * SPLIT
    if len(tables) <= SPLIT:
        return [(0, top)]
    shared = sum(t.count() for t in tables[:SPLIT])
    sizes = reduce(DataFrame.union, [t.select(_end().alias("end")) for t in tables[SPLIT:]]).groupBy("end").count().toArrow()  # 2 ** 24 rows at most
    end, n = sizes["end"].to_numpy().astype(np.int64), sizes["count"].to_numpy().astype(np.int64)
    at = np.argsort(end)
    end, sums, room = end[at], np.cumsum(n[at]), max(entries - shared, entries // 2, 1)
    lows, first = [0], 0
    while True:
        first = max(int(np.searchsorted(sums, (sums[first - 1] if first else 0) + room, "right")), first + 1)
        if first >= len(end):
            break
        lows.append(int(end[first]))
    return list(zip(lows, [*lows[1:], top]))


def collect_trie(tables: list[DataFrame], low: int = 0, high: int = 1 << 8 * SPLIT) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted (keys, counts) by order, of longer contexts those that end in [low, high)."""
    out = []
    for k, table in enumerate(tables):
        part = table.filter((_end() >= low) & (_end() < high)) if k >= SPLIT and high - low < 1 << 8 * SPLIT else table
        rows = part.toArrow()
        key = rows["key"].to_numpy().astype(np.int64).view(_U)
        at = np.argsort(key)
        out.append((key[at], rows["n"].to_numpy().astype(np.int64)[at]))
    return out


class Slots:
    """Positions of 64-bit keys, by open addressing; the table holds positions alone, four bytes a slot."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 2.2).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = keys
        self.at = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]  # the last one wins
            placed = self.at[slot] == left
            left, slot = left[~placed], (slot[~placed] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key, -1 for one that is not there."""
        slot = self._home(keys)
        out = self.at[slot]
        if not len(self.keys):
            return out
        wrong = np.flatnonzero((self.keys[out] != keys) & (out >= 0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            out[wrong] = self.at[slot[wrong]]
            wrong = wrong[(self.keys[out[wrong]] != keys[wrong]) & (out[wrong] >= 0)]
        return out


class Trie:
    """Log10 code lengths from the counts of all orders."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.order = len(levels) - 1
        tag = lambda k: _U(k + 1) << _U(56)
        keys, value, fresh, nodes, records = [], [], [], [], []
        below = None
        for k, (key, n) in enumerate(levels):
            context = key >> _U(8)
            node, start, at = np.unique(context, return_index=True, return_inverse=True)
            total = np.add.reduceat(n, start) if len(n) else n
            kinds = np.diff(np.append(start, len(n)))
            if below is None:  # under order 0: the bytes never seen, all alike
                rest, rest_kinds = np.zeros(len(node)), np.zeros(len(node))
            else:
                # In the next shorter context, without the symbols of this one.
                low_key, low_n, low_node, low_total, low_kinds = below
                mask = _U((1 << 8 * k) - 1)
                seen = np.add.reduceat(low_n[np.searchsorted(low_key, key & mask)], start) if len(n) else n
                parent = np.searchsorted(low_node, node & (mask >> _U(8)))
                rest, rest_kinds = low_total[parent] - seen, low_kinds[parent] - kinds
            with np.errstate(divide="ignore", invalid="ignore"):
                record = np.stack([np.log10(kinds / (2 * total)), np.log10(2 * rest), np.where(rest > 0, np.log10(rest_kinds / (2 * rest)), 0.0)], 1)
                fresh.append(np.log10((2 * n - 1) / (2 * total[at])))
                value.append(np.log10(2 * n - 1.0))
            keys.append(key | tag(k))
            nodes.append(node | tag(k))
            records.append(record)
            below = key, n, node, total, kinds
        self.symbols = Slots(np.concatenate(keys))
        self.value, self.fresh = (np.concatenate(v).astype(np.float32) for v in (value, fresh))
        self.nodes = Slots(np.concatenate(nodes))
        self.record = np.concatenate(records).astype(np.float32)
        self.unseen = -np.log10(max(1, 256 - len(levels[0][0])))

    def lengths(self, key: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of every n-gram, given the bytes before it."""
        out = np.zeros(len(key))
        left = np.arange(len(key))
        den = np.full(len(key), np.nan, np.float32)  # nan: no longer context was known
        esc = np.zeros(len(key), np.float32)
        for k in range(self.order, -1, -1):
            own = (key if len(left) == len(key) else key[left]) & _U((1 << 8 * (k + 1)) - 1)
            tag = _U(k + 1) << _U(56)
            at = self.symbols.find(own | tag)
            hit = at >= 0
            first = np.isnan(den)
            out[left[hit]] += np.where(first[hit], self.fresh[at[hit]], self.value[at[hit]] - den[hit])
            miss = ~hit
            left, den, esc, first = left[miss], den[miss], esc[miss], first[miss]
            if not len(left):
                return out
            node = self.nodes.find((own[miss] >> _U(8)) | tag)
            known = node >= 0
            record = self.record[np.maximum(node, 0)]
            out[left] += np.where(first, np.where(known, record[:, 0], 0), esc)
            den, esc = np.where(known, record[:, 1], np.float32(np.nan)), np.where(known, record[:, 2], np.float32(0))
        out[left] += self.unseen
        return out


class Model:
    """Counts of n-grams and of rare words, as tables; frequent words; the shards' ranges."""

    def __init__(self, tables: list[DataFrame], shards: list[tuple[int, int]], head: tuple[bytes, np.ndarray], words: DataFrame, closing: int,
                 total: int, distinct: int) -> None:
        self.tables, self.shards, self.head, self.words = tables, shards, head, words
        self.closing, self.total, self.distinct = closing, total, distinct


def fit(train: DataFrame, order: int = ORDER, entries: int = ENTRIES) -> Model:
    """Count bytes and words of every text of ``train``."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(words_of(text))
                seen[b""] += 1  # the closing token has no bytes, so it is no word
                if len(seen) > WORDS_HELD:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    words = cut(train.select("text").mapInPandas(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    sums = words.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"),
                     F.sum(F.when(F.octet_length("word") == 0, F.col("n"))).alias("closing")).first()
    tables = count_grams(train, order)
    total, distinct, closing = sums["total"] or 0, sums["distinct"], sums["closing"] or 0
    # Of the words with a count from some power of two on there are at most HEAD; the levels are 64 rows at most.
    by_level = {r["level"]: r["number"] for r in words.groupBy(F.floor(F.log2("n")).cast("int").alias("level"))
                .agg(F.count(F.lit(1)).alias("number")).collect()}
    floor = next(k for k in range(65) if sum(v for level, v in by_level.items() if level >= k) <= HEAD)
    head = words.filter((F.col("n") >= F.lit(2.0 ** floor)) & (F.octet_length("word") > 0)).toArrow()
    # One string of all words (a word holds no space) and one array: small to pickle.
    named, counts = b" ".join(head["word"].to_pylist()), head["n"].to_numpy().astype(np.int64)
    del head
    return Model(tables, shards_of(tables, entries), (named, counts), words.filter((F.col("n") < F.lit(2.0 ** floor)) & (F.octet_length("word") > 0)),
                 closing, total, distinct)


_HELD: dict = {}


def _held(key: str, levels: Broadcast) -> tuple[Trie | None, dict[bytes, int]]:
    """The broadcast shard as tables, built once per worker process."""
    if key not in _HELD:
        _HELD.clear()
        by_order, head, counts = levels.value
        _HELD[key] = Trie(by_order) if len(by_order[0][0]) else None, dict(zip(head.split(b" ") if head else [], counts.tolist()))
    return _HELD[key]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    smooth = model.total + 0.5 * (model.distinct + 1)
    context = docs.sparkSession.sparkContext

    def lengths(texts: list[bytes], trie: Trie | None, low: int, high: int) -> list[float]:
        """Of texts of some PIECE bytes together, the bytes whose contexts end in [low, high)."""
        sizes = np.array([len(t) + 1 for t in texts])
        if trie is None:
            return (-np.log10(256.0) * sizes).tolist()
        key = grams(texts, trie.order)
        if high - low == 1 << 8 * SPLIT:
            value = trie.lengths(key)
        else:
            end = (key >> _U(8)) & _U((1 << 8 * SPLIT) - 1)
            own = np.flatnonzero((end >= low) & (end < high))
            value = np.zeros(len(key))
            value[own] = trie.lengths(key[own])
        return np.add.reduceat(value, np.cumsum(sizes) - sizes).tolist()

    def passed(low: int, high: int, head: tuple[bytes, np.ndarray], rows: DataFrame, shape: str) -> DataFrame:
        held, key = context.broadcast((collect_trie(model.tables, low, high), *head)), uuid.uuid4().hex
        again = "doc_id" not in rows.columns
        out = cut(rows.mapInPandas((lambda b: more(b, key, held, low, high)) if again else (lambda b: run(b, key, held, low, high)), shape))
        held.unpersist()
        return out

    def more(batches: Iterator[pd.DataFrame], key: str, levels: Broadcast, low: int, high: int) -> Iterator[pd.DataFrame]:
        trie, _ = _held(key, levels)
        for batch in batches:
            part, size, found = [], 0, []
            for text in batch["text"]:
                part.append(b" ".join(words_of(text)))
                size += len(part[-1]) + 1
                if size >= PIECE:
                    found += lengths(part, trie, low, high)
                    part, size = [], 0
            if part:
                found += lengths(part, trie, low, high)
            yield pd.DataFrame({"h1": batch["h1"].array, "h2": batch["h2"].array, "score": found})

    def run(batches: Iterator[pd.DataFrame], key: str, levels: Broadcast, low: int, high: int) -> Iterator[pd.DataFrame]:
        trie, head = _held(key, levels)
        for batch in batches:
            rows, part, size, found = [], [], 0, []
            for text in batch["text"]:
                words = words_of(text)
                part.append(b" ".join(words))
                size += len(part[-1]) + 1
                known, base, rare = 0, 0.0, Counter()
                for word, n in Counter(words).items():
                    c = head.get(word)
                    if c is None:
                        rare[word] = n
                    else:
                        known += n
                        base += n * math.log10(c + 0.5)
                rows.append((len(words) + 1, known, base, list(rare), list(rare.values())))
                if size >= PIECE:
                    found += lengths(part, trie, low, high)
                    part, size = [], 0
            if part:
                found += lengths(part, trie, low, high)
            out = pd.DataFrame(rows, columns=["n_tokens", "known", "base", "rare", "many"])
            out.insert(0, "score", found)
            out.insert(0, "doc_id", batch["doc_id"].array)
            for name in ("row", "h2", "h1"):
                out.insert(0, name, batch[name].array)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Row numbers are fixed by the checkpoint, which both branches below read.
    hashes = [F.xxhash64(F.lit(k), "text").alias(f"h{k}") for k in (1, 2)]
    scored = passed(*model.shards[0], model.head, docs.select(*hashes, F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                    f"h1 bigint, h2 bigint, row bigint, doc_id {kind}, score double, n_tokens bigint, known bigint, base double, rare array<binary>, "
                    "many array<bigint>")
    # A text's sums in the other shards depend on the text alone, so its hashes name them.
    parts = [passed(low, high, (b"", np.zeros(0, np.int64)), docs.select(*hashes, "text"), "h1 bigint, h2 bigint, score double")
             .groupBy("h1", "h2").agg(F.max("score").alias("score")) for low, high in model.shards[1:]]
    if parts:
        rest = reduce(DataFrame.union, parts).groupBy("h1", "h2").agg(F.sum("score").alias("rest"))
        scored = cut(scored.join(rest, ["h1", "h2"]).withColumn("score", F.col("score") + F.col("rest")).drop("rest"))
    scored = scored.drop("h1", "h2")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "many")).alias("w")).select("row", F.col("w.rare").alias("word"), "w.many")
    met = (rare.join(model.words, "word").groupBy("row").agg(
        F.sum("many").alias("more"), F.sum(F.col("many") * F.log10(F.col("n") + 0.5)).alias("own")))
    more, own = F.coalesce("more", F.lit(0)), F.coalesce("own", F.lit(0.0))
    n_unknown = F.col("n_tokens") - 1 - F.col("known") - more
    closing = F.lit(math.log10(model.closing + 0.5))
    return scored.drop("rare", "many").join(met, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + more + F.lit(int(model.closing > 0))).cast("bigint").alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + own + n_unknown * F.lit(math.log10(0.5)) + closing - F.col("n_tokens") * F.lit(math.log10(smooth))).alias("base_score"),
        "score")
