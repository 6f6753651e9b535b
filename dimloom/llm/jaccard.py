"""Near copies: SimHash fingerprints, every link confirmed by the Jaccard similarity of word shingles, and what fingerprints cannot tell.

Candidates come from two sides.  Texts whose fingerprints (``simhash``: four-word shingles) lie within ``RADIUS`` bits are met by its tiles; a link
counts only if the whole sets agree.  Sets of similarity 0.8 differ in some 10 bits, which no radius tells from unlike texts, so a prefix filter over
the shingles themselves meets the other pairs, and the result is exact.

Words are split and lower-cased as for the fingerprints of ``simhash``; a text is the set of its 64-bit shingle hashes, one of fewer words than a
shingle is one shingle.  Two sets of similarity ``least`` or more share a shingle among the first ``n - ceil(least n) + 1`` of each, under any
one order of all shingles (prefix filter), so texts are met under those shingles only and no pair is missed.  The order puts
shingles that are common in a sample last, so a passage that many texts quote rarely brings them together; the sample decides the cost,
never the result.

Under the first shingle that two texts share, none of what either has before it is in the other, so a pair counts there only if what is
left of both leaves room for the similarity.  Texts met under one shingle are compared with the one that has the fewest before it; only where
that leaves more than one component are the other pairs compared, by their marks inside the bucket, so only pairs that may be links become rows.  A link is a pair whose whole sets reach ``least``; no document goes without a chain of such links to the one that stays.

Defined results: texts of the same words are copies, and so are null and wordless ones; rows are told apart by id and text, so rows with a null
id, or with one id and several texts, are judged apart; of a component the row with the least id stays (a null id last), of its repetitions one;
extra columns are returned as they were; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm import simhash
from dimloom.llm.common import cut
from dimloom.llm.components import contract

#: Sampled texts and common shingles taken from them; rows up to which a table is broadcast; pairs handed on at once; texts in
#: Python at once (a batch of Arrow holds thousands).
SAMPLE, COMMON, FEW, STEP, PIECE = 8_000, 200_000, 200_000, 1 << 18, 256
#: Bits in which the fingerprints of a candidate pair may differ.
RADIUS = 4
#: Mask of the bits of a class that hold its size.
MOST = (1 << 12) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only


def class_of(words: list[bytes], n: int) -> int:
    """A number for all texts of these words, signed; its last bits hold the number of shingles, as far as they go."""
    h = xxhash.xxh64_intdigest(b" ".join(words), 7) & ~MOST | min(n, MOST)
    return h - (1 << 64) if h >> 63 else h


def shingles_of(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes."""
    if not words:
        return np.zeros(0, np.int64)
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(whole, 42)], np.uint64).view(np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    return np.unique(np.array([digest(whole[a:b], 42) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())], np.uint64).view(np.int64))


def mark_of(shingles: np.ndarray) -> np.ndarray:
    """A bit for each range of hashes that holds a shingle; at least four ranges for each shingle, a power of two in all."""
    bits = max(6, (4 * len(shingles) - 1).bit_length()) if len(shingles) else 6
    return np.bincount((shingles.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) > 0


def can_be_near(na: int, x: np.ndarray, nb: int, y: np.ndarray, least: float) -> bool:
    """Whether two marks leave room for enough shared shingles: each mark of one text alone is a shingle that the other lacks."""
    while len(x) != len(y):  # two neighbouring ranges make one of the coarser mark
        if len(x) > len(y):
            x = x.reshape(-1, 2).any(1)
        else:
            y = y.reshape(-1, 2).any(1)
    both = min(na - np.count_nonzero(x & ~y), nb - np.count_nonzero(y & ~x))
    return both * (1 + least) >= least * (na + nb) - 1e-6


def packed(shingles: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes, six bytes each."""
    return shingles.view(np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.int64)


def prefix_of(shingles: np.ndarray, common: np.ndarray, rank: np.ndarray, least: float) -> np.ndarray:
    """The shingles under which a text is met: rare ones by hash, then the common ones by rank.  ``common`` is sorted."""
    n = len(shingles)
    take = n - math.ceil(least * n - 1e-9) + 1 if n else 0
    if not len(common):
        return shingles[:take]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    return shingles[np.argsort(np.where(common[at] == shingles, rank[at] + 1, 0), kind="stable")[:take]]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, PIECE):
            yield batch.slice(i, PIECE)


def _common(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that several sampled texts hold, and their ranks by number of texts."""
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    sample = docs.select("text").filter(F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"key": np.concatenate([shingles_of(words_of(t), size) for t in batch["text"]])})

    counted = cut(sample.distinct().mapInPandas(run, "key bigint").groupBy("key").count().filter("count >= 3"), few=True)
    # The counts that leave at most COMMON shingles; a level of counts is kept whole, so nothing has to be sorted.
    levels = sorted(((r["count"], r["n"]) for r in counted.groupBy("count").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = 0, 0
    for count, n in levels:  # at most SAMPLE of them
        if held + n > COMMON:
            least = count + 1
            break
        held += n
    rows = counted.filter(F.col("count") >= least).toArrow()
    key, n = rows["key"].to_numpy().astype(np.int64), rows["count"].to_numpy().astype(np.int64)
    key = key[np.lexsort((-key, n))]  # the most common one last
    at = np.argsort(key)
    return key[at], at


def room(rest: int, n: int, other: int, least: float) -> bool:
    """Whether a text of ``n`` shingles, ``rest`` of them from the first shared one on, can share enough with one of ``other``; of columns and arrays too."""
    return rest * (1 + least) >= least * (n + other) - 1e-6


def _buckets(docs: DataFrame, size: int, least: float) -> DataFrame:
    """(bucket, ms): classes of texts met under one shingle, with their number of shingles and how many come before it; the one with the fewest is first."""
    common, rank = _common(docs, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            keys, classes, sizes = [], [], []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                shingles = shingles_of(words, size)
                keys.append(prefix_of(shingles, common, rank, least))
                classes.append(class_of(words, len(shingles)))
                sizes.append(len(shingles))
            many = [len(k) for k in keys]
            yield pa.RecordBatch.from_pydict({
                "key": np.concatenate(keys), "at": np.concatenate([np.arange(m, dtype=np.int32) for m in many]),
                "n": np.repeat(np.array(sizes, np.int32), many), "cid": np.repeat(np.array(classes, np.int64), many)})

    met = (docs.select("text").mapInArrow(run, "key bigint, at int, n int, cid bigint")
           .groupBy("key").agg(F.collect_set(F.struct("at", "n", "cid")).alias("ms")).filter(F.size("ms") > 1).select(F.array_sort("ms").alias("ms")))
    return cut(met.select(F.monotonically_increasing_id().alias("bucket"), "ms"), few=True)


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _class(size: int) -> Callable:
    """Class and fingerprint of a text; both depend on its words alone."""
    @F.pandas_udf("cid long, fp long")
    def named(texts: pd.Series) -> pd.DataFrame:
        cids, prints = [], []
        for text in texts:
            words = words_of(text)
            cids.append(class_of(words, len(shingles_of(words, size))))
            prints.append(simhash.fingerprint_of(text))
        return pd.DataFrame({"cid": np.array(cids, np.int64), "fp": np.array(prints, np.int64)})

    return named


def alike(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): classes that the fingerprints in ``prints`` (cid, fp) bring together: of one fingerprint, or linked in ``simhash``'s tiles."""
    classes = cut(prints.distinct(), few=True)
    first = classes.groupBy("fp").agg(F.min("cid").alias("first"))
    same = classes.join(first, "fp").select(F.col("first").alias("x"), F.col("cid").alias("y"))
    links = simhash.links(classes, radius).toDF("fa", "fb")
    near = (links.join(first.toDF("fa", "x"), "fa").join(first.toDF("fb", "y"), "fb").select("x", "y"))
    return cut(same.union(near).filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), few=True)


class _Texts:
    """Whole texts of classes, looked up by hash, and what is computed from them; nothing is kept."""

    def __init__(self, docs: DataFrame, named: DataFrame, size: int) -> None:
        self.docs, self.size = docs.select("text", F.xxhash64("text").alias("text_hash")), size
        self.named = named.groupBy("cid").agg(F.min("text_hash").alias("text_hash"))

    def of(self, cids: DataFrame, run: Callable, shape: str) -> DataFrame:
        """``run`` over (cid, sorted shingles) of the given classes, one row each; copies are dropped after it."""
        size = self.size

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _pieces(batches):
                made = [run(shingles_of(words_of(t), size)) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["cid"], *map(pa.array, zip(*made))], ["cid", *[f.split()[0] for f in shape.split(", ")]])

        wanted = _few(cut(self.named.join(_few(cids), "cid", "left_semi"), few=True))
        return self.docs.join(wanted, "text_hash").select("cid", "text").mapInArrow(rows, f"cid bigint, {shape}").dropDuplicates(["cid"])


def _linked(pairs: DataFrame, texts: _Texts, marks: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Sizes, then marks (half a byte a shingle) rule out nearly all others; sets are computed for what is left.
    """
    @F.pandas_udf("boolean")
    def can_be(na: pd.Series, x: pd.Series, nb: pd.Series, y: pd.Series) -> pd.Series:
        bits = lambda raw: np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
        return pd.Series([can_be_near(i, bits(p), j, bits(q), least) for i, p, j, q in zip(na, x, nb, y)], dtype=bool)

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = unpacked(x), unpacked(y)
            both = len(np.intersect1d(x, y))
            out.append(both >= least * (len(x) + len(y) - both) - 1e-9)
        return pd.Series(out, dtype=bool)

    na, nb = F.col("a").bitwiseAND(MOST), F.col("b").bitwiseAND(MOST)
    sized = pairs.filter((F.greatest(na, nb) == MOST) | (F.least(na, nb) >= F.lit(least) * F.greatest(na, nb) - 1e-9)).distinct()
    left = cut(sized.join(marks.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("mark").alias("ma")), "a")
               .join(marks.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("mark").alias("mb")), "b")
               .filter((F.least("na", "nb") >= F.lit(least) * F.greatest("na", "nb") - 1e-9) & can_be("na", "ma", "nb", "mb")).select("a", "b"), few=True)
    sets = texts.of(left.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), lambda s: (packed(s),), "shingles binary")
    return cut(left.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b")
               .join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a")
               .filter(near("sa", "sb")).select("a", "b"), few=True)


def may_be_near(x: np.ndarray, y: np.ndarray, n: np.ndarray, marks: list[bytes], least: float) -> np.ndarray:
    """``can_be_near`` of many pairs of places in ``n`` and in the packed ``marks``; ``STEP`` bytes and more of marks at once."""
    length = np.array([len(m) for m in marks])
    width, out = np.minimum(length[x], length[y]), np.zeros(len(x), bool)
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        places, back = np.unique(np.concatenate((x[of], y[of])), return_inverse=True)
        bits = np.stack([np.packbits(np.unpackbits(np.frombuffer(marks[p], np.uint8)).reshape(8 * w, -1).any(1)) for p in places]).view(np.uint64)
        step = max(1, 8 * STEP // w)
        for i in range(0, len(of), step):
            one, a, b = of[i:i + step], bits[back[:len(of)][i:i + step]], bits[back[len(of):][i:i + step]]
            na, nb = n[x[one]], n[y[one]]
            both = np.minimum(na - np.bitwise_count(a & ~b).sum(1, dtype=np.int64), nb - np.bitwise_count(b & ~a).sum(1, dtype=np.int64))
            out[one] = both * (1 + least) >= least * (na + nb) - 1e-6
    return out


def _across(open_: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of different components of a bucket that positions and marks leave room for.

    Marks are dealt to the members of a bucket, not to its pairs, so what a bucket hands on are the pairs that may be links, however many it has in all.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                node, root, n, at = (batch[k][i].values.to_numpy(zero_copy_only=False).astype(np.int64) for k in ("node", "root", "n", "at"))
                raw, step = batch["mark"][i].as_py(), max(1, STEP // len(node))
                for first in range(0, len(node), step):
                    one = slice(first, first + step)
                    x, y = np.nonzero((root[one, None] != root[None]) & (node[one, None] < node[None])
                                      & room((n - at)[one, None], n[one, None], n[None], least) & room((n - at)[None], n[None], n[one, None], least))
                    x += first
                    if len(x):
                        near = may_be_near(x, y, n, raw, least)
                        yield pa.RecordBatch.from_pydict({"a": node[x[near]], "b": node[y[near]]})

    members = open_.select("bucket", F.explode("ms").alias("m")).select("bucket", "m.*")
    marked = (members.join(marks.select(F.col("cid").alias("node"), "mark"), "node")
              .groupBy("bucket").agg(F.collect_list(F.struct("node", "root", "n", "at", "mark")).alias("ms")))
    return marked.select("ms.node", "ms.root", "ms.n", "ms.at", "ms.mark").mapInArrow(run, "a bigint, b bigint")


def roots(docs: DataFrame, named: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """(node, root) of the classes of texts that have a link; ``named`` has the class (cid), fingerprint (fp) and hash (text_hash) of every text."""
    buckets = _buckets(docs, size, least)
    texts = _Texts(docs, named, size)
    # A star from the member with the fewest rarer shingles: of a group of near copies, the one nearest to what they have in common.
    pairs = buckets.select(F.col("ms")[0].alias("x"), F.explode("ms").alias("y")).filter("x.cid <> y.cid")
    stars = (pairs.filter(room(F.col("x.n") - F.col("x.at"), F.col("x.n"), F.col("y.n"), least) & room(F.col("y.n") - F.col("y.at"), F.col("y.n"), F.col("x.n"), least))
             .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct())
    marks = cut(texts.of(buckets.select(F.explode("ms.cid").alias("cid")).distinct(),
                         lambda s: (len(s), np.packbits(mark_of(s)).tobytes()), "n bigint, mark binary"), few=True)
    # A pair that its sets confirm shares a bucket, so its classes have marks; those without are no near copies.
    found = _linked(alike(named.select("cid", "fp")).union(stars), texts, marks, least)
    known = cut(contract(found), few=True)
    # The other pairs of buckets that still hold several components.
    open_ = cut(buckets.filter(F.size("ms") > 2)
                .select("bucket", F.explode(F.slice("ms", F.lit(2), F.size("ms") - 1)).alias("m")).select("bucket", "m.*", F.col("m.cid").alias("node"))
                .join(known, "node", "left")
                .select("bucket", F.struct("node", "at", "n", F.coalesce("root", "node").alias("root")).alias("m"))
                .groupBy("bucket").agg(F.collect_list("m").alias("ms"), F.min("m.root").alias("low"), F.max("m.root").alias("high"))
                .filter("low <> high"), few=True)
    if not open_.count():
        return known

    more = _linked(_across(open_, marks, least), texts, marks, least)
    # What is known is a forest of stars, so the new links alone take rounds.
    return cut(contract(known.toDF("a", "b").union(more)), few=True)


def keep_one(docs: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """One row of each component of near copies, with all its columns."""
    rows = cut(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _class(size)("text").alias("named")).select("doc_id", "text_hash", "named.*"))
    keys = rows.groupBy("doc_id", "text_hash", "cid").agg(F.count(F.lit(1)).alias("many"))
    tops = roots(docs.select("text"), rows.select("cid", "fp", "text_hash"), size, least)
    named = cut(keys.join(tops.withColumnRenamed("node", "cid"), "cid", "left").select(
        "many", F.coalesce("root", "cid").alias("root"), F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash").alias("key")))
    first = named.groupBy("root").agg(F.min("key").alias("first"))
    # Most rows stand alone, so those that go or are repeated are sought instead of those that stay.
    moved = cut(named.join(first, "root").select("key.doc_id", "key.text_hash", "many", (F.col("key") == F.col("first")).alias("stays"))
                .filter(~F.col("stays") | (F.col("many") > 1)), few=True).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    small = _few(moved)
    whole = docs.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("hash"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    once = whole.join(small.filter("stays"), same).dropDuplicates(["_id", "_hash"]).select("doc.*")
    return whole.join(small, same, "left_anti").select("doc.*").unionByName(once)
