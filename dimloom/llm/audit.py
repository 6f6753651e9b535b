"""Filter interaction audit: what each text filter removes alone, after others, and in every order of the filters.

Four filters look at a text alone, the fifth drops repeats of a text.  Repeats are found by radix tries that hold full texts:

1. Texts are dealt out in ranges of adaptive prefixes.  Byte lengths 8, 32, 128, ... are levels; a prefix is heavy if more than a
   quarter of a partition's bytes begin with it.  A text goes down the levels while its prefix is heavy; the deepest heavy prefix and
   the stretch after it make its range key.  At most four heavy prefixes per partition and level exist, kept as hashes.
2. Each task first inserts what it reads into a trie of its own, so copies of one text leave it once, as the smallest id.
3. Each range inserts its texts, in order, into one compressed trie whose terminals hold the smallest id; branches that later texts
   cannot reach are traversed and dropped, so a task holds about ``HELD`` bytes of text, whatever the size of its range.
4. Every row gets a mask of the filters it fails; counts by part and mask (32 per part) give all 120 orders.

Defined results: a null text is empty.  A null id is no smaller id and has none: such rows neither are repeats nor make other rows
repeats.  Rows under one id with one text (repeated rows) are no repeats of each other, and each counts.  A null or absent source is
the part ''.  Of an id labelled more than once, one label of 1 suffices; null labels and ids are no labels.  Extra columns are not
looked at.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import cut

FILTERS = "ABCDE"
REPEAT = 1 << 4
#: Bytes of text per range, most ranges, sampled range keys per range, and bytes of text that a trie holds before it lets go of some.
RANGE, MOST, KEYS, HELD = 32 << 20, 16_384, 64, 24 << 20
LEVELS = tuple(8 * 4**k for k in range(11))
_UPPER, _STEM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 48


@dataclass(frozen=True)
class Limits:
    """Bounds of the filters A to D; percentages are of words (B) and of characters (C)."""

    words: int = 50
    distinct: int = 65
    capitals: int = 5
    marks: bytes = b"#$%&*|"


def fails(text: bytes, n_chars: int, limits: Limits) -> int:
    """Bits of the filters A to D that a text fails.  Words end at the six blanks of ASCII, which is what bytes split at."""
    words = text.split()
    mask = 1 if len(words) < limits.words else 0
    if 100 * len(set(words)) < limits.distinct * len(words):
        mask |= 2
    if 100 * (len(text) - len(text.translate(None, _UPPER))) > limits.capitals * n_chars:
        mask |= 4
    if len(text.translate(None, limits.marks)) != len(text):
        mask |= 8
    return mask


# ---------------------------------------------------------------- tries

class Node:
    """A node: the bytes that lead to it, children by their first byte, and at a terminal the smallest id with its rows by part."""

    __slots__ = ("best", "children", "label", "mask", "rows")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.rows: dict[str, int] | None = None
        self.best = 0
        self.mask = 0


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


@dataclass
class Trie:
    """A compressed trie of full texts."""

    root: Node = field(default_factory=lambda: Node(b""))
    held: int = 0

    def terminal(self, text: bytes) -> Node:
        """The node of the text, made where there is none."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.held += len(child.label)
                return child
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            k = _shared(child.label, text[at:at + len(child.label)])
            middle = node.children[text[at]] = Node(child.label[:k])
            child.label = child.label[k:]
            middle.children[child.label[0]] = child
            node, at = middle, at + k
        return node

    def add(self, text: bytes, doc_id: int, parts: dict[str, int], mask: int) -> list[tuple[int, str, int, int]]:
        """Insert rows of a text; returns the (id, part, mask, rows) that are known repeats by it."""
        node = self.terminal(text)
        if node.rows is None:
            node.best, node.rows, node.mask = doc_id, dict(parts), mask
            return []
        if doc_id == node.best:
            for part, n in parts.items():
                node.rows[part] = node.rows.get(part, 0) + n
            return []
        lost_id, lost = (doc_id, parts) if doc_id > node.best else (node.best, node.rows)
        if doc_id < node.best:
            node.best, node.rows = doc_id, dict(parts)
        return [(lost_id, part, mask | REPEAT, n) for part, n in lost.items()]

    def traverse(self) -> Iterator[tuple[bytes, Node]]:
        """Texts in order, with their terminals."""
        todo = [(self.root, b"")]
        while todo:
            node, before = todo.pop()
            text = before + node.label
            if node.rows is not None:
                yield text, node
            todo.extend((node.children[c], text) for c in sorted(node.children, reverse=True))


# ---------------------------------------------------------------- ranges

@dataclass(frozen=True)
class Ranges:
    """How texts are dealt out: node numbers of heavy prefixes by level and hash, and the keys at which ranges begin."""

    count: int
    heavy: tuple[dict[int, int], ...]
    bounds: list[bytes]

    def key(self, text: bytes) -> bytes:
        node, begin = 0, 0
        for level, heavy in zip(LEVELS, self.heavy):
            if not heavy or len(text) < level:
                break
            found = heavy.get(xxhash.xxh64_intdigest(text[:level], seed=42))
            if found is None:
                break
            node, begin = found, level
        end = next((n for n in LEVELS if n > begin), len(text))
        stretch = text[begin:end]
        tail = xxhash.xxh64_digest(stretch) if len(stretch) > _STEM else b""
        return node.to_bytes(4, "big") + stretch[:_STEM] + tail

    def number(self, text: bytes) -> int:
        low, high = 0, len(self.bounds)
        key = self.key(text) if high else b""
        while low < high:
            middle = (low + high) // 2
            if self.bounds[middle] <= key:
                low = middle + 1
            else:
                high = middle
        return low


def ranges_of(texts: DataFrame, size: int | None = None) -> Ranges:
    """Ranges of about ``size`` bytes over the column ``text`` (binary); prefixes are counted over all rows.

    The keys at which ranges begin come from some ``KEYS`` distinct texts per range, drawn by hash; they decide nothing but the balance.
    """
    size = size or RANGE
    total, rows = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    count = min(MOST, -(-(total or 0) // size))
    if count <= 1:
        return Ranges(1, (), [])
    n = F.octet_length("text")
    hashes = F.array(*[F.when(n >= level, F.xxhash64(F.substring("text", 1, level))) for level in LEVELS])
    heavy = (texts.select(n.alias("n"), hashes.alias("h")).select("n", F.posexplode("h").alias("level", "h")).filter("h IS NOT NULL")
             .groupBy("level", "h").agg(F.sum("n").alias("n")).filter(F.col("n") > total // (4 * count)).select("level", "h"))
    nodes: list[dict[int, int]] = [{} for _ in LEVELS]
    for number, row in enumerate(sorted(heavy.collect(), key=lambda r: (r["level"], r["h"])), 1):
        nodes[row["level"]][row["h"] & (2**64 - 1)] = number
    ranges = Ranges(count, tuple(nodes), [])
    digest = F.xxhash64("text")

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": pa.array([ranges.key(t) for t in batch.column(0).to_pylist()], pa.binary()),
                                              "digest": batch.column(1), "n": batch.column(2)})

    drawn = texts.filter(F.pmod(digest, F.lit(max(1, rows // (KEYS * count)))) == 0).select("text", digest.alias("digest"), n.alias("n"))
    sample = (drawn.mapInArrow(keys, "key binary, digest bigint, n int").groupBy("key", "digest").agg(F.max("n").alias("n"))
              .groupBy("key").agg(F.sum("n").alias("n")).collect())
    sample.sort(key=lambda r: bytes(r["key"]))
    sums = np.cumsum([r["n"] for r in sample]) if sample else np.zeros(0)
    at = np.searchsorted(sums, (sums[-1] if len(sums) else 0) * np.arange(1, count) / count)
    bounds = sorted({bytes(sample[i]["key"]) for i in at if 0 < i < len(sample)})
    return Ranges(len(bounds) + 1, tuple(nodes), bounds)


# ---------------------------------------------------------------- masks

_DEALT = pa.schema([("range", pa.int32()), ("text", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


class _Out:
    """Rows gathered into batches of a few megabytes."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.bytes = 0

    def put(self, where: int, text: bytes | None, doc_id: int | None, part: str, mask: int, n: int) -> None:
        self.rows.append((where, text, doc_id, part, mask, n))
        self.bytes += 64 + len(text or b"")

    def batches(self, least: int = 4 << 20) -> Iterator[pa.RecordBatch]:
        if self.rows and self.bytes >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), _DEALT)], schema=_DEALT)
            self.rows, self.bytes = [], 0


def masks(docs: DataFrame, limits: Limits = Limits(), size: int | None = None) -> DataFrame:
    """(doc_id, part, mask, n): rows of ``docs`` by the filters they fail; bit k stands for the k-th filter.

    ``docs`` has the columns doc_id and text; ``source`` names the part, if there is one.
    """
    part = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(whole.cast("binary").alias("text"), F.char_length(whole).alias("chars"), F.col("doc_id").cast("bigint").alias("doc_id"), part.alias("part"))
    ranges = ranges_of(rows.select("text"), size)
    held = HELD

    def first(batches):
        trie, out = Trie(), _Out()

        def release():
            nonlocal trie
            for text, node in trie.traverse():
                where = ranges.number(text)
                for p, n in node.rows.items():
                    out.put(where, text, node.best, p, node.mask, n)
                yield from out.batches()
            trie = Trie()

        for batch in batches:
            for text, chars, doc_id, p in zip(*[c.to_pylist() for c in batch.columns]):
                mask = fails(text, chars, limits)
                done = [(None, p, mask, 1)] if doc_id is None else trie.add(text, doc_id, {p: 1}, mask)
                for i, q, m, n in done:
                    out.put((i or 0) % ranges.count, None, i, q, m, n)
                if trie.held >= held:
                    yield from release()
            yield from out.batches()
        yield from release()
        yield from out.batches(0)

    def second(batches):
        trie, out, last = Trie(), _Out(), b""
        for batch in batches:
            for _, text, doc_id, p, mask, n in zip(*[c.to_pylist() for c in batch.columns]):
                if text is None:
                    out.put(0, None, doc_id, p, mask, n)
                    continue
                if trie.held >= held and text != last:  # texts come in order: what is in the trie is whole
                    for _, node in trie.traverse():
                        for q, k in node.rows.items():
                            out.put(0, None, node.best, q, node.mask, k)
                    trie = Trie()
                for row in trie.add(text, doc_id, {p: n}, mask):
                    out.put(0, None, *row)
                last = text
            yield from out.batches()
        for _, node in trie.traverse():
            for q, k in node.rows.items():
                out.put(0, None, node.best, q, node.mask, k)
        yield from out.batches(0)

    schema = "range int, text binary, doc_id bigint, part string, mask int, n bigint"
    dealt = rows.mapInArrow(first, schema).repartitionById(ranges.count, F.col("range")).sortWithinPartitions("text")
    return dealt.mapInArrow(second, schema).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- orders

ORDERS = ["".join(p) for p in permutations(FILTERS)]


def _matrices() -> dict[str, np.ndarray]:
    """Of each (order, step) the masks that are kept, removed, redundant, or fail its filter alone."""
    every = np.arange(32)
    rows: dict[str, list] = {"kept": [], "removed": [], "redundant": [], "unique_fails": []}
    for order in ORDERS:
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            failed, gone = (every & bit) > 0, (every & before) > 0
            rows["kept"].append(~failed & ~gone)
            rows["removed"].append(failed & ~gone)
            rows["redundant"].append(failed & gone)
            rows["unique_fails"].append(every == bit)
            before |= bit
    return {k: np.array(v, "int64") for k, v in rows.items()}


def orders(counts: DataFrame) -> DataFrame:
    """All orders and steps of each part, from (part, mask, n, good, toxic) with at most one row per part and mask."""
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in names)
    steps = [(o, s + 1) for o in ORDERS for s in range(5)]

    def run(batches):
        use = _matrices()
        letter = np.array([FILTERS.index(o[s - 1]) for o, s in steps])
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, good, toxic = (np.zeros(32, "int64") for _ in range(3))
                for c in cells:
                    n[c["mask"]], good[c["mask"]], toxic[c["mask"]] = c["n"], c["good"], c["toxic"]
                removed = use["removed"] @ n
                shapley = np.array([removed[letter == k].sum() for k in range(5)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(steps)), pa.array([o for o, _ in steps]), pa.array([s for _, s in steps], pa.int32()),
                     *[pa.array(a) for a in (use["kept"] @ n, removed, use["redundant"] @ n, use["unique_fails"] @ n,
                                             use["removed"] @ good, use["removed"] @ toxic, shapley[letter])]],
                    names=["part", "filter_order", "step", *names])

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), size: int | None = None) -> DataFrame:
    """The audit of ``docs`` with the labels (doc_id, quality, toxic): one row per part, order and step."""
    rows = cut(masks(docs, limits, size))
    marked = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
              .select("doc_id", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).filter("good + toxic > 0"))
    zero = F.lit(0).cast("bigint")
    plain = rows.groupBy("part", "mask").agg(F.sum("n").alias("n")).select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    known = rows.join(marked, "doc_id").groupBy("part", "mask").agg(
        F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    both = plain.unionByName(known.select("part", "mask", zero.alias("n"), "good", "toxic"))
    return orders(both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))
