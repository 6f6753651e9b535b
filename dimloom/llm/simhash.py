"""SimHash near-duplicates: 64-bit fingerprints, compared exactly in tiles.

Distinct fingerprints fall into cells by the population counts of their two halves.  Two fingerprints that differ in at most
``radius`` bits lie in cells whose counts differ by at most ``radius`` in sum, so all other pairs of cells are skipped; the
rest are compared tile against tile with numpy exclusive-or and bit counts.  A tile pair returns a spanning forest of its links,
never the pairs themselves, so a large group of near copies yields a row per member.

Defined results: a null or wordless text has fingerprint zero, which links like any other; repeated rows share a
fingerprint and therefore a component; a null id is kept as a row and never names a component unless it is alone; extra
columns are ignored by ``components`` and returned as they were by ``keep_one``; an empty table gives an empty result.

The work is quadratic in the number of distinct fingerprints, as the method is; the cells leave about a third of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import cut
from dimloom.llm.components import contract

#: Fingerprints in a tile, on average; a tile is one array of 64 KB.
TILE = 8192
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE = 256 * np.arange(8)


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        whole, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        hashes = [digest(whole[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + _BYTE).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(counts.ravel() * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp: long) of every row."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", fp("text").alias("fp"))


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` bits between two tiles, thinned to (member, root) edges with the same components."""
    nodes = np.unique(np.concatenate((a, b)))
    at_a, at_b = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    root = np.arange(len(nodes))
    a, b = a.view(np.uint64), b.view(np.uint64)  # of a signed number, numpy counts the bits of the absolute value
    step = max(1, 262_144 // max(1, len(b)))
    for i in range(0, len(a), step):
        x, y = np.nonzero(np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius)
        x, y = at_a[i + x], at_b[y]
        while len(x):
            x, y = root[x], root[y]
            apart = x != y
            low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(root, high, low)
            while not np.array_equal(up := root[root], root):
                root = up
            x, y = low, high
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[member], nodes[root[member]]


def links(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(a, b): edges between distinct fingerprints that connect what lies within ``radius`` bits."""
    cells = prints.select("fp").distinct().select(
        "fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("p"), F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF)).alias("q"))
    sizes = cells.groupBy("p", "q").count().select("p", "q", F.ceil(F.col("count") / tile).cast("int").alias("blocks"))
    tiles = cut(cells.join(F.broadcast(sizes), ["p", "q"])  # 33 x 33 rows at most
                .groupBy("p", "q", F.pmod(F.xxhash64("fp"), "blocks").alias("block")).agg(F.collect_list("fp").alias("fps")))
    near = F.array(*[F.struct(F.lit(p).alias("dp"), F.lit(q).alias("dq")) for p in range(radius + 1)
                     for q in range(-radius, radius + 1) if p + abs(q) <= radius and (p, q) >= (0, 0)])
    ids = tiles.select("p", "q", "block")
    other = ids.toDF("p2", "q2", "block2")
    pairs = (ids.withColumn("d", F.explode(near)).withColumns({"p2": F.col("p") + F.col("d.dp"), "q2": F.col("q") + F.col("d.dq")})
             .join(other, ["p2", "q2"])
             .filter((F.struct("p", "q") != F.struct(F.col("p2").alias("p"), F.col("q2").alias("q"))) | (F.col("block") <= F.col("block2"))))
    both = (pairs.join(tiles, ["p", "q", "block"])
            .join(tiles.toDF("p2", "q2", "block2", "fps2"), ["p2", "q2", "block2"]).select("fps", "fps2"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in zip(batch["fps"], batch["fps2"]):
                member, top = forest(np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64), radius)
                if len(member):
                    yield pd.DataFrame({"a": member, "b": top})

    return both.mapInPandas(compare, "a long, b long")


def components(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = cut(fingerprints(docs, shingle))
    roots = cut(contract(links(prints, radius)), few=True)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = (first.join(roots, first["fp"] == roots["node"], "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = cut(named.join(least, "root").select("fp", "component_id"))
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """The documents whose id names their component, with all their columns; of repeated rows of that id, one stays."""
    kept = components(docs, radius, shingle).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("doc")).join(kept, F.col("doc.doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
    return rows.select("doc.*").dropDuplicates(["doc_id"])
