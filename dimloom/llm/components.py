"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.sources.settle import settle


def _written(edges: DataFrame) -> DataFrame:
    """The rows as a table of known size.

    A checkpoint keeps the planner's estimate, which for a join is the product of both sides: over the rounds that number gains digits
    exponentially and takes the driver's memory and time.
    """
    return settle(edges.coalesce(4 * edges.sparkSession.sparkContext.defaultParallelism), "edges")


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge in ``edges`` (a, b: long).

    Each round every node hooks to the neighbour with the least value of that round's hash, and the edges are
    rewritten to the targets.  A random order shrinks chains as well as stars by a constant factor a round, so the rounds
    number O(log nodes) and the work is that of the first few.  Edges stay distributed; only their count reaches the driver.
    """
    proper = lambda e: (e.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct())
    left, rounds = _written(proper(edges)), []
    while left.count():
        rank = lambda c, r=len(rounds): F.struct(F.xxhash64(F.lit(r), c).alias("h"), c.alias("v"))
        both = left.union(left.select("b", "a"))
        hooks = _written(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min(F.least(rank(F.col("a")), rank(F.col("b"))))["v"].alias("root")))
        rounds.append(hooks)
        left = _written(proper(left.join(hooks.toDF("a", "ra"), "a")
                               .join(hooks.toDF("b", "rb"), "b")
                               .select(F.col("ra").alias("a"), F.col("rb").alias("b"))))
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    found = rounds[0]
    for later in rounds[1:]:
        found = (found.join(later.toDF("root", "next"), "root", "left")
                 .select("node", F.coalesce("next", "root").alias("root")))
    return found
