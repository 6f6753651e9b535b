"""Surrogate keys: gap-free numbers, given in parallel and from the data alone.

A task that runs again after a lost executor gives the same keys, because nothing
depends on partition numbers or arrival order.  Rows are shuffled once: they are written
out with their place in their bucket, and the second read adds what the buckets before
hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.sources.settle import settle

#: Copies of one row that are numbered and written out together.
COPIES_PER_TASK = 100_000
#: Hash buckets of the numbering.  Part of the numbers' definition: another count gives other keys.
BUCKETS = 4096


def highest_key(table: DataFrame, key: str) -> Column:
    """Scalar subquery: the greatest key in use, 0 for an empty table."""
    return F.coalesce(table.agg(F.max(key)).scalar(), F.lit(0)).cast("bigint")


def assign_ranges(rows: DataFrame, by: list[str], first: str, after: Column | int, width: Column,
                  buckets: int = BUCKETS) -> DataFrame:
    """Give every row ``width`` consecutive numbers; ``first`` holds the lowest of them.

    Rows are spread over hash buckets of ``by``, counted inside their bucket and written out once;
    each is then shifted by the totals of the buckets before its own.  ``by`` must be unique; its
    hash then spreads evenly.  Only the bucket totals, at most ``buckets`` rows, pass through one
    task and get broadcast.
    """
    return assign_many(rows, by, {first: (after, width)}, buckets)


def assign_many(rows: DataFrame, by: list[str], keys: dict[str, tuple[Column | int, Column]], buckets: int = BUCKETS) -> DataFrame:
    """``assign_ranges`` for several numberings of the same rows, which share its one shuffle and one write.

    ``keys`` names each numbering and gives the highest number before it and the width of a row.
    """
    wide = {f"_width_{i}": width.cast("bigint") for i, (_, width) in enumerate(keys.values())}
    tagged = rows.withColumns({"_bucket": F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"), **wide})
    earlier = Window.partitionBy("_bucket").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    placed = settle(tagged.withColumns({
        f"_place_{i}": F.coalesce(F.sum(f"_width_{i}").over(earlier), F.lit(0)) for i in range(len(keys))}), "placed")
    totals = placed.groupBy("_bucket").agg(*[
        F.max(F.col(f"_place_{i}") + F.col(f"_width_{i}")).alias(f"_total_{i}") for i in range(len(keys))])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("_bucket", *[
        F.coalesce(F.sum(f"_total_{i}").over(before), F.lit(0)).alias(f"_shift_{i}") for i in range(len(keys))])
    bases = [after if isinstance(after, Column) else F.lit(int(after)).cast("bigint") for after, _ in keys.values()]
    return (
        placed.join(F.broadcast(shift), "_bucket")
        .withColumns({k: b + F.col(f"_shift_{i}") + F.col(f"_place_{i}") + 1 for i, (k, b) in enumerate(zip(keys, bases))})
        .drop("_bucket", *[f"_{n}_{i}" for i in range(len(keys)) for n in ("width", "place", "shift")])
    )


def assign_keys(rows: DataFrame, by: list[str], name: str, after: Column | int,
                buckets: int = BUCKETS) -> DataFrame:
    """Number rows ``after + 1 .. after + n``; ``by`` must be unique."""
    return assign_ranges(rows, by, name, after, F.lit(1), buckets)


def fold_copies(rows: DataFrame) -> DataFrame:
    """Distinct rows with the number of copies of each, combined on the map side.

    Many copies of a row become several rows (``_piece``), which the numbering spreads over its buckets, so the copies of
    one row are written out by many tasks.
    """
    folded = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_all"))
    limit = F.lit(COPIES_PER_TASK).cast("bigint")
    pieces = folded.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_all") - 1) / limit))))
    return pieces.withColumn("_copies", F.least(limit, F.col("_all") - F.col("_piece") * limit)).drop("_all")


def unfold_copies(folded: DataFrame, first: str, step: Column) -> DataFrame:
    """Write every copy out again; copy ``i`` of a piece starts ``i * step`` after its ``first``."""
    copies = folded.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
    return copies.withColumn(first, F.col(first) + F.col("_copy") * step).drop("_copy", "_copies", "_piece")
