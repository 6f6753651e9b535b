"""Reduction of a large side before a join, without moving it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the bits in the key map, 64 to a row: at most 2^20 rows, some tens of megabytes, whatever the number of keys.
MAP_BITS = 26


def _place(columns: list[Column], bits: int) -> tuple[Column, Column]:
    """Row and bit of the map that stand for a key."""
    code = F.xxhash64(*columns)
    return F.shiftrightunsigned(code, 64 - (bits - 6)), code.bitwiseAND(F.lit(63)).cast("int")


def maybe_among(rows: DataFrame, keys: DataFrame, pairs: list[tuple[str, str]], bits: int = MAP_BITS) -> DataFrame:
    """Rows whose key may be one of ``keys``; ``pairs`` names the key columns of both sides.

    The keys set bits of a map by their hash; the map is broadcast and ``rows`` are tested where they
    are, so none is shuffled.  No row with such a key is lost.  Of the others, a share of about keys / 2^bits
    stays, up to all of them when the keys outnumber the bits: the join that follows has to compare.
    """
    theirs = [F.col(k).cast(rows.schema[r].dataType) for r, k in pairs]
    word, bit = _place(theirs, bits)
    one = F.lit(1).cast("bigint")
    key_map = keys.select(word.alias("_word"), F.call_function("shiftleft", one, bit).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    word, bit = _place([F.col(r) for r, _ in pairs], bits)
    marked = rows.withColumns({"_row_word": word, "_row_bit": bit})
    met = marked.join(F.broadcast(key_map), F.col("_row_word") == F.col("_word"))
    return met.filter(F.call_function("shiftrightunsigned", F.col("_bits"), F.col("_row_bit")).bitwiseAND(one) == 1).select(*rows.columns)
