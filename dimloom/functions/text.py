"""Text rules of the source feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Treat empty text as missing, in the named columns or in all text columns."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in names}) if names else df


def code_prefix(code: Column, length: int) -> Column:
    return F.substring(code, 1, length)


def dotted_key(*parts: Column) -> Column:
    """Join parts with dots; a missing part is empty but keeps its dot."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.coalesce(part, F.lit("")), F.lit(".")]
    return F.concat(*pieces[:-1])


def plain_number(value: Column, scale: int) -> Column:
    """Shortest decimal text: no trailing zeros, no zero before the point (``.5``, ``-.5``)."""
    text = value.cast("string")
    if scale <= 0:
        return text
    trimmed = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return (F.when(trimmed.startswith("0."), F.substring(trimmed, 2, 64))
            .when(trimmed.startswith("-0."), F.concat(F.lit("-"), F.substring(trimmed, 3, 64)))
            .otherwise(trimmed))


def truncate(value: Column, length: int) -> Column:
    return F.substring(value, 1, length)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
