"""Change hash over the tracked columns of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import plain_number

# Fixed values.  A missing value and the text NULL hash alike; loads compared with
# older hashes depend on it.
NULL_MARK = "NULL"
SEPARATOR = "\x01"


def hash_text(value: Column, data_type: T.DataType) -> Column:
    """Text of one value as it enters the hash; a cast date reads yyyy-MM-dd."""
    if isinstance(data_type, T.DecimalType):
        return plain_number(value, data_type.scale)
    return value.cast("string")


def record_hash(df: DataFrame, columns: list[str]) -> Column:
    """Upper-case SHA-256 over the columns in the given order."""
    parts: list[Column] = []
    for name in columns:
        text = hash_text(F.col(name), df.schema[name].dataType)
        parts += [F.coalesce(text, F.lit(NULL_MARK)), F.lit(SEPARATOR)]
    return F.upper(F.sha2(F.concat(*parts[:-1]), 256))
