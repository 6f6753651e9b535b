"""Helpers the operators share: table reads, hold-out folds, lineage cuts, local bindings."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Texts of single-byte characters take the faster built-in."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def cut(df: DataFrame, few: bool = False) -> DataFrame:
    """Cut lineage through the folder in ``spark.checkpoint.dir``, which every executor sees.

    Spark's cleaner removes the files with the DataFrame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.  Only a single-process session without that setting (tests)
    gets a folder of its own.  ``few`` is for results that are small against the documents: a few files for each core are
    enough for them.  What comes from a scan keeps its partitions, so that its tasks stay short.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="dimloom-checkpoints-")
        context.setCheckpointDir(named)
    return (df.coalesce(4 * context.defaultParallelism) if few else df).checkpoint()
