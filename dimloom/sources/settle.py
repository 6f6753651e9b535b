"""Cut a plan by writing its rows out once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Paths that each open ``scratch`` has to delete, the innermost last.
_SCRATCH: list[list[str]] = []
# Spark setting: shuffle files go when the query that wrote them has ended, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(df: DataFrame) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of its own for a local session without it.

    On a cluster every executor must see the folder, so there it has to be named.
    """
    spark = df.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="dimloom-")
    return _LOCAL[context.applicationId]


def settle(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write the rows to the shared folder and read them back.

    For rows that several branches of a load need.  Unlike cached rows they outlive a lost
    executor, are read by column, and tell the planner their true size.  Inside ``scratch`` they last as long as that.
    """
    path = f"{shared_folder(df)}/dimloom-{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Give back the disk of a step: its settled rows go when it ends, its shuffle files when each of its queries ends.

    What the step returns must not read settled rows any more; the loads return what they wrote to their tables.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    _SCRATCH.append([])
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
        for path in _SCRATCH.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
