"""Latest row per key.

The filter on ``row_number() = 1`` lets Spark cut every key to one row per task
before the shuffle, so a key that holds a third of the source still ships only
one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest: str, tie_break: str,
                   month_of: str | None = None) -> DataFrame:
    """Keep the row with the greatest ``newest`` per key, or per key and month of ``month_of``.

    ``tie_break`` must be unique within a key and date; a physical row position is not
    stable in Spark.  Rows without a month form one group per key.
    """
    by = [F.col(k) for k in keys]
    if month_of:
        by.append(F.trunc(F.col(month_of), "MM"))
    order = Window.partitionBy(*by).orderBy(F.col(newest).desc_nulls_first(), F.col(tie_break).desc_nulls_first())
    return df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")
