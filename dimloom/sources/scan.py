"""Source reads: incremental window, scope, watermarks, probes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.functions.dates import FIRST_WATERMARK, as_bound, as_moment, within_day


def read_source(spark: SparkSession, location: str, columns: list[str] | None = None,
                fmt: str = "parquet", **options: str) -> DataFrame:
    """Read a source through any Spark reader, keeping only the named columns."""
    df = spark.read.format(fmt).options(**options).load(location)
    return df.select(*columns) if columns else df


def incremental_window(df: DataFrame, column: str, after: dt.date | str, up_to: dt.date | str,
                       lookback_days: int = 0) -> DataFrame:
    """Rows with ``after < column <= up_to``; look-back re-reads late rows.  Bounds may be dates or moments."""
    low, high = as_bound(as_moment(after) - dt.timedelta(days=lookback_days)), as_bound(up_to)
    return df.filter((F.col(column) > F.lit(low)) & (F.col(column) <= F.lit(high)))


def max_watermark(df: DataFrame, column: str, after: dt.date | str | None = None) -> DataFrame:
    """One row: the greatest watermark value of the source, NULL when there is none.

    With ``after``, of newer rows alone, so a scan can skip what earlier runs have seen.
    """
    rows = df if after is None else df.filter(F.col(column) > F.lit(as_bound(after)))
    return rows.agg(F.max(column).alias("max_watermark"))


def stored_max_watermark(spark: SparkSession, location: str, column: str, name: str = "max_watermark") -> DataFrame:
    """One row: the greatest value of a Parquet column, from the files' statistics alone.

    The scan itself returns the maximum (``PushedAggregation`` in its plan) and reads footers, no rows.
    Spark does so for its newer file source and whole tables only, hence a session of its own and no
    lower bound; dates and numbers have statistics it trusts, other types are read.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(location).agg(F.max(column).alias(name))


def lower_watermark(last: Column) -> Column:
    """Lower bound of the next window; an entity that never ran starts at the beginning."""
    return F.coalesce(last, F.lit(FIRST_WATERMARK))


def advanced_watermark(last: Column, source_max: Column) -> Column:
    """State after a successful run: only a newer source maximum moves the watermark."""
    low = lower_watermark(last)
    return F.when(source_max > low, source_max).otherwise(last)


def has_news(low: dt.date, high: dt.date | None) -> bool:
    return high is not None and as_moment(high) > as_moment(low)


def scope_filter(df: DataFrame, portfolio: str, day: dt.date | str,
                 portfolio_column: str = "portfolio_id", day_column: str = "reporting_date") -> DataFrame:
    return df.filter((F.col(portfolio_column) == F.lit(portfolio)) & within_day(F.col(day_column), day))


def source_probe(df: DataFrame) -> DataFrame:
    """One row with 1 when the source can be read and has a row, else 0; reads at most one row."""
    return df.limit(1).agg(F.count(F.lit(1)).cast("int").alias("source_ok"))


def scope_counts(df: DataFrame, portfolio: str | None = None) -> DataFrame:
    """Source rows per portfolio and reporting day."""
    rows = df if portfolio is None else df.filter(F.col("portfolio_id") == F.lit(portfolio))
    return rows.groupBy("portfolio_id", F.to_date("reporting_date").alias("reporting_day")).agg(
        F.count(F.lit(1)).alias("row_count"))
