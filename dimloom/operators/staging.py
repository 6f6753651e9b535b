"""Staging tags and staging summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage(payload: DataFrame, run_id: int, row_hash: Column) -> DataFrame:
    """Put the staging tags of a new pending row before the payload."""
    return payload.select(
        F.lit(run_id).cast("bigint").alias("stg_run_id"),
        F.lit("PENDING").alias("stg_status"),
        F.lit(None).cast("string").alias("stg_action"),
        F.lit(None).cast("string").alias("stg_reject_reason"),
        row_hash.alias("stg_record_hash"),
        *payload.columns,
    )


def purge_pending(staging: DataFrame) -> DataFrame:
    """Drop what an interrupted run left pending; loaded and rejected rows stay for audit."""
    return staging.filter(F.col("stg_status") != "PENDING")


def mark_loaded(staged: DataFrame, action: str | None = None) -> DataFrame:
    """Pending rows become LOADED; a merge also stamps its action."""
    pending = F.col("stg_status") == "PENDING"
    changes = {"stg_status": F.when(pending, F.lit("LOADED")).otherwise(F.col("stg_status"))}
    if action:
        changes["stg_action"] = F.when(pending, F.lit(action)).otherwise(F.col("stg_action"))
    return staged.withColumns(changes)


def record_key(columns: list[str]) -> Column:
    """The key of a row as text: ``NAME=value``, several joined by bars; a missing value is empty."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{c.upper()}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns])


def record_data(columns: list[str]) -> Column:
    """The named columns of a row as one JSON text, missing values included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def staging_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per staging table, run, status and action."""
    return union_all([
        df.groupBy("stg_run_id", "stg_status", "stg_action")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("staging_table"), "stg_run_id", "stg_status", "stg_action", "row_count")
        for name, df in tables.items()])


def rejected_rows(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rejected rows of several staging tables; each entry names its record key column."""
    return union_all([
        df.filter(F.col("stg_status") == "REJECTED").select(
            F.lit(name).alias("staging_table"), "stg_run_id", F.col(key).alias("record_key"),
            "dt_period", "stg_reject_reason", "reporting_date")
        for name, (df, key) in tables.items()])
