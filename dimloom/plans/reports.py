"""Operational queries over the registry, control, run, step and error tables.

Log filters are half-open time ranges on the stored column, so they reach the scan.
``as_of`` stands for the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.functions.dates import as_date, elapsed_seconds, within_day
from dimloom.functions.text import truncate
from dimloom.operators.staging import union_all

# Fixed values.
WATCHED = ("STAFFING_SCHEDULE", "COST")
COUNTS = ("rows_read", "rows_inserted", "rows_updated", "rows_expired", "rows_skipped", "rows_rejected")


def _days_before(as_of: dt.datetime, days: int) -> Column:
    return F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")


def active_entities(entity: DataFrame, mapping: DataFrame, control: DataFrame) -> DataFrame:
    """Active entities with their active mappings, watermark and status."""
    e = entity.filter(F.col("is_active") == "Y").select("entity_id", "entity_name", "source_table", "watermark_column")
    m = mapping.filter(F.col("is_active") == "Y").select(
        "entity_id", "mapping_id", "target_table", "staging_table", "load_type", "load_order")
    c = control.select("entity_id", "last_watermark", F.col("status").alias("ctrl_status"), "last_run_date",
                       "last_run_id")
    return m.join(e.join(c, "entity_id"), "entity_id")


def entity_status(entity: DataFrame, control: DataFrame) -> DataFrame:
    return control.join(entity.select("entity_id", "entity_name"), "entity_id").select(
        "entity_name", "status", "last_watermark", "last_run_date", "last_run_id")


def column_registry(entity: DataFrame, mapping: DataFrame, column: DataFrame) -> DataFrame:
    """Active columns of active mappings of active entities."""
    e = entity.filter(F.col("is_active") == "Y").select("entity_id", "entity_name")
    m = mapping.filter(F.col("is_active") == "Y").select("entity_id", "mapping_id", "target_table", "load_type")
    c = column.filter(F.col("is_active") == "Y").select(
        "mapping_id", "target_column", "is_business_key", "is_tracked", "column_order")
    return c.join(m.join(e, "entity_id"), "mapping_id").select(
        "entity_name", "target_table", "load_type", "target_column", "is_business_key", "is_tracked", "column_order")


def stale_watermarks(entity: DataFrame, control: DataFrame, as_of: dt.datetime, days: int = 2) -> DataFrame:
    """Entities not disabled whose watermark is missing or older than ``days``, missing first."""
    age = F.datediff(F.lit(as_date(as_of)), F.to_date("last_watermark"))
    return (
        control.filter(F.col("status") != "DISABLED")
        .join(entity.filter(F.col("is_active") == "Y").select("entity_id", "entity_name"), "entity_id")
        .withColumn("watermark_age_days", age)
        .filter(F.col("last_watermark").isNull() | (F.col("watermark_age_days") > days))
        .select("entity_name", "last_watermark", "last_run_date", "watermark_age_days", "status")
        .orderBy(F.col("watermark_age_days").desc_nulls_first(), "entity_name")
    )


def _named_runs(runs: DataFrame, entity: DataFrame, mapping: DataFrame) -> DataFrame:
    return (
        runs.join(entity.select("entity_id", "entity_name"), "entity_id")
        .join(mapping.select("mapping_id", "target_table"), "mapping_id", "left")
        .withColumn("elapsed_secs", elapsed_seconds(F.col("start_time"), F.col("end_time")))
    )


def run_summary(runs: DataFrame, entity: DataFrame, mapping: DataFrame, as_of: dt.datetime,
                days: int = 7) -> DataFrame:
    """Runs started in the last ``days``, with elapsed seconds."""
    recent = runs.filter(F.col("start_time") >= _days_before(as_of, days))
    counts = [c for c in COUNTS if c in runs.columns]
    return _named_runs(recent, entity, mapping).select(
        "run_id", "entity_name", "target_table", "start_time", "end_time", "elapsed_secs", "status",
        *counts, "error_message")


def recent_runs(runs: DataFrame, entity: DataFrame, mapping: DataFrame, as_of: dt.datetime,
                rows: int = 10) -> DataFrame:
    """The newest runs of the last week by run id."""
    return run_summary(runs, entity, mapping, as_of).orderBy(F.col("run_id").desc()).limit(rows)


def todays_runs(runs: DataFrame, entity: DataFrame, mapping: DataFrame, as_of: dt.datetime,
                entities: tuple[str, ...] = WATCHED) -> DataFrame:
    """Runs of the watched entities started on the day of ``as_of``; missing counts read 0."""
    today = runs.filter(within_day(F.col("start_time"), as_of))
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS if c in runs.columns]
    return _named_runs(today, entity, mapping).filter(F.col("entity_name").isin(*entities)).select(
        "run_id", "mapping_id", "entity_name", "target_table", "status", "start_time", "end_time",
        "elapsed_secs", *counts, "error_message")


def daily_volume_trend(runs: DataFrame, entity: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Daily totals per entity over the last ``days``."""
    first = as_date(as_of) - dt.timedelta(days=days)
    secs = elapsed_seconds(F.col("start_time"), F.col("end_time"))
    daily = runs.filter(F.col("start_time") >= F.lit(first)).groupBy(
        F.to_date("start_time").alias("load_date"), "entity_id").agg(
        *[F.sum(c).alias(c.replace("rows_", "total_"))
          for c in ("rows_inserted", "rows_updated", "rows_expired", "rows_rejected")],
        F.count(F.lit(1)).alias("run_count"),
        F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0)).alias("failure_count"),
        F.round(F.avg(secs), 1).alias("avg_elapsed_secs"))
    return daily.join(entity.select("entity_id", "entity_name"), "entity_id").drop("entity_id")


def run_pivot(todays: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row over today's runs of the two watched entities."""
    def of(entity: str, column: str) -> Column:
        return F.max(F.when(F.col("entity_name") == entity, F.col(column)))

    return todays.agg(
        F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).alias("run_date"),
        of("STAFFING_SCHEDULE", "run_id").alias("staffing_run_id"),
        of("COST", "run_id").alias("cost_run_id"),
        of("STAFFING_SCHEDULE", "status").alias("staffing_status"),
        of("COST", "status").alias("cost_status"),
        F.coalesce(of("STAFFING_SCHEDULE", "rows_inserted"), F.lit(0)).alias("staffing_rows_inserted"),
        F.coalesce(of("COST", "rows_inserted"), F.lit(0)).alias("cost_rows_inserted"))


def todays_errors(errors: DataFrame, as_of: dt.datetime, entities: tuple[str, ...] = WATCHED) -> DataFrame:
    return errors.filter(within_day(F.col("error_time"), as_of) & F.col("entity_name").isin(*entities))


def errors_last_day(errors: DataFrame, as_of: dt.datetime) -> DataFrame:
    return errors.filter(F.col("error_time") >= _days_before(as_of, 1))


def _cut(text: Column, length: int | None) -> Column:
    return text if length is None else truncate(text, length)


def error_digest(errors: DataFrame, as_of: dt.datetime, rows: int = 10, message_length: int | None = None,
                 length: int | None = None) -> DataFrame:
    """Count and text of the newest errors of the day, oldest first; texts are whole unless a length is given."""
    newest = (todays_errors(errors, as_of)
              .select("err_id", "error_time", "entity_name", "error_code", "error_message")
              .orderBy(F.col("error_time").desc(), F.col("err_id").desc()).limit(rows))
    line = F.concat(F.lit("["), F.date_format("error_time", "HH:mm:ss"), F.lit("] "), F.col("entity_name"),
                    F.lit(" | "), F.col("error_code"), F.lit(" | "), _cut(F.col("error_message"), message_length))
    lines = newest.select(F.struct("error_time", "err_id", line.alias("line")).alias("e"))
    ordered = F.transform(F.sort_array(F.collect_list("e")), lambda e: e["line"])
    text = _cut(F.array_join(ordered, "\n"), length)
    return lines.agg(F.count(F.lit(1)).alias("error_count"), F.nullif(text, F.lit("")).alias("error_summary"))


def step_detail(steps: DataFrame, run_id: int | None = None) -> DataFrame:
    """Steps with elapsed seconds, of one run or of all."""
    chosen = steps if run_id is None else steps.filter(F.col("run_id") == run_id)
    return chosen.select("run_id", "step_id", "step_name", "status", "rows_affected",
                         elapsed_seconds(F.col("start_time"), F.col("end_time")).alias("elapsed_secs"),
                         "step_message").orderBy("run_id", "step_id")


def pre_check(runs: DataFrame, entity: DataFrame, sources: dict[str, DataFrame], as_of: dt.datetime,
              entities: tuple[str, ...] = WATCHED) -> DataFrame:
    """One row: open runs of today, one probe per source, check time."""
    watched = entity.filter(F.col("entity_name").isin(*entities)).select("entity_id")
    stuck = runs.filter(within_day(F.col("start_time"), as_of) & F.col("end_time").isNull())
    blocked = stuck.join(watched, "entity_id").agg(F.count(F.lit(1)).alias("blocked_count"))
    probes = [df.limit(1).agg(F.max(F.lit(1))).scalar().alias(f"{name}_source_ok") for name, df in sources.items()]
    return blocked.select("blocked_count", *probes, F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).alias("check_time"))


def current_with_lineage(dimension: DataFrame, runs: DataFrame, current_column: str = "is_current",
                         flag: str | int = "Y") -> DataFrame:
    """Current rows with start and status of the run that wrote them.

    The log has a row per run and mapping; the row of the run as a whole counts, or else that of its first mapping.
    """
    whole = F.min_by(F.struct("start_time", "status"), F.coalesce(F.col("mapping_id"), F.lit(0)))
    lineage = runs.groupBy(F.col("run_id").alias("etl_run_id")).agg(whole.alias("run")).select(
        "etl_run_id", F.col("run.start_time").alias("etl_run_start"), F.col("run.status").alias("etl_run_status"))
    return dimension.filter(F.col(current_column) == F.lit(flag)).join(lineage, "etl_run_id", "left")


def validity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Valid and invalid rows per validity-flag table."""
    def side(flag: int) -> Column:
        return F.sum(F.when(F.col("is_valid") == flag, 1).otherwise(0))

    return union_all([df.agg(side(1).alias("valid_rows"), side(0).alias("invalid_rows"))
                      .select(F.lit(name).alias("tbl"), "valid_rows", "invalid_rows")
                      for name, df in tables.items()])


def valid_by_portfolio(dimension: DataFrame, portfolio_column: str = "project_id") -> DataFrame:
    return dimension.filter(F.col("is_valid") == 1).groupBy(
        F.col(portfolio_column).alias("portfolio_id")).agg(F.count(F.lit(1)).alias("valid_rows"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per registry table."""
    return union_all([df.agg(F.count(F.lit(1)).alias("row_count"))
                      .select(F.lit(f"{name} rows").alias("check_name"), "row_count")
                      for name, df in tables.items()])


def schema_contract(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """FOUND or MISSING per expected (table_name, column_name)."""
    have = actual.select("table_name", "column_name").distinct().withColumn("_found", F.lit(True))
    return expected.join(have, ["table_name", "column_name"], "left").select(
        "table_name", "column_name",
        F.when(F.col("_found"), F.lit("FOUND")).otherwise(F.lit("MISSING")).alias("result"))


def columns_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Actual columns of tables, as input of ``schema_contract``."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, column) for name, df in tables.items() for column in df.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def registry_checks(entity: DataFrame, mapping: DataFrame, column: DataFrame) -> DataFrame:
    """Violations of registry consistency, one row per entity or mapping and code.

    -20010 no active mapping, -20011 SCD without key column or sequence, -20012 mapping
    without business key column, -20013 INCREMENTAL without key column.
    """
    active = mapping.filter(F.col("is_active") == "Y")
    keyed = column.filter((F.col("is_active") == "Y") & (F.col("is_business_key") == "Y")).select(
        "mapping_id").distinct()

    def found(rows: DataFrame, code: int, mapping_id: Column) -> DataFrame:
        return rows.select("entity_id", mapping_id.cast("bigint").alias("mapping_id"), F.lit(code).alias("code"))

    scd = F.col("load_type").isin("SCD1", "SCD2")
    no_key, no_seq = F.col("surrogate_key_col").isNull(), F.col("surrogate_seq_name").isNull()
    own = F.col("mapping_id")
    return union_all([
        found(entity.join(active.select("entity_id"), "entity_id", "left_anti"), -20010, F.lit(None)),
        found(active.filter(scd & (no_key | no_seq)), -20011, own),
        found(active.join(keyed, "mapping_id", "left_anti"), -20012, own),
        found(active.filter((F.col("load_type") == "INCREMENTAL") & no_key), -20013, own),
    ])
