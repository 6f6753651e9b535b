"""Source rows to staged rows, per target; one callable per entity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.functions.curves import curve_type
from dimloom.functions.dates import period_key
from dimloom.functions.hashing import record_hash
from dimloom.functions.text import empty_to_null
from dimloom.operators.latest import latest_per_key
from dimloom.operators.staging import stage
from dimloom.sources.scan import incremental_window

# Columns that enter the change hash of each staging table.
HASHED = {
    "stg_staffing_schedule": ["employee_id", "position_id", "project_id", "schedule_type", "schedule_status",
                              "schedule_start_date", "schedule_end_date"],
    "stg_staffing_timeline": ["period_start_date", "period_end_date", "allocated_hours"],
    "stg_cost": ["project_id", "cost_center", "cost_type", "cost_category", "currency"],
    "stg_timeline_cost": ["period_date", "amount", "forecast_type"],
}


def _window(source: DataFrame, columns: list[str], key: str, after, up_to, tie_break: str,
            *required: str, lookback_days: int = 0, watermark: str = "reporting_date") -> DataFrame:
    """Needed columns of the rows in the window that have a key, filtered before anything is shuffled."""
    rows = incremental_window(source, watermark, after, up_to, lookback_days)
    for name in (key, *required):
        rows = rows.filter(F.col(name).isNotNull())
    rows = empty_to_null(rows.select(*columns, "reporting_date", tie_break))
    return rows.filter(F.col(key).isNotNull())


def _staged(rows: DataFrame, run_id: int, table: str, columns: list[str], hashed: list[str] | None) -> DataFrame:
    payload = rows.select(*columns, F.to_date("reporting_date").alias("reporting_date"))
    return stage(payload, run_id, record_hash(payload, hashed or HASHED[table]))


def staffing_schedule(source: DataFrame, run_id: int, after: dt.date | str, up_to: dt.date | str,
                      tie_break: str = "src_seq", hashed: list[str] | None = None,
                      lookback_days: int = 0, watermark: str = "reporting_date") -> DataFrame:
    """Latest row per schedule."""
    columns = ["schedule_id", *HASHED["stg_staffing_schedule"]]
    rows = _window(source, columns, "schedule_id", after, up_to, tie_break, lookback_days=lookback_days, watermark=watermark)
    latest = latest_per_key(rows, ["schedule_id"], "reporting_date", tie_break)
    return _staged(latest, run_id, "stg_staffing_schedule", columns, hashed)


def staffing_timeline(source: DataFrame, run_id: int, after: dt.date | str, up_to: dt.date | str,
                      tie_break: str = "src_seq", hashed: list[str] | None = None,
                      lookback_days: int = 0, watermark: str = "reporting_date") -> DataFrame:
    """Latest row per schedule and month; a row without a month is kept for the validator."""
    columns = ["schedule_id", *HASHED["stg_staffing_timeline"]]
    rows = _window(source, columns, "schedule_id", after, up_to, tie_break, lookback_days=lookback_days, watermark=watermark)
    latest = latest_per_key(rows, ["schedule_id"], "reporting_date", tie_break, "period_start_date")
    dated = latest.withColumn("dt_period", period_key(F.col("period_start_date")))
    return _staged(dated, run_id, "stg_staffing_timeline", ["schedule_id", "dt_period", *columns[1:]], hashed)


def cost(source: DataFrame, run_id: int, after: dt.date | str, up_to: dt.date | str,
         tie_break: str = "src_seq", hashed: list[str] | None = None, lookback_days: int = 0, watermark: str = "reporting_date") -> DataFrame:
    """Latest row per cost record."""
    columns = ["cost_id", *HASHED["stg_cost"]]
    rows = _window(source, columns, "cost_id", after, up_to, tie_break, lookback_days=lookback_days, watermark=watermark)
    latest = latest_per_key(rows, ["cost_id"], "reporting_date", tie_break)
    return _staged(latest, run_id, "stg_cost", columns, hashed)


def cost_timeline(source: DataFrame, run_id: int, after: dt.date | str, up_to: dt.date | str,
                  tie_break: str = "src_seq", hashed: list[str] | None = None, lookback_days: int = 0, watermark: str = "reporting_date") -> DataFrame:
    """Latest row per cost record and month, with the derived curve; rows without a month are left out."""
    columns = ["cost_id", "period_date", "amount", "curve_type", "forecast_type"]
    rows = _window(source, columns, "cost_id", after, up_to, tie_break, "period_date", lookback_days=lookback_days, watermark=watermark)
    latest = latest_per_key(rows, ["cost_id"], "reporting_date", tie_break, "period_date")
    derived: dict[str, Column] = {
        "dt_period": period_key(F.col("period_date")),
        "curve_type": curve_type(F.col("forecast_type"), F.col("curve_type")),
    }
    return _staged(latest.withColumns(derived), run_id, "stg_timeline_cost",
                   ["cost_id", "dt_period", *columns[1:]], hashed)


#: Entity name → staging table → transform.  Register further entities here.
TRANSFORMS: dict[str, dict[str, Callable[..., DataFrame]]] = {
    "STAFFING_SCHEDULE": {"stg_staffing_schedule": staffing_schedule, "stg_staffing_timeline": staffing_timeline},
    "COST": {"stg_cost": cost, "stg_timeline_cost": cost_timeline},
}


def transforms_of(entity_name: str) -> dict[str, Callable[..., DataFrame]]:
    try:
        return TRANSFORMS[entity_name.upper()]
    except KeyError:
        raise KeyError(f"no transform registered for entity {entity_name}") from None
