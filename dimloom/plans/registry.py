"""Load configuration: entities, target mappings, column mappings and validation rules.

A registry is a handful of rows, so it lives in driver memory as dataclasses.
``registry_frames`` turns it into DataFrames for the report queries.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dimloom.functions.dates import OPEN_END

# Allowed words of the registry and of the staging tags.
WATERMARK_TYPES = ("DATE", "TIMESTAMP", "NUMBER")
LOAD_TYPES = ("SCD1", "SCD2", "INCREMENTAL", "APPEND")
RULE_TYPES = ("NOT_NULL", "DERIVED", "CUSTOM", "CHECK")
ERROR_ACTIONS = ("REJECT", "FAIL")
STAGING_STATUS = ("PENDING", "LOADED", "REJECTED")
STAGING_ACTIONS = ("INSERT", "UPDATE", "UNCHANGED", "MERGE")


@dataclass(frozen=True)
class SourceSystem:
    system_id: int
    name: str
    is_active: str = "Y"


@dataclass(frozen=True)
class Entity:
    entity_id: int
    system_id: int
    entity_name: str
    source_table: str
    watermark_column: str = "reporting_date"
    watermark_type: str = "DATE"
    is_active: str = "Y"


@dataclass(frozen=True)
class ColumnMapping:
    mapping_id: int
    source_column: str
    target_column: str
    is_business_key: str
    is_tracked: str
    column_order: int
    is_active: str = "Y"


@dataclass(frozen=True)
class Rule:
    rule_id: int
    mapping_id: int
    rule_name: str
    rule_type: str
    column_name: str
    derived_sql: str | None = None
    error_action: str = "REJECT"
    is_active: str = "Y"


@dataclass(frozen=True)
class Mapping:
    mapping_id: int
    entity_id: int
    target_table: str
    staging_table: str
    load_type: str
    surrogate_key_col: str | None
    surrogate_seq_name: str | None
    load_order: int
    current_col: str = "is_current"
    start_col: str = "effective_start_date"
    end_col: str = "effective_end_date"
    end_sentinel: dt.date = OPEN_END
    hash_col: str = "record_hash"
    current_flag: str = "Y"
    expired_flag: str = "N"
    is_active: str = "Y"
    #: Hash buckets of the keys of a master table.  Fixed for the life of the table; about a gigabyte of rows each is a good size.
    key_buckets: int = 16


@dataclass(frozen=True)
class Registry:
    systems: tuple[SourceSystem, ...]
    entities: tuple[Entity, ...]
    mappings: tuple[Mapping, ...]
    columns: tuple[ColumnMapping, ...]
    rules: tuple[Rule, ...] = field(default=())

    def entity(self, name: str) -> Entity:
        for e in self.entities:
            if e.entity_name == name.upper() and e.is_active == "Y":
                return e
        raise KeyError(f"no active entity named {name}")

    def mappings_of(self, entity_id: int) -> list[Mapping]:
        return sorted((m for m in self.mappings if m.entity_id == entity_id and m.is_active == "Y"),
                      key=lambda m: m.load_order)

    def mapping(self, target_table: str) -> Mapping:
        return next(m for m in self.mappings if m.target_table == target_table)

    def columns_of(self, mapping_id: int) -> list[ColumnMapping]:
        return sorted((c for c in self.columns if c.mapping_id == mapping_id and c.is_active == "Y"),
                      key=lambda c: c.column_order)

    def pairs(self, mapping_id: int) -> list[tuple[str, str]]:
        """Ordered (source, target) column pairs."""
        return [(c.source_column, c.target_column) for c in self.columns_of(mapping_id)]

    def keys(self, mapping_id: int) -> list[str]:
        return [c.target_column for c in self.columns_of(mapping_id) if c.is_business_key == "Y"]

    def sources(self, mapping_id: int) -> dict[str, str]:
        """Source column of each target column."""
        return {target: source for source, target in self.pairs(mapping_id)}

    def attributes(self, mapping_id: int) -> list[str]:
        return [c.target_column for c in self.columns_of(mapping_id) if c.is_business_key != "Y"]

    def tracked(self, mapping_id: int) -> list[str]:
        return [c.source_column for c in self.columns_of(mapping_id) if c.is_tracked == "Y"]

    def rules_of(self, mapping_id: int) -> list[Rule]:
        return sorted((r for r in self.rules if r.mapping_id == mapping_id and r.is_active == "Y"),
                      key=lambda r: r.rule_id)


def _columns(mapping_id: int, keys: list[str], attributes: list[str]) -> list[ColumnMapping]:
    names = [(k, "Y", "N") for k in keys] + [(a, "N", "Y") for a in attributes]
    return [ColumnMapping(mapping_id, n, n, key, tracked, 10 * (i + 1))
            for i, (n, key, tracked) in enumerate(names)]


def default_registry() -> Registry:
    """The shipped configuration: staffing schedules and costs, each a master and a monthly table."""
    mappings = (
        Mapping(1, 1, "dim_staffing_schedule", "stg_staffing_schedule", "SCD2", "dim_ss_id", "seq_dim_ss", 10),
        Mapping(2, 1, "dim_staffing_timeline", "stg_staffing_timeline", "INCREMENTAL", "dim_st_id", "seq_dim_st", 20),
        Mapping(3, 2, "dim_cost", "stg_cost", "SCD2", "dim_cost_id", "seq_dim_cost", 10),
        Mapping(4, 2, "dim_timeline_cost", "stg_timeline_cost", "INCREMENTAL", "dim_tc_id", "seq_dim_tc", 20),
    )
    columns = (
        _columns(1, ["schedule_id"], ["employee_id", "position_id", "project_id", "schedule_type",
                                      "schedule_status", "schedule_start_date", "schedule_end_date"])
        + _columns(2, ["schedule_id", "dt_period"], ["period_start_date", "period_end_date", "allocated_hours"])
        + _columns(3, ["cost_id"], ["project_id", "cost_center", "cost_type", "cost_category", "currency"])
        + _columns(4, ["cost_id", "dt_period"], ["period_date", "amount", "curve_type", "forecast_type"])
    )
    # Rule names, rejected columns, allowed words, in rule order.
    rules = (
        Rule(1, 1, "PROJECT_ID_REQUIRED", "NOT_NULL", "PROJECT_ID"),
        Rule(2, 1, "POSITION_ID_REQUIRED", "NOT_NULL", "POSITION_ID"),
        Rule(3, 1, "SCHEDULE_TYPE_CHECK", "CHECK", "SCHEDULE_TYPE",
             "schedule_type IS NULL OR schedule_type IN "
             "('Exempt', 'Non-Exempt', 'Exempt Agency', 'Non-Exempt Agency')"),
        Rule(4, 1, "SCHEDULE_STATUS_CHECK", "CHECK", "SCHEDULE_STATUS",
             "schedule_status IS NULL OR schedule_status IN "
             "('Open', 'Filled', 'Canceled', 'Approved', 'Rejected', 'Withdrawn', 'Pending')"),
        Rule(5, 1, "SCHEDULE_DATE_ORDER", "CHECK", "SCHEDULE_START_DATE",
             "schedule_start_date IS NULL OR schedule_end_date IS NULL OR schedule_start_date <= schedule_end_date"),
        Rule(6, 2, "DT_PERIOD_REQUIRED", "DERIVED", "DT_PERIOD", "date_format(period_start_date, 'yyyyMM')"),
        Rule(7, 2, "ALLOCATED_HOURS_REQUIRED", "NOT_NULL", "ALLOCATED_HOURS"),
        Rule(8, 2, "ALLOCATED_HOURS_NON_NEGATIVE", "CHECK", "ALLOCATED_HOURS",
             "allocated_hours IS NULL OR allocated_hours >= 0"),
        Rule(9, 2, "PERIOD_DATE_ORDER", "CHECK", "PERIOD_START_DATE",
             "period_start_date IS NULL OR period_end_date IS NULL OR period_start_date <= period_end_date"),
        Rule(10, 3, "PROJECT_ID_REQUIRED", "NOT_NULL", "PROJECT_ID"),
        Rule(11, 3, "COST_TYPE_REQUIRED", "NOT_NULL", "COST_TYPE"),
        Rule(12, 3, "COST_CATEGORY_CHECK", "CHECK", "COST_CATEGORY",
             "cost_category IS NULL OR upper(cost_category) IN ('COMPANY', 'CLIENT')"),
        Rule(13, 4, "CURVE_TYPE_REQUIRED", "DERIVED", "CURVE_TYPE",
             "CASE WHEN upper(forecast_type) IN ('ACTUALS', 'ACTUAL') THEN 'ACTUAL'"
             " WHEN upper(forecast_type) IN ('FC', 'FORECAST') THEN 'FORECAST' END"),
        Rule(14, 4, "DT_PERIOD_REQUIRED", "DERIVED", "DT_PERIOD", "date_format(period_date, 'yyyyMM')"),
        Rule(15, 4, "AMOUNT_REQUIRED", "NOT_NULL", "AMOUNT"),
        Rule(16, 4, "FORECAST_TYPE_REQUIRED", "NOT_NULL", "FORECAST_TYPE"),
        Rule(17, 4, "CURVE_TYPE_VALUE_CHECK", "CHECK", "CURVE_TYPE",
             "curve_type IS NULL OR curve_type IN ('ACTUAL', 'BUDGET', 'FORECAST')"),
    )
    return Registry(
        systems=(SourceSystem(1, "SOURCE_HUB"),),
        entities=(
            Entity(1, 1, "STAFFING_SCHEDULE", "staffing_source"),
            Entity(2, 1, "COST", "cost_source"),
        ),
        mappings=mappings,
        columns=tuple(columns),
        rules=rules,
    )


_SPARK_TYPES = {"int": T.LongType(), "str": T.StringType(), "str | None": T.StringType(), "dt.date": T.DateType()}


def _frame(spark: SparkSession, rows: tuple, kind: type) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, _SPARK_TYPES[f.type]) for f in fields(kind)])
    return spark.createDataFrame([asdict(r) for r in rows], schema)


def registry_frames(spark: SparkSession, registry: Registry) -> dict[str, DataFrame]:
    return {
        "source_system": _frame(spark, registry.systems, SourceSystem),
        "entity": _frame(spark, registry.entities, Entity),
        "mapping": _frame(spark, registry.mappings, Mapping),
        "column": _frame(spark, registry.columns, ColumnMapping),
        "rule": _frame(spark, registry.rules, Rule),
    }
