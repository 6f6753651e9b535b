"""Registered queries: the library's operators over the projections of the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.functions.curves import curve_type
from dimloom.functions.dates import period_key
from dimloom.functions.hashing import record_hash
from dimloom.operators import coding, history, keys, reshape, staging, validate
from dimloom.operators.latest import latest_per_key
from dimloom.operators.project import mapped_projection
from dimloom.plans import reports, scoped, transforms
from dimloom.plans.registry import Rule, default_registry, registry_frames
from dimloom.plans.runner import run_all, run_entity
from dimloom.plans.scope_runner import load_cost, load_staffing, reference_table
from dimloom.plans.scope_runner import table as scope_table
from dimloom.plans.warehouse import Warehouse
from dimloom.sources import scan
from dimloom.sources.settle import settle, shared_folder
from verification.fixtures import fixture

FIRST, BEFORE_END = "1900-01-01", "1999-06-30"
AFTER_START, AFTER_END = "1997-06-30", "2001-12-31"
CLOSED_BY = dt.date(1996, 6, 30)
FIRST_DAY, LOAD_DAY = dt.date(1999, 6, 30), dt.date(2001, 12, 31)
CLOCK = dt.datetime(2024, 1, 30, 12, 0, 0)
PORTFOLIO, OTHER, CENTER = "P1", "P2", "AU-01"
OTHERS = (OTHER, "P0")
DAY, OLD_DAY = dt.date(1998, 1, 31), dt.date(1997, 12, 31)
THEN, NOW = dt.datetime(1998, 1, 31, 6, 0, 0), dt.datetime(1998, 2, 1, 6, 0, 0)

REGISTRY = default_registry()
SCHEDULE = history.Target.of(REGISTRY, REGISTRY.mapping("dim_staffing_schedule"))
TIMELINE = history.Target.of(REGISTRY, REGISTRY.mapping("dim_staffing_timeline"))
COST = history.Target.of(REGISTRY, REGISTRY.mapping("dim_cost"))
COST_TIMELINE = history.Target.of(REGISTRY, REGISTRY.mapping("dim_timeline_cost"))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- sources

@register
def incremental_window(spark, sf):
    return scan.incremental_window(fixture(spark, sf, "staffing_src"), "reporting_date", AFTER_START, AFTER_END).select(
        "schedule_id", "employee_id", "reporting_date", "src_seq")


@register
def max_source_watermark(spark, sf):
    return scan.max_watermark(fixture(spark, sf, "staffing_src"), "reporting_date")


@register
def max_stored_watermark(spark, sf):
    """A numeric watermark, from the statistics of the files."""
    return scan.stored_max_watermark(spark, f"{sf}/lineitem.parquet", "l_orderkey")


@register
def watermark_state(spark, sf):
    control = fixture(spark, sf, "control_src")
    high = scan.max_watermark(fixture(spark, sf, "cost_src"), "reporting_date").scalar()
    return control.select(
        "entity_id", scan.lower_watermark(F.col("last_watermark")).alias("from_watermark"), high.alias("to_watermark"),
        scan.advanced_watermark(F.col("last_watermark"), high).alias("next_watermark"))


@register
def scope_filter(spark, sf):
    monthly = fixture(spark, sf, "coded_src").withColumn("reporting_date", F.last_day("reporting_date"))
    return scan.scope_filter(monthly, PORTFOLIO, DAY).select(
        "portfolio_id", "project_id", "employee_id", "position_number", "order_ref", "reporting_date")


@register
def source_probe(spark, sf):
    return scan.source_probe(fixture(spark, sf, "staffing_src"))


@register
def source_scope_counts(spark, sf):
    return scan.scope_counts(fixture(spark, sf, "coded_src"))


# ---------------------------------------------------------------- projections

@register
def mapped_projection_query(spark, sf):
    pairs = [("cost_id", "record_id"), ("reporting_date", "day"), *REGISTRY.pairs(3)[1:]]
    return mapped_projection(fixture(spark, sf, "cost_src"), pairs)


@register
def derive_curve_type(spark, sf):
    return fixture(spark, sf, "cost_src").select(
        "cost_id", "src_seq", "forecast_type",
        curve_type(F.col("forecast_type"), F.col("curve_type")).alias("derived_curve"))


@register
def derive_period(spark, sf):
    return fixture(spark, sf, "staffing_src").select(
        "schedule_id", "src_seq", period_key(F.col("period_start_date")).alias("dt_period"))


@register
def record_hash_query(spark, sf):
    source = fixture(spark, sf, "staffing_src")
    return source.select("schedule_id", "src_seq",
                         record_hash(source, transforms.HASHED["stg_staffing_schedule"]).alias("schedule_hash"),
                         record_hash(source, transforms.HASHED["stg_staffing_timeline"]).alias("timeline_hash"))


@register
def coding_prefixes(spark, sf):
    return coding.coding_prefixes(fixture(spark, sf, "coded_src"))


@register
def composite_code(spark, sf):
    return fixture(spark, sf, "coded_src").select(
        "order_ref", "position_number", coding.composite_code().alias("sts_global_structure"))


@register
def three_valued_not(spark, sf):
    """NOT of an unknown predicate keeps the row out of the rejected set."""
    rule = Rule(1, 1, "TYPE", "CHECK", "SCHEDULE_TYPE", "schedule_type IN ('Exempt', 'Casual')")
    return fixture(spark, sf, "staffing_src").filter(validate.broken(rule)).select(
        "schedule_id", "src_seq", "schedule_type")


# ---------------------------------------------------------------- latest rows and staging

@register
def latest_per_key_query(spark, sf):
    rows = scan.incremental_window(fixture(spark, sf, "staffing_src"), "reporting_date", FIRST, BEFORE_END)
    return latest_per_key(rows, ["schedule_id"], "reporting_date", "src_seq")


@register
def latest_per_key_month(spark, sf):
    rows = scan.incremental_window(fixture(spark, sf, "staffing_src"), "reporting_date", FIRST, BEFORE_END)
    return latest_per_key(rows.select("schedule_id", "period_start_date", "allocated_hours", "reporting_date", "src_seq"),
                          ["schedule_id"], "reporting_date", "src_seq", "period_start_date")


@register
def transform_staffing(spark, sf):
    return transforms.staffing_schedule(fixture(spark, sf, "staffing_src"), 1, FIRST, AFTER_END)


@register
def transform_staffing_timeline(spark, sf):
    return transforms.staffing_timeline(fixture(spark, sf, "staffing_src"), 1, FIRST, AFTER_END)


@register
def transform_cost(spark, sf):
    return transforms.cost(fixture(spark, sf, "cost_src"), 1, FIRST, AFTER_END)


@register
def transform_cost_timeline(spark, sf):
    return transforms.cost_timeline(fixture(spark, sf, "cost_src"), 1, FIRST, AFTER_END)


def _validated(spark, sf, table: str) -> DataFrame:
    """One staging table, validated under its own rules."""
    entity, number, source = {
        "stg_staffing_schedule": ("STAFFING_SCHEDULE", 1, "staffing_src"),
        "stg_staffing_timeline": ("STAFFING_SCHEDULE", 2, "staffing_src"),
        "stg_cost": ("COST", 3, "cost_src"), "stg_timeline_cost": ("COST", 4, "cost_src")}[table]
    staged = transforms.transforms_of(entity)[table](fixture(spark, sf, source), 1, FIRST, AFTER_END)
    return validate.validate_rules(staged, REGISTRY.rules_of(number))


TAGS = ["stg_run_id", "stg_status", "stg_reject_reason", "stg_rule_id"]


@register
def rule_not_null(spark, sf):
    staged = transforms.cost(fixture(spark, sf, "cost_src"), 1, FIRST, AFTER_END)
    rules = [r for r in REGISTRY.rules_of(3) if r.rule_type == "NOT_NULL"]
    return validate.validate_rules(staged, rules).select("cost_id", *TAGS)


@register
def rule_derived(spark, sf):
    """The curve of source rows is dropped first, so the rule has something to derive."""
    staged = transforms.cost_timeline(fixture(spark, sf, "cost_src"), 1, FIRST, AFTER_END)
    rules = [r for r in REGISTRY.rules_of(4) if r.rule_type == "DERIVED"]
    cleared = staged.withColumns({"curve_type": F.lit(None).cast("string"), "dt_period": F.lit(None).cast("string")})
    return validate.validate_rules(cleared, rules).select("cost_id", "period_date", "curve_type", "dt_period", *TAGS)


@register
def rule_check(spark, sf):
    staged = transforms.staffing_schedule(fixture(spark, sf, "staffing_src"), 1, FIRST, AFTER_END)
    rules = [r for r in REGISTRY.rules_of(1) if r.rule_type == "CHECK"]
    return validate.validate_rules(staged, rules).select("schedule_id", *TAGS)


@register
def validate_rules(spark, sf):
    return _validated(spark, sf, "stg_staffing_schedule").select("schedule_id", *TAGS)


@register
def validate_staffing_timeline(spark, sf):
    return _validated(spark, sf, "stg_staffing_timeline").select("schedule_id", "dt_period", *TAGS)


@register
def validate_cost(spark, sf):
    return _validated(spark, sf, "stg_cost").select("cost_id", *TAGS)


@register
def validate_cost_timeline(spark, sf):
    return _validated(spark, sf, "stg_timeline_cost").select("cost_id", "dt_period", "curve_type", *TAGS)


@register
def rejection_counts(spark, sf):
    return staging.union_all([validate.rejection_counts(_validated(spark, sf, t)) for t in transforms.HASHED])


@register
def rejected_rows(spark, sf):
    return staging.rejected_rows({
        "stg_staffing_timeline": (_validated(spark, sf, "stg_staffing_timeline"), "schedule_id"),
        "stg_timeline_cost": (_validated(spark, sf, "stg_timeline_cost"), "cost_id")})


STAGING_KEYS = {"stg_staffing_schedule": "schedule_id", "stg_staffing_timeline": "schedule_id", "stg_cost": "cost_id", "stg_timeline_cost": "cost_id"}


@register
def purge_pending(spark, sf):
    """All four staging tables without what is still pending."""
    return staging.union_all([
        staging.purge_pending(_validated(spark, sf, name)).select(F.lit(name).alias("staging_table"), F.col(key).alias("record_key"), *TAGS)
        for name, key in STAGING_KEYS.items()])


@register
def staging_summary(spark, sf):
    """Schedules and costs are classified against the earlier state; timelines are merged."""
    schedule = staging.mark_loaded(history.classify(_validated(spark, sf, "stg_staffing_schedule"),
                                                    _schedules(spark, sf), SCHEDULE))
    return staging.staging_summary({
        "stg_staffing_schedule": schedule,
        "stg_staffing_timeline": staging.mark_loaded(_validated(spark, sf, "stg_staffing_timeline"), "MERGE"),
        "stg_cost": staging.mark_loaded(history.classify(_validated(spark, sf, "stg_cost"), _costs(spark, sf), COST)),
        "stg_timeline_cost": staging.mark_loaded(_validated(spark, sf, "stg_timeline_cost"), "MERGE")})


def _costs(spark, sf) -> DataFrame:
    """Current cost rows before the load."""
    staged = transforms.cost(fixture(spark, sf, "cost_src"), 1, FIRST, BEFORE_END)
    return staged.select(*COST.payload, F.lit("Y").alias("is_current"), F.col("stg_record_hash").alias("record_hash"))


@register
def run_metrics(spark, sf):
    """Counts of one run record, from its classified staging rows."""
    staged = history.classify(_validated(spark, sf, "stg_staffing_schedule"), _schedules(spark, sf), SCHEDULE)
    return staging.mark_loaded(staged).groupBy(F.col("stg_run_id").alias("run_id")).agg(*run_counts())


def run_counts() -> list[Column]:
    from dimloom.plans.runner import count_columns
    return count_columns()


# ---------------------------------------------------------------- dimension history

def _schedules(spark, sf) -> DataFrame:
    """State before the load: the latest rows of the first window; old ones are closed already."""
    staged = transforms.staffing_schedule(fixture(spark, sf, "staffing_src"), 1, FIRST, BEFORE_END)
    old = F.col("reporting_date") <= F.lit(CLOSED_BY)
    return staged.select(
        F.xxhash64("schedule_id").alias("dim_ss_id"), *SCHEDULE.payload, F.lit(FIRST_DAY).alias("effective_start_date"),
        F.when(old, F.lit(FIRST_DAY)).otherwise(F.lit(SCHEDULE.open_end)).alias("effective_end_date"),
        F.when(old, F.lit("N")).otherwise(F.lit("Y")).alias("is_current"),
        F.col("stg_record_hash").alias("record_hash"), "reporting_date",
        F.lit(1).cast("bigint").alias("etl_run_id"), F.lit(FIRST_DAY).alias("etl_load_date"))


def _incoming(spark, sf) -> DataFrame:
    return transforms.staffing_schedule(fixture(spark, sf, "staffing_src"), 2, AFTER_START, AFTER_END)


def _load(spark, sf, rules: list[Rule] = ()) -> tuple[DataFrame, DataFrame]:
    """The written state and the written classified staging rows of a load, as a run has them."""
    state, rows = settle(_schedules(spark, sf), "state"), _incoming(spark, sf)
    checked = validate.validate_rules(rows, rules) if rules else rows
    return state, settle(history.classify(checked, state, SCHEDULE), "staged")


@register
def scd2_classify(spark, sf):
    """Against the written state, which is reduced to the staged keys where it lies."""
    state, rows = settle(_schedules(spark, sf), "state"), settle(_incoming(spark, sf), "staged")
    return history.classify(rows, state, SCHEDULE, written=True).select("schedule_id", "stg_action", "stg_record_hash")


@register
def new_keys_anti(spark, sf):
    return history.new_keys(_incoming(spark, sf), _schedules(spark, sf), SCHEDULE).select(
        "schedule_id", "stg_record_hash")


@register
def scd2_expire(spark, sf):
    state, classified = _load(spark, sf)
    return history.expire(state, classified, SCHEDULE, LOAD_DAY).drop("dim_ss_id")


@register
def scd2_insert(spark, sf):
    return history.new_versions(_load(spark, sf)[1], SCHEDULE, LOAD_DAY, LOAD_DAY, 2, 0).drop("dim_ss_id")


def _after_load(spark, sf, rules: list[Rule] = ()) -> DataFrame:
    return history.apply_history(*_load(spark, sf, rules), SCHEDULE, LOAD_DAY, LOAD_DAY, 2, 0)


@register
def scd2_apply(spark, sf):
    return _after_load(spark, sf).drop("dim_ss_id")


@register
def cost_version_history(spark, sf):
    return history.version_history(_cost_load(spark, sf), COST).drop("dim_cost_id")


@register
def cost_current_with_lineage(spark, sf):
    """All rows of a load carry the id of one run, the newest in the log."""
    newest = fixture(spark, sf, "run_log_src").agg(F.max("run_id")).scalar()
    loaded = _cost_load(spark, sf).withColumn("etl_run_id", newest)
    return reports.current_with_lineage(loaded, fixture(spark, sf, "run_log_src")).drop("dim_cost_id")


@register
def version_history(spark, sf):
    return history.version_history(_after_load(spark, sf), SCHEDULE).drop("dim_ss_id")


@register
def duplicate_current(spark, sf):
    """On the raw feed taken as a dimension, where keys do repeat."""
    feed = fixture(spark, sf, "staffing_src").withColumn(
        "is_current", F.when(F.col("schedule_status") == "Open", "Y").otherwise("N"))
    return history.duplicate_current(feed, SCHEDULE)


@register
def duplicate_report(spark, sf):
    """Both master dimensions at once, on the raw feeds taken as dimensions."""
    schedules = fixture(spark, sf, "staffing_src").withColumn(
        "is_current", F.when(F.col("schedule_status") == "Open", "Y").otherwise("N"))
    costs = fixture(spark, sf, "cost_src").withColumn("is_current", F.when(F.col("currency") == "USD", "Y").otherwise("N"))
    return history.duplicate_report({"dim_staffing_schedule": (schedules, SCHEDULE), "dim_cost": (costs, COST)})


@register
def surrogate_keys(spark, sf):
    fresh = settle(history.new_keys(_incoming(spark, sf), _schedules(spark, sf), SCHEDULE).select("schedule_id"), "new")
    numbered = keys.assign_keys(fresh, ["schedule_id"], "dim_ss_id", 1000)
    return numbered.agg(F.min("dim_ss_id").alias("lowest"), F.max("dim_ss_id").alias("highest"),
                        F.count("dim_ss_id").alias("rows"), F.count_distinct("dim_ss_id").alias("distinct_keys"))


def _monthly(spark, sf) -> DataFrame:
    staged = transforms.staffing_timeline(fixture(spark, sf, "staffing_src"), 1, FIRST, BEFORE_END)
    valid = validate.validate_rules(staged, REGISTRY.rules_of(2)).filter(F.col("stg_status") == "PENDING")
    return valid.select(
        F.xxhash64("schedule_id", "dt_period").alias("dim_st_id"), *TIMELINE.payload,
        F.col("stg_record_hash").alias("record_hash"), "reporting_date",
        F.lit(1).cast("bigint").alias("etl_run_id"), F.lit(FIRST_DAY).alias("etl_load_date"))


@register
def incremental_merge(spark, sf):
    staged = transforms.staffing_timeline(fixture(spark, sf, "staffing_src"), 2, AFTER_START, AFTER_END)
    valid = settle(validate.validate_rules(staged, REGISTRY.rules_of(2)), "staged")
    return history.merge_by_key(settle(_monthly(spark, sf), "state"), valid, TIMELINE, LOAD_DAY, LOAD_DAY, 2, 0).drop("dim_st_id")


@register
def incremental_merge_cost(spark, sf):
    source = fixture(spark, sf, "cost_src")
    rules = REGISTRY.rules_of(4)
    before = validate.validate_rules(transforms.cost_timeline(source, 1, FIRST, BEFORE_END), rules)
    state = settle(before.filter(F.col("stg_status") == "PENDING").select(
        F.xxhash64("cost_id", "dt_period").alias("dim_tc_id"), *COST_TIMELINE.payload,
        F.col("stg_record_hash").alias("record_hash"), "reporting_date",
        F.lit(1).cast("bigint").alias("etl_run_id"), F.lit(FIRST_DAY).alias("etl_load_date")), "state")
    after = settle(validate.validate_rules(transforms.cost_timeline(source, 2, AFTER_START, AFTER_END), rules), "staged")
    return history.merge_by_key(state, after, COST_TIMELINE, LOAD_DAY, LOAD_DAY, 2, 0).drop("dim_tc_id")


@register
def scd1_upsert(spark, sf):
    source = fixture(spark, sf, "cost_src")
    state = transforms.cost(source, 1, FIRST, BEFORE_END).select(
        F.xxhash64("cost_id").alias("dim_cost_id"), *COST.payload, F.col("stg_record_hash").alias("record_hash"),
        "reporting_date", F.lit(1).cast("bigint").alias("etl_run_id"), F.lit(FIRST_DAY).alias("etl_load_date"))
    return history.merge_by_key(state, transforms.cost(source, 2, AFTER_START, AFTER_END), COST,
                                LOAD_DAY, LOAD_DAY, 2, 0).drop("dim_cost_id")


def _cost_load(spark, sf) -> DataFrame:
    """Two full loads of the cost dimension, each validated, classified and applied."""
    source, rules = fixture(spark, sf, "cost_src"), REGISTRY.rules_of(3)
    first = validate.validate_rules(transforms.cost(source, 1, FIRST, BEFORE_END), rules)
    opened = settle(first.withColumn("stg_action", F.lit("INSERT")), "staged")
    state = settle(history.new_versions(opened, COST, FIRST_DAY, FIRST_DAY, 1, 0), "state")
    second = validate.validate_rules(transforms.cost(source, 2, BEFORE_END, AFTER_END), rules)
    return history.apply_history(state, settle(history.classify(second, state, COST), "staged"), COST,
                                 LOAD_DAY, LOAD_DAY, 2, keys.highest_key(state, "dim_cost_id"))


@register
def cost_entity_load(spark, sf):
    return _cost_load(spark, sf).drop("dim_cost_id")


@register
def staffing_entity_load(spark, sf):
    """Window, latest row, hash, rules, classification and history of the staffing master in one plan."""
    return _after_load(spark, sf, REGISTRY.rules_of(1)).drop("dim_ss_id")


@register
def current_with_lineage(spark, sf):
    """Each schedule counts as written by the run that bears its number."""
    written = _schedules(spark, sf).withColumn("etl_run_id", F.col("schedule_id").cast("bigint"))
    return reports.current_with_lineage(written, fixture(spark, sf, "run_log_src")).drop("dim_ss_id")


# ---------------------------------------------------------------- whole loads

ENTITY_TABLES = {"STAFFING_SCHEDULE": ("staffing_src", ("dim_staffing_schedule", "dim_staffing_timeline")),
                 "COST": ("cost_src", ("dim_cost", "dim_timeline_cost"))}


_WAREHOUSES: dict[tuple[str, str, str], Warehouse] = {}


def _loaded(spark, sf, entity: str) -> Warehouse:
    """Two runs of the loader into a fresh warehouse: the feed as it stood at the first day, then all of it.

    The queries of one application that look at the same loads share them.
    """
    known = spark.sparkContext.applicationId, sf, entity
    if known in _WAREHOUSES:
        return _WAREHOUSES[known]
    source = fixture(spark, sf, ENTITY_TABLES[entity][0])
    warehouse = Warehouse(spark, f"{shared_folder(source)}/warehouse-{uuid.uuid4().hex}")
    for last, as_of, now in ((FIRST_DAY, FIRST_DAY, THEN), (LOAD_DAY, LOAD_DAY, NOW)):
        run_entity(warehouse, REGISTRY, entity, source.filter(F.col("reporting_date") <= F.lit(last)), as_of, now)
    _WAREHOUSES[known] = warehouse
    return warehouse


def _dimension(warehouse: Warehouse, name: str) -> tuple[DataFrame, history.Target]:
    mapping = REGISTRY.mapping(name)
    return warehouse.table_of(REGISTRY, mapping).read(warehouse.committed()), history.Target.of(REGISTRY, mapping)


def _loaded_dimension(spark, sf, entity: str, name: str) -> DataFrame:
    rows, target = _dimension(_loaded(spark, sf, entity), name)
    return rows.drop(target.key)


@register
def run_staffing_schedule(spark, sf):
    return _loaded_dimension(spark, sf, "STAFFING_SCHEDULE", "dim_staffing_schedule")


@register
def run_staffing_timeline(spark, sf):
    return _loaded_dimension(spark, sf, "STAFFING_SCHEDULE", "dim_staffing_timeline")


@register
def run_cost(spark, sf):
    return _loaded_dimension(spark, sf, "COST", "dim_cost")


@register
def run_cost_timeline(spark, sf):
    return _loaded_dimension(spark, sf, "COST", "dim_timeline_cost")


@register
def run_entity_keys(spark, sf):
    """Surrogate keys of all four dimensions after both runs."""
    found = []
    for entity, (_, names) in ENTITY_TABLES.items():
        warehouse = _loaded(spark, sf, entity)
        for name in names:
            rows, target = _dimension(warehouse, name)
            found.append(rows.agg(F.min(target.key).alias("lowest"), F.max(target.key).alias("highest"), F.count(target.key).alias("rows"),
                                  F.count_distinct(target.key).alias("distinct_keys")).withColumn("dimension", F.lit(name)))
    return staging.union_all(found)


@register
def run_lineage(spark, sf):
    """Current schedules with the run that wrote them, from the loader's own log."""
    warehouse = _loaded(spark, sf, "STAFFING_SCHEDULE")
    rows, _ = _dimension(warehouse, "dim_staffing_schedule")
    return reports.current_with_lineage(rows, warehouse.run_log()).select("schedule_id", "etl_run_id", "etl_run_status")


@register
def run_control(spark, sf):
    """Status and watermark of the entity, from the loader's own tables."""
    warehouse = _loaded(spark, sf, "COST")
    return reports.entity_status(_registry(spark)[0], warehouse.control_table()).select(
        "entity_name", "status", F.to_date("last_watermark").alias("last_watermark"), "last_run_id")


@register
def run_error_records(spark, sf):
    """Rejected rows in the loader's own error table: key, rule and a column out of the captured row."""
    errors = _loaded(spark, sf, "COST").error_log().filter(F.col("record_key").isNotNull())
    return errors.select("run_id", "entity_name", "target_table", "error_code", "error_message", "record_key",
                         F.get_json_object("record_data", "$.project_id").alias("project_id"), F.get_json_object("record_data", "$.reporting_date").alias("day"))


def _new_warehouse(spark, source: DataFrame) -> Warehouse:
    return Warehouse(spark, f"{shared_folder(source)}/warehouse-{uuid.uuid4().hex}")


RENAMED = {"cost_id": "record_id", "project_id": "project_code", "dt_period": "month"}


@register
def run_renamed_cost(spark, sf):
    """Both loads of the costs under a mapping that renames the key and an attribute."""
    registry = replace(REGISTRY, columns=tuple(replace(c, target_column=RENAMED.get(c.source_column, c.source_column)) for c in REGISTRY.columns))
    source = fixture(spark, sf, "cost_src")
    warehouse = _new_warehouse(spark, source)
    for last, now in ((FIRST_DAY, THEN), (LOAD_DAY, NOW)):
        run_entity(warehouse, registry, "COST", source.filter(F.col("reporting_date") <= F.lit(last)), last, now)
    return warehouse.table_of(registry, registry.mapping("dim_cost")).read(warehouse.committed()).drop("dim_cost_id")


@register
def run_fail_rule(spark, sf):
    """A second load that a FAIL rule stops: its error, what it captured, and the dimension as the first load left it."""
    source = fixture(spark, sf, "staffing_src")
    warehouse = _new_warehouse(spark, source)
    run_entity(warehouse, REGISTRY, "STAFFING_SCHEDULE", source.filter(F.col("reporting_date") <= F.lit(FIRST_DAY)), FIRST_DAY, THEN)
    strict = replace(REGISTRY, rules=tuple(replace(r, error_action="FAIL") if r.rule_id == 1 else r for r in REGISTRY.rules))
    try:
        run_entity(warehouse, strict, "STAFFING_SCHEDULE", source, LOAD_DAY, NOW)
    except validate.ValidationFailed:
        pass
    rows, _ = _dimension(warehouse, "dim_staffing_schedule")
    second = warehouse.error_log().filter("run_id = 2")
    stopped = second.filter("error_code LIKE 'ETL%'").select("error_code", "error_message")
    return stopped.select(
        "*", rows.agg(F.count(F.lit(1))).scalar().alias("dimension_rows"), rows.agg(F.max("etl_run_id")).scalar().alias("newest_run"),
        second.filter("record_key IS NOT NULL").agg(F.count(F.lit(1))).scalar().alias("captured_rows"),
        warehouse.committed().agg(F.max("run_id")).scalar().alias("committed_run"))


@register
def run_all_log(spark, sf):
    """Two rounds of all entities: first the staffing feed lacks a column, then it is whole and the costs bring no news."""
    staffing, costs = fixture(spark, sf, "staffing_src"), fixture(spark, sf, "cost_src")
    warehouse = _new_warehouse(spark, costs)
    for feed, now in ((staffing.drop("employee_id"), THEN), (staffing, NOW)):
        run_all(warehouse, REGISTRY, {"STAFFING_SCHEDULE": feed, "COST": costs}, LOAD_DAY, now)
    return warehouse.run_log().select("run_id", "entity_id", "mapping_id", "status", "rows_read", "rows_inserted", "rows_updated", "rows_rejected")


_SCOPES: dict[tuple[str, str, str], Warehouse] = {}
SCOPE_MODES = {PORTFOLIO: (None, "REPLACE_ALL"), OTHER: (CENTER, "REPLACE_ALL"), "P0": (None, "ADD_UPDATE")}


def _scope_loads(spark, sf, kind: str) -> Warehouse:
    """Scope loads of all portfolios: the feed of the first window, then that of the second, each portfolio in a mode of its own."""
    known = spark.sparkContext.applicationId, sf, kind
    if known in _SCOPES:
        return _SCOPES[known]
    feeds = [scan.incremental_window(fixture(spark, sf, "coded_src"), "reporting_date", *window).withColumn("reporting_date", F.lit(DAY))
             for window in ((FIRST, BEFORE_END), (AFTER_START, AFTER_END))]
    warehouse = _new_warehouse(spark, feeds[0])
    for feed, now, user in zip(feeds, (THEN, NOW), ("before", "load")):
        for portfolio, (center, mode) in SCOPE_MODES.items():
            if kind == "COST":
                load_cost(warehouse, feed, portfolio, DAY, now, user)
            else:
                load_staffing(warehouse, feed, portfolio, DAY, center if now == NOW else None, now, mode, user)
    _SCOPES[known] = warehouse
    return warehouse


def _scope_rows(spark, sf, name: str) -> DataFrame:
    warehouse = _scope_loads(spark, sf, "COST" if name == "valid_cost" else "STAFFING")
    return scope_table(warehouse, name).read(warehouse.committed())


SCOPE_STAMPS = ["dt_reporting", "project_id", "is_valid", "dt_created", "created_by", "dt_modified", "modified_by"]


@register
def run_scope_schedule(spark, sf):
    return _scope_rows(spark, sf, "valid_staffing_schedule").select(
        *SCOPE_STAMPS, "business_unit_id", "operating_center_id", "bill_type_id", "wbs1_id", "wbs2_id", "cost_type_id", "cbs_id",
        "sts_global_structure", "position_number", "employee_id", "dt_plan_start", "dt_plan_end", "dt_forecast_start", "dt_forecast_end",
        "hours_per_week", "is_current")


@register
def run_scope_timeline(spark, sf):
    return _scope_rows(spark, sf, "valid_staffing_timeline").select(
        *SCOPE_STAMPS, "position_number", "employee_id", "dt_period", "plan_hours", "forecast_hours", "is_current")


@register
def run_scope_cost(spark, sf):
    return _scope_rows(spark, sf, "valid_cost").select(
        *SCOPE_STAMPS, "business_unit_id", "operating_center_id", "bill_type_id", "wbs1_id", "wbs2_id", "cost_type_id", "cbs_id",
        "sts_global_structure", "cost_basis", "class", "hours", "cost", "dt_forecast_start", "dt_forecast_end", "data_source")


@register
def run_scope_keys(spark, sf):
    """Surrogate keys of the three tables and of the coding reference after all loads."""
    tables = {"valid_staffing_schedule": "staffing_schedule_key", "valid_staffing_timeline": "staffing_timeline_key", "valid_cost": "cost_key"}
    frames = {name: (_scope_rows(spark, sf, name), key) for name, key in tables.items()}
    staffing = _scope_loads(spark, sf, "STAFFING")
    frames["coding_reference"] = reference_table(staffing).read(staffing.committed()), "gcs_key"
    return staging.union_all([
        rows.agg(F.min(key).alias("lowest"), F.max(key).alias("highest"), F.count(key).alias("rows"), F.count_distinct(key).alias("distinct_keys"))
        .withColumn("tbl", F.lit(name)) for name, (rows, key) in frames.items()])


# ---------------------------------------------------------------- coding reference

def _reference(spark, sf) -> DataFrame:
    """The written reference table; its known size lets Spark broadcast it without shuffling the feed."""
    return settle(fixture(spark, sf, "coding_reference_src"), "reference")


@register
def distinct_codings(spark, sf):
    return coding.distinct_codings(_source_now(spark, sf), PORTFOLIO, DAY)


@register
def gcs_stage_codings(spark, sf):
    """The day's combinations were staged before; staging the portfolio again replaces them."""
    staged = staging.union_all([coding.stage_codings(_source_now(spark, sf), p, DAY, "staffing_flag", THEN, "before")
                                for p in (PORTFOLIO, OTHER)])
    again = coding.stage_codings(_source_now(spark, sf), PORTFOLIO, DAY, "cost_flag", NOW, "load")
    return coding.purge_codings(staged, PORTFOLIO, THEN).unionByName(again)


@register
def gcs_lookup(spark, sf):
    source = scan.scope_filter(_source_now(spark, sf), PORTFOLIO, DAY)
    return coding.lookup_key(source, _reference(spark, sf), PORTFOLIO).select(
        "gcs_key", "project_id", "employee_id", "position_number", "order_ref")


@register
def gcs_unmatched(spark, sf):
    source = scan.scope_filter(_source_now(spark, sf), PORTFOLIO, DAY)
    return coding.unmatched_count(source, _reference(spark, sf), PORTFOLIO)


@register
def gcs_reference_upsert(spark, sf):
    """Only business unit A is known so far; the cost feed of the scope brings the rest."""
    known = fixture(spark, sf, "coding_reference_src").filter(F.col("business_unit_id") == "A")
    codings = coding.distinct_codings(_source_now(spark, sf), PORTFOLIO, DAY)
    merged = coding.upsert_reference(known, codings, "cost_flag")
    is_new = F.col("staffing_flag") == 0
    return merged.withColumn("gcs_key", F.when(~is_new, F.col("gcs_key")))


@register
def gcs_new_keys(spark, sf):
    known = fixture(spark, sf, "coding_reference_src").filter(F.col("business_unit_id") == "A")
    codings = coding.distinct_codings(_source_now(spark, sf), PORTFOLIO, DAY)
    new = coding.upsert_reference(known, codings, "cost_flag").filter(F.col("staffing_flag") == 0)
    return new.agg(F.min("gcs_key").alias("lowest"), F.max("gcs_key").alias("highest"), F.count("gcs_key").alias("rows"),
                   F.count_distinct("gcs_key").alias("distinct_keys"))


# ---------------------------------------------------------------- reshape and reload

@register
def monthly_expansion(spark, sf):
    return reshape.monthly_expansion(fixture(spark, sf, "coded_src")).select(
        "order_ref", "position_number", "employee_id", "dt_period", "plan_hours", "forecast_hours")


@register
def cost_class_unpivot(spark, sf):
    return reshape.class_unpivot(fixture(spark, sf, "coded_src")).select(
        "order_ref", "position_number", "cost_basis", "class", "hours", "cost")


def _source_now(spark, sf) -> DataFrame:
    """The feed of the load: rows of the second window, reported on one day."""
    rows = scan.incremental_window(fixture(spark, sf, "coded_src"), "reporting_date", AFTER_START, AFTER_END)
    return rows.withColumn("reporting_date", F.lit(DAY))


def _keyed_now(spark, sf, reference: DataFrame | None = None) -> DataFrame:
    source = scan.scope_filter(_source_now(spark, sf), PORTFOLIO, DAY)
    return coding.lookup_key(source, _reference(spark, sf) if reference is None else reference, PORTFOLIO)


def _before(spark, sf, build, reference: DataFrame | None = None) -> DataFrame:
    """What earlier loads wrote: all portfolios on the day, one of them on an older day too."""
    rows = scan.incremental_window(fixture(spark, sf, "coded_src"), "reporting_date", FIRST, BEFORE_END)
    known = _reference(spark, sf) if reference is None else reference
    own, *others = (build(coding.lookup_key(rows.filter(F.col("portfolio_id") == p), known, p), p, DAY, THEN, "before")
                    for p in (PORTFOLIO, *OTHERS))
    days = F.explode(F.array(F.lit(DAY), F.lit(OLD_DAY)))
    return staging.union_all([own.withColumn("dt_reporting", days), *others])


def _schedule_reload(spark, sf, mode: str, reference: DataFrame | None = None) -> DataFrame:
    known = _reference(spark, sf) if reference is None else reference
    keyed = _keyed_now(spark, sf, known)
    keyed = keyed if mode == "REPLACE_ALL" else settle(keyed, "keyed")
    old = scoped.reload_schedule(_before(spark, sf, scoped.schedule_rows, known), keyed, PORTFOLIO, DAY, CENTER, mode,
                                 NOW, "load")
    return old.unionByName(scoped.schedule_rows(keyed, PORTFOLIO, DAY, NOW, "load"))


def _timeline_reload(spark, sf, mode: str, reference: DataFrame | None = None) -> DataFrame:
    known = _reference(spark, sf) if reference is None else reference
    keyed = _keyed_now(spark, sf, known)
    keyed = keyed if mode == "REPLACE_ALL" else settle(keyed, "keyed")
    old = scoped.reload_timeline(_before(spark, sf, scoped.timeline_rows, known), keyed, PORTFOLIO, DAY, mode, NOW, "load")
    return old.unionByName(scoped.timeline_rows(keyed, PORTFOLIO, DAY, NOW, "load"))


def _cost_reload(spark, sf, reference: DataFrame | None = None) -> DataFrame:
    known = _reference(spark, sf) if reference is None else reference
    old = scoped.reload_cost(_before(spark, sf, scoped.cost_rows, known), PORTFOLIO, DAY, NOW, "load")
    return old.unionByName(scoped.cost_rows(_keyed_now(spark, sf, known), PORTFOLIO, DAY, NOW, "load"))


@register
def replace_all_reload(spark, sf):
    return _schedule_reload(spark, sf, "REPLACE_ALL")


@register
def add_update_reload(spark, sf):
    return _schedule_reload(spark, sf, "ADD_UPDATE")


@register
def timeline_replace_all(spark, sf):
    return _timeline_reload(spark, sf, "REPLACE_ALL")


@register
def timeline_add_update(spark, sf):
    return _timeline_reload(spark, sf, "ADD_UPDATE")


@register
def cost_full_reload(spark, sf):
    return _cost_reload(spark, sf)


@register
def timeline_key_ranges(spark, sf):
    """Keys given to feed rows before they fan out to months."""
    keyed = scoped.only_columns(_keyed_now(spark, sf), scoped.TIMELINE_INPUT)
    table = _before(spark, sf, scoped.timeline_rows).select(F.lit(5000).cast("bigint").alias("key"))
    ranged = scoped.numbered(keyed, "key", keys.highest_key(table, "key"), scoped.month_count())
    rows = scoped.timeline_rows(ranged, PORTFOLIO, DAY, NOW, "load", "key")
    return rows.agg(F.min("key").alias("lowest"), F.max("key").alias("highest"), F.count("key").alias("rows"),
                    F.count_distinct("key").alias("distinct_keys"))


@register
def validity_counts(spark, sf):
    known = _reference(spark, sf)
    return reports.validity_counts({
        "dim_staffing_schedule": _schedule_reload(spark, sf, "REPLACE_ALL", known),
        "dim_staffing_timeline": _timeline_reload(spark, sf, "REPLACE_ALL", known),
        "dim_cost": _cost_reload(spark, sf, known)})


@register
def valid_by_portfolio(spark, sf):
    return reports.valid_by_portfolio(_schedule_reload(spark, sf, "REPLACE_ALL"))


# ---------------------------------------------------------------- reports

def _registry(spark) -> tuple[DataFrame, DataFrame]:
    frames = registry_frames(spark, REGISTRY)
    return frames["entity"], frames["mapping"]


@register
def active_entities(spark, sf):
    return reports.active_entities(*[fixture(spark, sf, n) for n in ("entity_src", "mapping_src", "control_src")])


@register
def entity_status(spark, sf):
    return reports.entity_status(fixture(spark, sf, "entity_src"), fixture(spark, sf, "control_src"))


@register
def column_registry(spark, sf):
    return reports.column_registry(*[fixture(spark, sf, n) for n in ("entity_src", "mapping_src", "column_src")])


@register
def registry_checks(spark, sf):
    return reports.registry_checks(*[fixture(spark, sf, n) for n in ("entity_src", "mapping_src", "column_src")])


@register
def registry_counts(spark, sf):
    names = ("entity", "mapping", "column", "rule", "control", "source_system")
    return reports.table_counts({n: fixture(spark, sf, f"{n}_src") for n in names})


@register
def schema_contract(spark, sf):
    return reports.schema_contract(fixture(spark, sf, "expected_columns_src"), fixture(spark, sf, "actual_columns_src"))


@register
def stale_watermarks(spark, sf):
    return reports.stale_watermarks(fixture(spark, sf, "entity_src"), fixture(spark, sf, "control_src"), CLOCK)


@register
def run_summary(spark, sf):
    return reports.run_summary(fixture(spark, sf, "run_log_src"), *_registry(spark), CLOCK)


@register
def recent_runs(spark, sf):
    return reports.recent_runs(fixture(spark, sf, "run_log_src"), *_registry(spark), CLOCK)


@register
def todays_runs(spark, sf):
    return reports.todays_runs(fixture(spark, sf, "run_log_src"), *_registry(spark), CLOCK)


@register
def daily_volume_trend(spark, sf):
    return reports.daily_volume_trend(fixture(spark, sf, "run_log_src"), _registry(spark)[0], CLOCK)


@register
def run_pivot(spark, sf):
    return reports.run_pivot(todays_runs(spark, sf), CLOCK)


@register
def pre_check(spark, sf):
    return reports.pre_check(
        fixture(spark, sf, "run_log_src"), _registry(spark)[0],
        {"staffing": fixture(spark, sf, "staffing_src"), "cost": fixture(spark, sf, "cost_src")}, CLOCK)


@register
def step_detail(spark, sf):
    return reports.step_detail(fixture(spark, sf, "step_log_src"))


@register
def todays_errors(spark, sf):
    return reports.todays_errors(fixture(spark, sf, "error_log_src"), CLOCK)


@register
def errors_last_day(spark, sf):
    return reports.errors_last_day(fixture(spark, sf, "error_log_src"), CLOCK)


@register
def error_digest(spark, sf):
    return reports.error_digest(fixture(spark, sf, "error_log_src"), CLOCK)


def registered() -> dict[str, Query]:
    """Query names without the suffix that keeps them apart from imported functions."""
    return {name.removesuffix("_query"): fn for name, fn in QUERIES.items()}
