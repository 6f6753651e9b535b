import dataclasses
import datetime as dt
import json
import shutil
from decimal import Decimal

import pytest

from dimloom.operators.validate import ValidationFailed
from dimloom.plans import reports, runner
from dimloom.plans.registry import Mapping, Rule, default_registry, registry_frames
from dimloom.plans.warehouse import Warehouse

D = dt.date
NOW = dt.datetime(2024, 3, 1, 2)
STAFFING = ("schedule_id string, employee_id string, position_id string, project_id string, schedule_type string, "
            "schedule_status string, schedule_start_date date, schedule_end_date date, period_start_date date, "
            "period_end_date date, allocated_hours decimal(18,4), reporting_date date, src_seq bigint")
COSTS = ("cost_id string, project_id string, cost_center string, cost_type string, cost_category string, currency string, "
         "period_date date, amount decimal(22,6), curve_type string, forecast_type string, reporting_date date, src_seq bigint")


def staffing(spark, *rows):
    return spark.createDataFrame([
        (key, employee, "pos", project, "Exempt", "Open", D(2024, 1, 1), D(2024, 6, 30), month, month, Decimal(hours), day, n)
        for n, (key, employee, project, month, hours, day) in enumerate(rows)], STAFFING)


def costs(spark, *rows):
    return spark.createDataFrame([
        (key, "pr", "cc", "T", "Company", "USD", month, Decimal(amount), None, kind, day, n)
        for n, (key, month, amount, kind, day) in enumerate(rows)], COSTS)


FIRST = [("s1", "e1", "p", D(2024, 1, 1), 10, D(2024, 1, 10)), ("s1", "e2", "p", D(2024, 1, 1), 20, D(2024, 1, 20)),
         ("s2", "e1", "p", D(2024, 1, 1), 10, D(2024, 1, 15)), ("s3", "e1", None, None, 10, D(2024, 1, 15))]
LATER = [("s1", "e9", "p", D(2024, 2, 1), 30, D(2024, 2, 5)), ("s2", "e1", "p", D(2024, 1, 1), 11, D(2024, 2, 6)),
         ("s4", "e1", "p", D(2024, 2, 1), 5, D(2024, 2, 7))]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def dimension(warehouse, name, registry=None):
    registry = registry or default_registry()
    mapping = registry.mapping(name)
    return warehouse.table_of(registry, mapping).read(warehouse.committed())


def run(warehouse, source, day, registry=None, entity="STAFFING_SCHEDULE", **options):
    return runner.run_entity(warehouse, registry or default_registry(), entity, source, day, NOW, **options)


def test_two_runs_and_a_run_without_news(spark, warehouse):
    first = run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    assert first.counts["dim_staffing_schedule"] == {
        "rows_read": 3, "rows_inserted": 2, "rows_updated": 0, "rows_expired": 0, "rows_skipped": 0, "rows_rejected": 1,
        "duplicate_keys": 0}
    assert first.counts["dim_staffing_timeline"]["rows_inserted"] == 2
    assert first.watermark == D(2024, 1, 20)
    second = run(warehouse, staffing(spark, *FIRST, *LATER), D(2024, 3, 1))
    counts = second.counts["dim_staffing_schedule"]
    assert (counts["rows_inserted"], counts["rows_updated"], counts["rows_skipped"]) == (1, 1, 1)
    assert counts["rows_read"] == sum(counts[c] for c in ("rows_inserted", "rows_updated", "rows_skipped", "rows_rejected"))
    merged = second.counts["dim_staffing_timeline"]
    assert (merged["rows_inserted"], merged["rows_updated"]) == (2, 1)
    rows = dimension(warehouse, "dim_staffing_schedule").orderBy("schedule_id", "effective_start_date").collect()
    assert [(r.schedule_id, r.employee_id, r.is_current, r.effective_end_date) for r in rows] == [
        ("s1", "e2", "N", D(2024, 2, 29)), ("s1", "e9", "Y", D(9999, 12, 31)), ("s2", "e1", "Y", D(9999, 12, 31)),
        ("s4", "e1", "Y", D(9999, 12, 31))]
    assert sorted(r.dim_ss_id for r in rows) == [1, 2, 3, 4]
    months = dimension(warehouse, "dim_staffing_timeline").collect()
    assert sorted((r.schedule_id, r.dt_period, int(r.allocated_hours)) for r in months) == [
        ("s1", "202401", 20), ("s1", "202402", 30), ("s2", "202401", 11), ("s4", "202402", 5)]
    assert sorted(r.dim_st_id for r in months) == [1, 2, 3, 4]
    third = run(warehouse, staffing(spark, *FIRST, *LATER), D(2024, 3, 2))
    assert third.message.endswith("holds nothing newer than 2024-02-07") and third.counts == {}
    assert dimension(warehouse, "dim_staffing_schedule").count() == 4
    log = {(r.run_id, r.mapping_id): r.status for r in warehouse.run_log().collect()}
    assert set(log.values()) == {"SUCCESS"} and len(log) == 7
    steps = reports.step_detail(warehouse.step_log(), second.run_id).collect()
    assert [(s.step_name, s.rows_affected) for s in steps] == [
        ("STAGE:stg_staffing_schedule", 3), ("SCD2:dim_staffing_schedule", 2),
        ("STAGE:stg_staffing_timeline", 3), ("INCREMENTAL:dim_staffing_timeline", 3)]
    errors = {r.error_code for r in warehouse.error_log().collect()}
    assert errors == {"VAL_NOT_NULL", "VAL_DERIVED_NULL"}
    summary = reports.recent_runs(warehouse.run_log(), *[registry_frames(spark, default_registry())[n]
                                                         for n in ("entity", "mapping")], NOW)
    assert summary.count() == 7


def test_a_load_leaves_no_scratch(spark, warehouse):
    """Only the tables stay on disk: settled rows go with the step that needed them."""
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    known = set(folder.iterdir())
    for day, rows in ((D(2024, 2, 1), FIRST), (D(2024, 3, 1), FIRST + LATER)):
        run(warehouse, staffing(spark, *rows), day)
        assert set(folder.iterdir()) == known


def test_unchanged_rows_rewrite_nothing(spark, warehouse):
    run(warehouse, staffing(spark, FIRST[1]), D(2024, 2, 1))
    again = ("s1", "e2", "p", D(2024, 1, 1), 20, D(2024, 2, 20))
    result = run(warehouse, staffing(spark, FIRST[1], again), D(2024, 3, 1))
    assert result.counts["dim_staffing_schedule"]["rows_skipped"] == 1
    table = warehouse.table_of(default_registry(), default_registry().mapping("dim_staffing_schedule"))
    assert len(table.written(1)) == 1 and table.written(2) == []


def failing_registry():
    base = default_registry()
    rules = tuple(dataclasses.replace(r, error_action="FAIL") if r.rule_name == "ALLOCATED_HOURS_NON_NEGATIVE" else r
                  for r in base.rules)
    return dataclasses.replace(base, rules=rules)


def test_fail_rule_publishes_nothing_and_can_be_run_again(spark, warehouse):
    bad = [*FIRST[:3], ("s5", "e", "p", D(2024, 1, 1), -1, D(2024, 1, 21))]
    with pytest.raises(ValidationFailed) as failure:
        run(warehouse, staffing(spark, *bad), D(2024, 2, 1), failing_registry())
    assert failure.value.code == -20032
    assert warehouse.committed().count() == 0 and dimension(warehouse, "dim_staffing_schedule").count() == 0
    assert {r.status for r in warehouse.run_log().collect()} >= {"FAILED"}
    # The first mapping had been written by the failed run; the next run starts clean.
    result = run(warehouse, staffing(spark, *FIRST[:3]), D(2024, 2, 1), failing_registry())
    assert result.run_id == 2 and result.counts["dim_staffing_schedule"]["rows_inserted"] == 2
    rows = dimension(warehouse, "dim_staffing_schedule").collect()
    assert sorted(r.dim_ss_id for r in rows) == [1, 2] and {r.etl_run_id for r in rows} == {2}


def test_superseded_files_can_be_removed(spark, warehouse):
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    run(warehouse, staffing(spark, *FIRST, *LATER), D(2024, 3, 1))
    table = warehouse.table_of(default_registry(), default_registry().mapping("dim_staffing_schedule"))
    before = sorted(table.read(warehouse.committed()).collect())
    old = table.superseded(warehouse.committed())
    assert len(old) == 1 and "etl_batch=1" in old[0]
    shutil.rmtree(old[0].removeprefix("file:"))
    assert sorted(table.read(warehouse.committed()).collect()) == before and table.superseded(warehouse.committed()) == []


def test_one_changed_key_writes_one_bucket(spark, warehouse):
    many = [(f"s{i}", "e1", "p", D(2024, 1, 1), 10, D(2024, 1, 10)) for i in range(60)]
    run(warehouse, staffing(spark, *many), D(2024, 2, 1))
    table = warehouse.table_of(default_registry(), default_registry().mapping("dim_staffing_schedule"))
    assert len(table.written(1)) > 8
    run(warehouse, staffing(spark, *many, ("s7", "e2", "p", D(2024, 1, 1), 10, D(2024, 2, 10))), D(2024, 3, 1))
    written = table.written(2)
    bucket = written[0].split("key_bucket=")[1].split("/")[0]
    assert written == [f"is_current={c}/key_bucket={bucket}/etl_batch=2" for c in "NY"]
    rows = dimension(warehouse, "dim_staffing_schedule").collect()
    assert len(rows) == 61 and sorted(r.dim_ss_id for r in rows) == list(range(1, 62))
    assert sorted((r.employee_id, r.is_current) for r in rows if r.schedule_id == "s7") == [("e1", "N"), ("e2", "Y")]
    files = table.read(warehouse.committed(), {"is_current": ["Y"], "key_bucket": [int(bucket)]}).inputFiles()
    assert files and all(f"is_current=Y/key_bucket={bucket}/etl_batch=2" in f for f in files)


def test_another_number_of_buckets_is_refused(spark, warehouse):
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    base = default_registry()
    other = dataclasses.replace(base, mappings=tuple(dataclasses.replace(m, key_buckets=4) for m in base.mappings))
    with pytest.raises(runner.RegistryError) as error:
        run(warehouse, staffing(spark, *FIRST, *LATER), D(2024, 3, 1), other)
    assert error.value.code == -20016


def renaming_registry():
    """Every kind of column under another name in the dimension: key, attribute, month."""
    base = default_registry()
    names = {"schedule_id": "schedule_code", "employee_id": "worker", "schedule_start_date": "starts_on", "dt_period": "month",
             "schedule_type": "schedule_status", "schedule_status": "schedule_type"}
    columns = tuple(dataclasses.replace(c, target_column=names.get(c.source_column, c.source_column)) for c in base.columns)
    return dataclasses.replace(base, columns=columns)


def test_columns_renamed_by_the_mapping(spark, warehouse):
    plain = Warehouse(spark, f"{warehouse.root}-plain")
    registry = renaming_registry()
    for where, how in ((warehouse, registry), (plain, default_registry())):
        run(where, staffing(spark, *FIRST), D(2024, 2, 1), how)
        result = run(where, staffing(spark, *FIRST, *LATER), D(2024, 3, 1), how)
        assert result.counts["dim_staffing_schedule"]["rows_skipped"] == 1
    for name in ("dim_staffing_schedule", "dim_staffing_timeline"):
        mine, other = dimension(warehouse, name, registry), dimension(plain, name)
        pairs = {s: t for s, t in registry.pairs(registry.mapping(name).mapping_id)}
        assert mine.columns != other.columns
        back = mine.select(*[mine[pairs.get(c, c)].alias(c) for c in other.columns])
        assert back.schema == other.schema and sorted(map(str, back.collect())) == sorted(map(str, other.collect()))
    staged = warehouse.staging(registry.mapping("dim_staffing_schedule"), [s for s, _ in registry.pairs(1)]).read(warehouse.committed())
    assert "schedule_id" in staged.columns and "schedule_code" not in staged.columns


def test_rejected_rows_are_in_the_error_log(spark, warehouse):
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    rows = warehouse.error_log().filter("record_key IS NOT NULL").orderBy("err_id").collect()
    assert [(r.target_table, r.error_code, r.record_key) for r in rows] == [
        ("dim_staffing_schedule", "VAL_NOT_NULL", "SCHEDULE_ID=s3"), ("dim_staffing_timeline", "VAL_DERIVED_NULL", "SCHEDULE_ID=s3|DT_PERIOD=")]
    data = json.loads(rows[0].record_data)
    assert data["schedule_id"] == "s3" and data["project_id"] is None and data["reporting_date"] == "2024-01-15"
    every = warehouse.error_log().collect()
    assert len({r.err_id for r in every}) == len(every) == 4


def test_step_ids_of_large_mapping_ids_differ(spark, warehouse):
    base = default_registry()
    moved = lambda rows: tuple(dataclasses.replace(r, mapping_id=r.mapping_id + 99) for r in rows)
    registry = dataclasses.replace(base, mappings=moved(base.mappings), columns=moved(base.columns), rules=moved(base.rules))
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1), registry)
    run(warehouse, staffing(spark, *FIRST, *LATER), D(2024, 3, 1), registry)
    steps = [r.step_id for r in warehouse.step_log().collect()]
    assert len(steps) == len(set(steps)) == 8


def test_late_rows_need_a_look_back(spark, warehouse):
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    late = ("s8", "e", "p", D(2024, 1, 1), 1, D(2024, 1, 18))
    source = staffing(spark, *FIRST, late, LATER[2])
    run(warehouse, source, D(2024, 3, 1), lookback_days=5)
    assert "s8" in {r.schedule_id for r in dimension(warehouse, "dim_staffing_schedule").collect()}


def test_run_all_goes_on_after_a_failure(spark, warehouse):
    cost_rows = costs(spark, ("c1", D(2024, 1, 1), "10.5", "Actuals", D(2024, 1, 5)), ("c1", None, "1", "FC", D(2024, 1, 6)))
    broken = staffing(spark, *FIRST).drop("employee_id")
    results = runner.run_all(warehouse, default_registry(), {"STAFFING_SCHEDULE": broken, "COST": cost_rows},
                             D(2024, 2, 1), NOW)
    assert [r.status for r in results] == ["FAILED", "SUCCESS"]
    row = dimension(warehouse, "dim_timeline_cost").first()
    assert (row.cost_id, row.dt_period, row.curve_type, row.amount) == ("c1", "202401", "ACTUAL", Decimal("10.500000"))
    assert dimension(warehouse, "dim_cost").count() == 1


def test_empty_text_key_is_no_key(spark, warehouse):
    run(warehouse, staffing(spark, FIRST[2], ("", "e", "p", D(2024, 1, 1), 1, D(2024, 1, 2))), D(2024, 2, 1))
    assert {r.schedule_id for r in dimension(warehouse, "dim_staffing_schedule").collect()} == {"s2"}


@pytest.mark.parametrize("load_type", ["SCD1", "APPEND"])
def test_other_load_types(spark, warehouse, load_type):
    base = default_registry()
    mappings = tuple(dataclasses.replace(m, load_type=load_type) if m.mapping_id == 1 else m for m in base.mappings
                     if m.mapping_id in (1, 3, 4))
    registry = dataclasses.replace(base, mappings=mappings)
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1), registry)
    run(warehouse, staffing(spark, *FIRST, *LATER), D(2024, 3, 1), registry)
    rows = dimension(warehouse, "dim_staffing_schedule", registry).collect()
    expected = ["s1", "s2", "s4"] if load_type == "SCD1" else ["s1", "s1", "s2", "s2", "s4"]
    assert sorted(r.schedule_id for r in rows) == expected
    assert len({r.dim_ss_id for r in rows}) == len(rows)


def code_of(registry):
    with pytest.raises(runner.RegistryError) as error:
        runner.check_registry(registry, registry.entity("STAFFING_SCHEDULE"))
    return error.value.code


def test_registry_is_checked():
    base = default_registry()
    runner.check_registry(base, base.entity("cost"))
    first = base.mappings[0]
    change = dataclasses.replace
    assert code_of(change(base, mappings=())) == -20010
    assert code_of(change(base, mappings=(change(first, surrogate_seq_name=None),))) == -20011
    assert code_of(change(base, columns=())) == -20012
    assert code_of(change(base, mappings=(change(base.mappings[1], surrogate_key_col=None),))) == -20013
    assert code_of(change(base, rules=(Rule(1, 1, "X", "CUSTOM", "A"),))) == -20014
    assert code_of(change(base, mappings=(change(first, load_type="MERGE"),))) == -20051
    assert isinstance(first, Mapping)


def test_shipped_registry_sizes(spark):
    frames = registry_frames(spark, default_registry())
    counts = {r.check_name: r.row_count for r in reports.table_counts(frames).collect()}
    assert counts == {"source_system rows": 1, "entity rows": 2, "mapping rows": 4, "column rows": 25, "rule rows": 17}
    assert reports.registry_checks(frames["entity"], frames["mapping"], frames["column"]).count() == 0
    assert reports.column_registry(frames["entity"], frames["mapping"], frames["column"]).count() == 25


def test_schema_contract_of_the_tables(spark, warehouse):
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    expected = spark.createDataFrame([("dim_staffing_schedule", c) for c in ("record_hash", "is_current", "source_code")],
                                     "table_name string, column_name string")
    actual = reports.columns_of({"dim_staffing_schedule": dimension(warehouse, "dim_staffing_schedule")})
    found = {r.column_name: r.result for r in reports.schema_contract(expected, actual).collect()}
    assert found == {"record_hash": "FOUND", "is_current": "FOUND", "source_code": "MISSING"}


def timed(spark, *rows):
    """The same feed with moments as its watermark, in a column of another name."""
    days = staffing(spark, *[(*r[:5], r[5].date()) for r in rows])
    moments = spark.createDataFrame([(n, r[5]) for n, r in enumerate(rows)], "src_seq bigint, changed_at timestamp_ntz")
    return days.join(moments, "src_seq")


def test_moments_as_watermarks_in_another_column(spark, warehouse):
    base = default_registry()
    registry = dataclasses.replace(base, entities=tuple(dataclasses.replace(e, watermark_column="changed_at") for e in base.entities))
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    early = [("s1", "e1", "p", D(2024, 1, 1), 10, at(10, 8)), ("s1", "e2", "p", D(2024, 1, 1), 20, at(10, 10))]
    first = run(warehouse, timed(spark, *early), D(2024, 2, 1), registry)
    assert first.watermark == at(10, 10)
    assert [r.employee_id for r in dimension(warehouse, "dim_staffing_schedule").collect()] == ["e2"]
    assert run(warehouse, timed(spark, *early), D(2024, 2, 2), registry).counts == {}
    late = ("s1", "e3", "p", D(2024, 1, 1), 30, at(10, 17))
    assert run(warehouse, timed(spark, *early, late), D(2024, 2, 3), registry).counts["dim_staffing_schedule"]["rows_updated"] == 1
    other = dataclasses.replace(base, entities=tuple(dataclasses.replace(e, watermark_column="src_seq") for e in base.entities))
    with pytest.raises(runner.RegistryError):
        run(warehouse, timed(spark, *early), D(2024, 2, 4), other)


def test_reports_read_the_tables_that_loads_write(spark, warehouse):
    run(warehouse, staffing(spark, *FIRST), D(2024, 2, 1))
    frames = registry_frames(spark, default_registry())
    control = warehouse.control_table()
    status = {r.entity_name: r for r in reports.entity_status(frames["entity"], control).collect()}
    assert status["STAFFING_SCHEDULE"].status == "SUCCESS" and status["STAFFING_SCHEDULE"].last_run_id == 1
    assert reports.active_entities(frames["entity"], frames["mapping"], control).count() == 2
    assert reports.stale_watermarks(frames["entity"], control, dt.datetime(2024, 3, 1)).first().watermark_age_days == 41
    errors = warehouse.error_log()
    assert errors.select("err_id").distinct().count() == errors.count() > 0
    assert reports.error_digest(errors, NOW).first().error_count == errors.count()
    current = dimension(warehouse, "dim_staffing_schedule")
    lineage = reports.current_with_lineage(current, warehouse.run_log()).collect()
    assert len(lineage) == current.count() == 2 and {r.etl_run_status for r in lineage} == {"SUCCESS"}
