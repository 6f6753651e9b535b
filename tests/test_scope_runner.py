import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimloom.operators import reshape
from dimloom.plans import reports, scope_runner
from dimloom.plans.warehouse import Warehouse

D = dt.date
DAY = D(2024, 1, 31)
FEED = ("portfolio_id string, project_id string, business_unit string, execution_center string, bill_type string, "
        "wbs_1_code string, wbs_2_code string, cost_type string, cbs string, reporting_date date, employee_id string, "
        "position_number string, plan_start_date date, plan_end_date date, forecast_start_date date, "
        "forecast_end_date date, hours_per_week decimal(18,4), cost_basis string, "
        + ", ".join(f"{m} decimal(22,6)" for m in reshape.MEASURES))


def feed(spark, *rows, portfolio="P1", day=DAY):
    return spark.createDataFrame([
        (portfolio, "1", "BU", center, "BT", "W", wbs2, "LABOR-1", "CBS-100-1", day, employee, "pos", D(2024, 1, 1),
         D(2024, 3, 1), None, None, Decimal(40), basis, *[Decimal(1)] * len(reshape.MEASURES))
        for center, wbs2, employee, basis in rows], FEED)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def rows(warehouse, name):
    return scope_runner.table(warehouse, name).read(warehouse.committed())


def valid(warehouse, name):
    return sorted(r.employee_id for r in rows(warehouse, name).filter("is_valid = 1").collect())


def staffing(warehouse, source, hour, center=None, mode="REPLACE_ALL", portfolio="P1"):
    return scope_runner.load_staffing(warehouse, source, portfolio, DAY, center, dt.datetime(2024, 2, 1, hour), mode, "me")


AU, UK = ("AU-01", "V", "au", "Company"), ("UK-02", "V", "uk", "CLIENT")


def test_replace_all_of_one_center(spark, warehouse):
    first = staffing(warehouse, feed(spark, AU, UK, ("AU-01", None, "lost", "Company")), 1)
    assert first.unmatched_rows == 1
    assert valid(warehouse, "valid_staffing_schedule") == ["au", "uk"]
    assert valid(warehouse, "valid_staffing_timeline") == ["au"] * 3 + ["uk"] * 3
    second = staffing(warehouse, feed(spark, ("AU-01", "V", "au2", "Company"), UK), 2, center="AU-01")
    assert second.counts["valid_staffing_schedule"] == {"rows_inserted": 1, "rows_expired": 1}
    assert valid(warehouse, "valid_staffing_schedule") == ["au2", "uk"]
    assert valid(warehouse, "valid_staffing_timeline") == ["au2"] * 3 + ["uk"] * 3
    keys = [r.staffing_schedule_key for r in rows(warehouse, "valid_staffing_schedule").collect()]
    assert sorted(keys) == [1, 2, 3]
    counts = reports.validity_counts({n: rows(warehouse, n) for n in scope_runner.TABLES}).collect()
    assert {r.tbl: (r.valid_rows, r.invalid_rows) for r in counts if r.tbl != "valid_cost"} == {
        "valid_staffing_schedule": (2, 1), "valid_staffing_timeline": (6, 3)}


def test_add_update_leaves_absent_rows(spark, warehouse):
    staffing(warehouse, feed(spark, AU, UK), 1)
    staffing(warehouse, feed(spark, AU, AU), 2, mode="ADD_UPDATE")
    assert valid(warehouse, "valid_staffing_schedule") == ["au", "au", "uk"]
    assert rows(warehouse, "valid_staffing_schedule").count() == 4
    keys = [r.staffing_timeline_key for r in rows(warehouse, "valid_staffing_timeline").collect()]
    assert sorted(keys) == list(range(1, 13))


def test_empty_scope_invalidates(spark, warehouse):
    staffing(warehouse, feed(spark, AU), 1)
    staffing(warehouse, feed(spark, AU, day=D(2023, 1, 1)), 2)
    assert valid(warehouse, "valid_staffing_schedule") == []
    assert rows(warehouse, "valid_staffing_schedule").count() == 1


def test_other_scopes_are_not_touched(spark, warehouse):
    staffing(warehouse, feed(spark, AU), 1)
    staffing(warehouse, feed(spark, UK, portfolio="P2"), 2, portfolio="P2")
    assert valid(warehouse, "valid_staffing_schedule") == ["au", "uk"]
    by_portfolio = reports.valid_by_portfolio(rows(warehouse, "valid_staffing_schedule")).collect()
    assert {r.portfolio_id: r.valid_rows for r in by_portfolio} == {"P1": 1, "P2": 1}


def test_cost_reload(spark, warehouse):
    source = feed(spark, AU, UK, ("UK-02", "V", "x", "OTHER"), UK)
    scope_runner.load_cost(warehouse, source, "P1", DAY, dt.datetime(2024, 2, 1, 1), "me")
    again = scope_runner.load_cost(warehouse, source, "P1", DAY, dt.datetime(2024, 2, 1, 2), "me")
    assert again.counts["valid_cost"] == {"rows_inserted": 17, "rows_expired": 17}
    out = rows(warehouse, "valid_cost")
    assert out.filter("is_valid = 1").count() == 17 and out.count() == 34
    assert sorted(r.cost_key for r in out.collect()) == list(range(1, 35))
    assert out.select("data_source").distinct().collect()[0][0] == "GENERIC LOAD"
    reference = scope_runner.reference_table(warehouse).read(warehouse.committed())
    assert reference.count() == 2 and reference.filter(F.col("cost_flag") == 1).count() == 2


def test_failed_load_publishes_nothing(spark, warehouse):
    staffing(warehouse, feed(spark, AU), 1)
    with pytest.raises(Exception):
        staffing(warehouse, feed(spark, UK).drop("hours_per_week"), 2)
    assert valid(warehouse, "valid_staffing_schedule") == ["au"]
    assert scope_runner.reference_table(warehouse).read(warehouse.committed()).count() == 1
    with pytest.raises(ValueError):
        staffing(warehouse, feed(spark, UK), 3, mode="OTHER")


@pytest.mark.parametrize("portfolio", ["P:1", "P/1", "P%1", "P#1", "P 1", "P=1", "P{1}*?"])
def test_portfolios_with_signs_in_their_names(spark, warehouse, portfolio):
    """A reload reads the rows it does not replace, whatever their directory is called."""
    source = lambda *r: feed(spark, *r, portfolio=portfolio)
    staffing(warehouse, source(AU, UK), 1, portfolio=portfolio)
    staffing(warehouse, source(("AU-01", "V", "au2", "Company"), UK), 2, center="AU-01", portfolio=portfolio)
    assert valid(warehouse, "valid_staffing_schedule") == ["au2", "uk"]
    assert rows(warehouse, "valid_staffing_schedule").count() == 3


def test_scope_loads_show_in_the_run_report(spark, warehouse):
    staffing(warehouse, feed(spark, AU), 1)
    mapping = spark.createDataFrame([], "mapping_id bigint, target_table string")
    found = reports.run_summary(warehouse.run_log(), scope_runner.scope_entities(spark), mapping, dt.datetime(2024, 2, 2)).collect()
    assert [(r.entity_name, r.status) for r in found] == [("STAFFING_SCOPE", "SUCCESS")]


def test_a_load_leaves_the_reference_of_other_portfolios_alone(spark, warehouse):
    staffing(warehouse, feed(spark, AU, UK, portfolio="P2"), 1, portfolio="P2")
    staffing(warehouse, feed(spark, AU), 2)
    scope_runner.load_cost(warehouse, feed(spark, AU, ("AU-01", "V2", "x", "Company")), "P1", DAY, dt.datetime(2024, 2, 1, 3), "me")
    table = scope_runner.reference_table(warehouse)
    assert [table.written(n) for n in (1, 2, 3)] == [[f"portfolio_id={p}/etl_batch={n}"] for n, p in ((1, "P2"), (2, "P1"), (3, "P1"))]
    keys = table.read(warehouse.committed()).collect()
    assert sorted((r.gcs_key, r.portfolio_id, r.cost_flag) for r in keys) == [(1, "P2", 0), (2, "P2", 0), (3, "P1", 1), (4, "P1", 1)]
    files = table.read(warehouse.committed(), {"portfolio_id": ["P1"]}).inputFiles()
    assert files and all("portfolio_id=P1/etl_batch=3" in f for f in files)


def test_empty_codes_are_missing_codes(spark, warehouse):
    result = staffing(warehouse, feed(spark, AU, ("AU-01", "", "lost", "Company")), 1)
    assert result.unmatched_rows == 1 and valid(warehouse, "valid_staffing_schedule") == ["au"]


def test_rows_of_a_scope_are_written_unshuffled(spark, tmp_path):
    """All rows of a scope share their directory: nothing is gathered in one task or sorted for it."""
    table = scope_runner.table(Warehouse(spark, str(tmp_path / "wh")), "valid_cost")
    rows = spark.range(0, 400, 1, 8).select(F.col("id").alias("cost_key"), F.lit("P/1").alias("project_id"), F.lit(DAY).alias("dt_reporting"))
    table.write(scope_runner._fitted(rows, scope_runner.COST), 3, within={"project_id": "P/1", "dt_reporting": DAY})
    assert table.written(3) == ["project_id=P%2F1/dt_reporting=2024-01-31/etl_batch=3"]
    assert len(list((tmp_path / "wh").rglob("part-*.parquet"))) == 8
    ids = spark.createDataFrame([(3,)], "run_id long")
    back = table.read(ids, {"project_id": ["P/1"], "dt_reporting": [DAY.isoformat()]})
    assert sorted(r.cost_key for r in back.collect()) == list(range(400)) and back.select("project_id", "dt_reporting").distinct().first() == ("P/1", DAY)


def test_a_staffing_load_writes_its_rows_to_scratch_twice(spark, warehouse, monkeypatch):
    """The feed once, and once the looked-up rows with the keys of both tables; nothing of it stays."""
    from pathlib import Path

    from dimloom.operators import keys

    written, folder = [], Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    known = set(folder.iterdir())
    for module in (scope_runner, keys):
        settle = module.settle
        monkeypatch.setattr(module, "settle", lambda df, name, f=settle: written.append((name, "gcs_key" in df.columns and "employee_id" in df.columns)) or f(df, name))
    staffing(warehouse, feed(spark, AU, UK, UK), 1)
    assert [name for name, _ in written] == ["feed", "placed", "placed"]  # the first of the numberings is that of the codings
    assert [wide for _, wide in written] == [False, False, True]
    assert set(folder.iterdir()) == known
    for name, key, n in (("valid_staffing_schedule", "staffing_schedule_key", 3), ("valid_staffing_timeline", "staffing_timeline_key", 9)):
        assert sorted(r[key] for r in rows(warehouse, name).collect()) == list(range(1, n + 1))


def test_a_table_without_rows_is_joined_with_nothing(spark, warehouse):
    empty = rows(warehouse, "valid_staffing_schedule")
    assert empty.count() == 0 and empty.schema == scope_runner.table(warehouse, "valid_staffing_schedule").schema
    joined = spark.range(10).toDF("gcs_key").join(empty, "gcs_key", "full_outer")
    assert "Join" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 10
